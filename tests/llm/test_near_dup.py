import random

from fixtures import SCHEMA, near_components, prose, rows, shingles, swap

from fieldkpi.llm import near_dup
from fieldkpi.llm.components import components
from fieldkpi.llm.near_dup import drop_near_duplicates, near_duplicates


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (5, 5), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 41)} | {x: 100 for x in range(101, 140)} | {201: 200, 202: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_equals_brute_force(spark):
    docs = rows()
    got = {r.doc_id: r for r in near_duplicates(spark.createDataFrame(docs, SCHEMA).repartition(5)).collect()}
    want = near_components([(d[0], d[1]) for d in docs])
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_borderline_groups_without_a_centre(spark):
    from fixtures import swap
    rng = random.Random(11)
    base = prose(rng, 140)
    docs = [(i, swap(rng, base, rng.randint(2, 5)), "en", "s", 0) for i in range(70)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got == near_components([(d[0], d[1]) for d in docs])


def test_mixed_groups_fragments_and_extensions(spark):
    """Several hot groups that share passages; cut, extended and edited copies at every distance."""
    from fixtures import WORDS, swap
    rng = random.Random(23)
    passage = prose(rng, 40)
    docs = []
    for g in range(4):
        base = prose(rng, 90) + " " + passage
        w = base.split()
        for k in range(30):
            docs.append(swap(rng, base, rng.randint(0, 7)))
            docs.append(" ".join(w[: rng.randint(60, 130)]))
            docs.append(" ".join(w[rng.randint(0, 60):] + [rng.choice(WORDS) for _ in range(rng.randint(0, 40))]))
    rng.shuffle(docs)
    rows_ = [(i, t, "en", "s", 0) for i, t in enumerate(docs)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(rows_, SCHEMA)).collect()}
    assert got == near_components([(d[0], d[1]) for d in rows_])


def test_null_and_repeated_ids_extra_columns_empty_table(spark):
    rng = random.Random(2)
    a, b = prose(rng, 50), prose(rng, 50)
    docs = [(1, a, 9), (2, a, 8), (2, b, 7), (5, b, 6), (None, a, 5), (None, None, 4)]
    df = spark.createDataFrame(docs, "doc_id long, text string, rep int").withColumnRenamed("rep", "token")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1, True), (2, 1, False), (2, 1, False), (5, 1, False), (None, None, True), (None, None, True)], key=str)
    left = drop_near_duplicates(df)
    assert left.columns == ["doc_id", "text", "token"] and sorted(r.token for r in left.collect()) == [4, 7, 9]  # a row of each text, whatever its id
    assert near_duplicates(df.limit(0)).count() == 0


def test_rows_with_null_or_repeated_ids_are_judged_one_by_one(spark):
    rng = random.Random(21)
    text, other = prose(rng, 80), prose(rng, 80)
    near = swap(rng, text, 1)
    rows_ = [(None, text), (None, text), (7, other), (7, text), (7, other), (3, near), (None, other), (None, None), (None, ""), (None, "  "), (9, prose(rng, 50))]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows_], "doc_id long, text string, component_id string, __nd int")
    out = near_dup.drop_near_duplicates(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(3, near), (7, other), (None, None), (None, ""), (None, "  "), rows_[-1]], key=str)


def test_other_similarities_find_their_links(spark):
    assert near_dup.least_matches(75) == 32 and near_dup.least_matches(50) < 20 and near_dup.least_matches(100) == near_dup.COORDS
    rng = random.Random(22)
    docs = []
    for i in range(30):  # pairs at about 0.5
        base = [prose(rng, 1) + str(rng.randint(0, 999)) for _ in range(90)]
        docs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[:60] + [w + "z" for w in base[60:]]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = {}
    for a, b in zip(docs[::2], docs[1::2]):
        x, y = shingles(a[1]), shingles(b[1])
        want[b[0]] = a[0] if 100 * len(x & y) >= 45 * len(x | y) else b[0]
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(df, pct=45).collect()}
    assert {k: got[k] for k in want} == want and any(k != v for k, v in want.items())


def test_components_of_stars_take_no_round_and_rounds_write_few_files(spark, monkeypatch):
    from fieldkpi.llm import common
    from fieldkpi.llm import components as module
    files = []

    def kept(df, *args, **kw):
        out = common.stored(df, *args, **kw)
        files.append(len(out.inputFiles()))
        return out
    monkeypatch.setattr(module, "stored", kept)
    stars = [(c * 100, c * 100 + k) for c in range(20) for k in range(1, 30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(stars, "a long, b long")).collect()}
    assert got == {b: a for a, b in stars} and not files
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paths = [(c * 100 + k, c * 100 + k + 1) for c in range(20) for k in range(9)]
        got = {r.node: r.component for r in components(spark.createDataFrame(paths, "a long, b long")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {b: b // 100 * 100 for _, b in paths}
    assert files and max(files) <= 4 * spark.sparkContext.defaultParallelism

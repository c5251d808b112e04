import itertools
import math
import random

from fixtures import prose, swap

from fieldkpi.llm.decontaminate import MASKS, MIN_SCORE, MIN_SHARE, contamination, drop_contaminated


def test_finds_passages_with_replaced_words_and_leaves_others(spark):
    rng = random.Random(5)
    items = [prose(rng, n) for n in (30, 40, 12, 25, 60)] + ["too short", None, ""]
    ids = list(range(len(items)))
    docs, want = [], set()
    for i, t in enumerate(items[:5]):
        n = len(t.split())
        for k, text in enumerate([t, prose(rng, 80) + " " + t, t + " " + prose(rng, 300), prose(rng, 20) + ". " + swap(rng, t.upper(), n // 10) + "! " + prose(rng, 20)]):
            docs.append((100 * i + k, text))
            want.add((100 * i + k, i))
    half = items[4].split()
    docs += [(900, " ".join(half[30:]) + " " + prose(rng, 30)), (901, prose(rng, 30) + " " + " ".join(half[:30]))]
    want |= {(900, 4), (901, 4)}
    docs += [(1000 + k, prose(rng, 200)) for k in range(30)] + [(2000, None), (2001, ""), (2002, "too short a text"), (None, items[0]), (3, docs[3][1])]
    want.add((None, 0))
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS w")
    b = spark.createDataFrame(list(zip(ids, items)), "item_id long, text string")
    got = contamination(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    at = {(r.doc_id, r.item_id): (r.at, r.score, r.n_words) for r in got}
    assert at[1, 0] == (80, 30, 30) and at[900, 4] == (-30, 30, 60)
    left = drop_contaminated(d, b)
    assert left.columns == d.columns and {r.doc_id for r in left.collect()} == {1000 + k for k in range(30)} | {2000, 2001, 2002}
    assert contamination(d.limit(0), b).count() == 0 and contamination(d, b.limit(0)).count() == 0
    assert drop_contaminated(d, b.limit(0)).count() == len(docs)


def test_every_text_of_a_repeated_id_is_verified(spark):
    rng = random.Random(8)
    item = prose(rng, 30)
    brush = " ".join(item.split()[:8]) + " "  # meets seeds at the same shift as the copy, without a score
    docs = [(None, brush + prose(rng, 60)) for _ in range(20)] + [(None, item)] + [(None, brush + prose(rng, 60)) for _ in range(20)]
    docs += [(7, brush + prose(rng, 60)) for _ in range(20)] + [(7, item + " " + prose(rng, 5)), (8, brush + prose(rng, 60))]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4, "text")
    longer = prose(rng, 8) + " " + " ".join(item.split()[8:]) + " " + prose(rng, 40)
    b = spark.createDataFrame([(1, item), (2, longer), (2, item), (None, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.score, r.n_words, r.at) for r in contamination(d, b).collect()}
    assert got == {(i, j): (30, 30, 0) for i in (None, 7) for j in (1, 2, None)}


def test_only_rows_with_a_contaminated_text_go(spark):
    rng = random.Random(9)
    item = prose(rng, 30)
    clean = [(i, prose(rng, 60)) for i in (None, None, 7, 7, 8)] + [(None, None), (7, "")]
    d = spark.createDataFrame(clean + [(None, item), (7, "so " + item), (9, item)], "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = [(r.doc_id, r.text) for r in drop_contaminated(d, b).collect()]
    assert sorted(left, key=str) == sorted(clean, key=str)


def test_masks_meet_every_accepted_way_to_replace_words():
    for n in range(8, 21):
        least = min(MIN_SCORE, math.ceil(n * MIN_SHARE))
        for r in range((n - least) // 2 + 1):
            size = least + 2 * r  # the shortest stretch with r replaced words; all words around it may be replaced too
            for gone in itertools.combinations(range(1, size - 1), r):
                left = set(range(size)) - set(gone)
                assert any(all(at + k in left for k in m) for m in MASKS for at in range(size)), (n, gone)


def test_short_items_and_few_words_around_replaced_ones(spark):
    rng = random.Random(12)
    w = [prose(rng, 1) + str(i) for i in range(40)]
    items = [" ".join(w[:7]), " ".join(w[10:14]), " ".join(w[20:22]), w[30], " ".join(w[31:39])]
    docs = [(1, prose(rng, 20) + " " + items[0] + " " + prose(rng, 5)), (2, " ".join(w[:6] + ["other"])),  # verbatim; one word replaced
            (3, items[1].upper() + "!"), (4, "x " + items[2] + " y"), (5, items[2]), (6, w[30]), (7, w[30] + " z"),
            (8, prose(rng, 9) + " " + " ".join(w[31:34] + ["q"] + w[35:39]) + " tail"), (9, " ".join(w[32:39])), (10, " ".join(w[31:33] + ["q"] + w[34:36] + ["q", "q", "q"]))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.score) for r in contamination(d, b).collect()}
    assert got == {(1, 0, 7), (3, 1, 4), (5, 2, 2), (6, 3, 1), (8, 4, 6), (9, 4, 7)}
    assert {r.doc_id for r in drop_contaminated(d, b).collect()} == {2, 4, 7, 10}

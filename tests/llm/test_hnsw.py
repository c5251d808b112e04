import numpy as np
import pytest

from fieldkpi.llm import queries
from fieldkpi.llm.hnsw import nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, asked, k):
    good = [(i, np.array(v, float)) for i, v, *_ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, qv in good:
        if asked(q):
            s = sorted(((-float(np.dot(qv, v)), i) for i, v in good if i != q and len(v) == len(qv)))[:k]
            out[q] = [(i, -x) for x, i in s]
    return out


def recall(got, want):
    hit = total = 0
    for q, w in want.items():
        worst = w[-1][1] - 1e-9 if w else 0
        hit += sum(s >= worst for _, s in got.get(q, []))
        total += len(w)
    return hit / max(total, 1)


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_with_norms_copies_clusters_and_bad_rows(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 24))
    v = centres[rng.integers(0, 8, 1500)] + rng.normal(size=(1500, 24)) * 0.4
    v *= rng.uniform(0.2, 3, (1500, 1))
    v[200:700] = v[200]  # a third are copies
    rows = [(i, x.astype(np.float32).tolist(), 0) for i, x in enumerate(v)]
    rows += [(2000, None, 0), (2020, [], 0), (2040, [0.0] * 24, 0), (2060, [None] + [1.0] * 23, 0), (2080, [float("nan")] * 24, 0), (2100, [float("inf")] * 24, 0),
             (2120, [1.0, 2.0], 0), (2121, [2.0, 1.0], 0), (None, v[3].tolist(), 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "ids")
    got = by_query(nearest(df.where("vec_id % 20 = 0"), df, 20, shard_rows=600, block_queries=30))
    want = brute(rows, lambda q: q % 20 == 0, 20)
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    assert recall(got, want) >= 0.95
    scores = {i: np.array(x, float) for i, x, *_ in rows if x and None not in x}
    for q, found in got.items():
        for i, s in found:
            assert s == pytest.approx(float(np.dot(scores[q], scores[i])), rel=1e-12)
        assert found == sorted(found, key=lambda t: (-t[1], t[0])) and q not in [i for i, _ in found]
    assert got[2120] == [(2121, 4.0)]
    assert [i for i, _ in got[200]] == [i for i, _ in want[200]]  # copies in order of their ids
    assert nearest(df, df.limit(0), 20).count() == 0 and nearest(df.limit(0), df, 20).count() == 0


def test_query_recall_on_given_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding, 0) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert recall(by_query(queries.op3_hnsw_neighbours(spark, sf)), brute(rows, lambda q: q % 20 == 0, 20)) >= 0.9


def test_recall_with_vectors_of_10000_times_the_norm(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 32))
    v = centres[rng.integers(0, 20, 2000)] + rng.normal(size=(2000, 32)) * 0.4
    v[1990] *= 1e4
    v[1995] *= 1e7
    rows = [(i, x.astype(np.float32).tolist(), 0) for i, x in enumerate(v)] + [(3000, [1e-30] * 32, 0), (3001, [1e30] * 31 + [0.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = by_query(nearest(df.where("vec_id % 20 = 0"), df, 20))
    want = brute(rows, lambda q: q % 20 == 0, 20)
    assert set(got) == set(want) and recall(got, want) >= 0.95
    assert all(got[q][0] == (want[q][0][0], pytest.approx(want[q][0][1])) for q in want)  # the long ones are found

import hashlib

import numpy as np
import pytest

from fieldkpi.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label string, codes string, __vc_label int"


def lloyd(vectors, parts=8, entries=16, rounds=6, scale=4096):
    """Full scans of Python integers. ``vectors``: (id, vector, label) in id order."""
    x = [[int(np.floor(scale * v)) for v in vec] for _, vec, _ in vectors]
    dim = len(x[0])
    edges = [dim * p // parts for p in range(parts + 1)]
    books = [[row[a:b] for row in x[:entries]] for a, b in zip(edges, edges[1:])]

    def nearest(part, book):
        d = [sum((u - v) ** 2 for u, v in zip(part, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p, (a, b) in enumerate(zip(edges, edges[1:])):
            held = [[] for _ in books[p]]
            for row in x:
                held[nearest(row[a:b], books[p])[0]].append(row[a:b])
            books[p] = [[sum(c) // len(h) for c in zip(*h)] if h else e for h, e in zip(held, books[p])]
    got = {}
    for (i, _, _), row in zip(vectors, x):
        found = [nearest(row[a:b], book) for a, b, book in zip(edges, edges[1:], books)]
        got[i] = ("".join(f"{c:02x}" for c, _ in found), sum(d for _, d in found))
    return got, hashlib.sha256(",".join(str(v) for book in books for e in book for v in e).encode()).hexdigest()


def clustered(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return [(3 * i, (centres[i % 12] + rng.normal(scale=0.05, size=dim)).tolist(), "ab"[i % 2] if i % 5 else None) for i in range(n)]


def run(spark, vectors):
    rows = [(i, v, lab, "x", 1) for i, v, lab in vectors]
    return codes.digest(spark, spark.createDataFrame(rows, SCHEMA).repartition(3))


def test_equals_full_scans_and_skips_most_of_them(spark):
    vectors = clustered(400, 24)
    want, sha = lloyd(vectors)
    got = {r["vec_id"]: r for r in run(spark, vectors).collect()}
    assert {i: (r["code"], r["error"]) for i, r in got.items()} == want
    assert {r["codebooks_sha256"] for r in got.values()} == {sha}
    for lab in ("a", "b", None):
        ids = [i for i, _, x in vectors if x == lab]
        assert {got[i]["label_error"] for i in ids} == {sum(want[i][1] for i in ids)}
    df = spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in vectors], SCHEMA)
    scans = codes.encode(df).rescans
    assert scans[0] == 400 * 8 and max(scans[3:]) < 400 * 8 / 3  # the bounds settle clustered parts


def test_bounds_by_net_displacement_hold():
    """Entries that wander and come back: bounds of any age stay true."""
    rng = np.random.default_rng(5)
    x = rng.integers(-3000, 3000, size=(500, 6))
    edges = np.array([0, 3, 6])
    state = np.zeros((500, 2), codes.STATE)
    history = [x[:5].copy()]
    scanned = []
    for t in range(8):
        scanned.append(codes.Pass(history, edges).assign(x, state, t == 0))
        for p, (a, b) in enumerate(((0, 3), (3, 6))):
            d = ((x[:, None, a:b] - history[-1][None, :, a:b]) ** 2).sum(2)
            assert (state["code"][:, p] == d.argmin(1)).all()
        history.append(history[0] + rng.integers(-60, 60, size=(5, 6)))
    assert max(scanned[1:]) < 700


def test_ties_repeats_bad_vectors_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    same = [0.5] * 16
    rows = [(1, same, "a"), (1, same, "a"), (2, [-0.00001] * 16, None), (None, [0.25] * 16, "a"),
            (3, None, "a"), (4, [1.0, None] * 8, "a"), (5, [nan] * 16, "a"), (6, [-inf] * 16, "a"), (7, [], "a"), (8, [1.0], "a")]
    got = run(spark, rows).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["code"], r["error"]) for r in got) == [
        (False, 1, "00" * 8, 0), (False, 1, "00" * 8, 0), (False, 2, "02" * 8, 0), (True, 0, "03" * 8, 0)]
    assert run(spark, []).count() == 0 and run(spark, [(1, None, "a"), (2, [], "b")]).count() == 0
    assert set(run(spark, []).columns) >= {"vec_id", "code", "error", "label_error", "codebooks_sha256"}


def test_uneven_parts_and_too_large_components(spark):
    vectors = clustered(40, 13, seed=3)
    want, sha = lloyd(vectors)
    got = run(spark, vectors).collect()
    assert {r["vec_id"]: (r["code"], r["error"]) for r in got} == want and got[0]["codebooks_sha256"] == sha
    with pytest.raises(Exception, match="component"):
        run(spark, [(1, [1e30] * 8, "a")])

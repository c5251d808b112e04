import random

import numpy as np

from fieldkpi.llm import queries
from fieldkpi.llm.langid import BUCKETS, PENALTY, ROUNDS, _em, infer, learn, predict, trigram_counts

SF = "/root/testdata/sf0.1"


def test_counts_are_per_document():
    texts = [b"", b"ab", b"abc abc", b"  ", "é à".encode(), b"Zzz" * 50]
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together = trigram_counts(np.frombuffer(b"".join(texts), np.uint8), off)
    alone = np.vstack([trigram_counts(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in texts])
    assert (together == alone).all() and together[:2].sum() == 0 and together[5].sum() == 148


def test_mixture_proportions():
    rng = np.random.default_rng(0)
    p = rng.dirichlet(np.full(BUCKETS, 0.05), 3) + 1e-7
    p /= p.sum(1, keepdims=True)
    draw = lambda share, n: rng.multinomial(n, np.array(share) @ p)
    got = infer(np.array([draw([1, 0, 0], 400), draw([0.3, 0.7, 0], 4000), draw([0.2, 0.3, 0.5], 9000)], np.float32), p)
    assert got[0].tolist() == [1, 0, 0]
    assert np.allclose(got[1], [0.3, 0.7, 0], atol=0.03) and got[1][2] == 0
    assert np.allclose(got[2], [0.2, 0.3, 0.5], atol=0.03)


def _by_all_sizes(counts, p):
    """The best set of every size, one document at a time, none left out."""
    out = []
    for c in counts:
        share = _em(c[None], p, np.full((1, len(p)), 1 / len(p)), ROUNDS)[0]
        order, best = np.argsort(-share, kind="stable"), None
        for k in range(1, len(p) + 1):
            start = np.zeros(len(p))
            if k == 1:
                start[max(range(len(p)), key=lambda j: (c * np.log(p[j])).sum())] = 1
            else:
                start[order[:k]] = np.maximum(share[order[:k]], 1e-3)
                start = _em(c[None], p, (start / start.sum())[None], ROUNDS)[0]
            gain = (c * np.log(np.maximum(start @ p, 1e-12))).sum() - PENALTY * (k - 1)
            if best is None or gain > best[0] + 1e-3:
                best = gain, start
        out.append(best[1])
    return np.array(out)


def test_sets_equal_a_trial_of_every_size():
    """Small shares of long texts included: no share or size ends the search early."""
    rng = np.random.default_rng(5)
    p = rng.dirichlet(np.full(BUCKETS, 0.05), 4) + 1e-6
    p /= p.sum(1, keepdims=True)
    shares = [[1, 0, 0, 0], [0.99, 0.01, 0, 0], [0.985, 0.005, 0.01, 0], [0.4, 0.3, 0.2, 0.1], [0.97, 0.01, 0.01, 0.01], [0.5, 0.5, 0, 0]]
    counts = np.array([rng.multinomial(n, np.array(s) @ p) for s in shares for n in (0, 5, 60, 700, 20000)], np.float32)
    got, want = infer(counts, p), _by_all_sizes(counts.astype(float), p)
    assert ((got > 0) == (want > 0)).all() and np.allclose(got, want, atol=0.01)
    assert (got[9] > 0).sum() == 2 and (got[14] > 0).sum() == 3   # 200 letters of 20,000


def test_held_out_accuracy_and_edge_rows(spark):
    got = queries.op9_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = got.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(held) > 1000 and (held.lang == held.lang_pred).mean() > 0.98
    rng = random.Random(0)
    samples = {r.lang: r.text for r in docs.where("n_chars > 3000").limit(60).collect()}
    model = learn(docs)
    langs = sorted(samples)[:2]
    both = samples[langs[0]][:2000] + " " + samples[langs[1]][:900]
    odd = [(None, None, 1), (1, "", 2), (2, "123 !! ", 3), (2, "123 !! ", 3), (3, "\U0001f600", 4), (4, both, 5), (5, "the " * 100_000, 6)]
    df = spark.createDataFrame(odd, "doc_id long, text string, score int")
    out = {r.doc_id: r for r in predict(df, model).collect()}
    assert predict(df, model).count() == 7
    assert all(out[k].lang_pred == "und" and out[k].score == 0 for k in (None, 1, 2, 3))
    assert out[4].lang_pred == langs[0] and langs[1] in out[4].langs and out[4].score < 0.95
    assert all(r.lang_pred == "und" for r in predict(df, learn(docs.limit(0))).collect())
    assert predict(df.limit(0), model).count() == 0 and rng

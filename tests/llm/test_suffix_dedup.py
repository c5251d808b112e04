import random
from collections import Counter

import numpy as np
import pytest
from fixtures import prose, sha, swap

from fieldkpi.llm.suffix_dedup import common_prefixes, remove_repeats, suffix_array


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    n = Counter(d[i: i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if n[d[i: i + length]] > 1:
                gone[i: i + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
        out.append((len(d), list(zip(edge[::2].tolist(), edge[1::2].tolist())), sha(bytes(b for b, g in zip(d, gone) if not g))))
    return out


@pytest.mark.parametrize("alphabet", [2, 5, 256])
def test_suffix_array_and_common_prefixes(alphabet):
    rng = np.random.default_rng(alphabet)
    s = rng.integers(0, alphabet, 700)
    s[300:500] = s[40:240]
    order, rank, words = suffix_array(s + 1)
    t = s.tolist()
    assert order.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
    lcp = common_prefixes(order, rank, words, np.array([0, 350]), np.array([350, 350]), 60)
    for x in range(700):
        r = rank[x]
        want = 0
        if r:
            y = order[r - 1]
            while max(x, y) + want < 700 and t[x + want] == t[y + want] and want < 60:
                want += 1
        assert lcp[x] == want


def texts(rng):
    passage, other = prose(rng, 60), prose(rng, 30)
    out = [prose(rng, rng.randint(0, 120)) for _ in range(15)]
    out += [f"{prose(rng, rng.randint(0, 20))} {passage} {prose(rng, rng.randint(0, 20))}" for _ in range(25)]
    out += [prose(rng, 10) + passage[: rng.randint(30, 200)] + prose(rng, 10) for _ in range(15)]
    out += [other * 3, other, other, "ab" * 300, "é" * 150 + "x", "\0" * 200, None, "", passage[:57], swap(rng, passage, 2)]
    out += [swap(rng, passage + " " + other, k) for k in range(6)]
    return out


@pytest.mark.parametrize("split", [1000, 3])
def test_equals_brute_force(spark, split):
    t = texts(random.Random(split))
    ids = [None, 5, 5, *range(3, len(t))]
    df = spark.createDataFrame(list(zip(ids, t, range(len(t)))), "doc_id long, text string, h long").repartition(3)
    got = remove_repeats(df, length=58, gram=15, shard_bytes=4000, split_contexts=split).collect()
    want = brute(t, 58)
    row = lambda i, n, s, k: (str(i), n, s, k)
    assert sorted(row(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], sha(bytes(r.kept))) for r in got) == sorted(row(i, *w) for i, w in zip(ids, want))
    assert remove_repeats(df.limit(0)).count() == 0


def test_long_texts_and_contract_length(spark, monkeypatch):
    from fieldkpi.llm import suffix_dedup
    rng = random.Random(9)
    big = prose(rng, 40_000)
    t = [big, prose(rng, 5) + big[1000:9000] + prose(rng, 100), prose(rng, 90), big[-399:], big[-400:]]
    df = spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in remove_repeats(df).collect()}
    n = len(big)
    assert got[2] == got[3][:0] == [] and got[4] == [(0, 400)]
    assert got[0][0][0] <= 1000 and got[0][-1] == (n - 400, n) and sum(b - a for a, b in got[1]) >= 8000
    pieces = list(suffix_dedup._pieces(np.zeros(suffix_dedup._PIECE * 2 + 10, np.uint8), np.array([0, suffix_dedup._PIECE * 2 + 10]), 400))
    assert len(pieces) == 2 and pieces[1][3] == suffix_dedup._PIECE

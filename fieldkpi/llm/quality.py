"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a row of numeric features. Cyclic boosting visits the
features in turn and adds a shallow tree of one feature's bins to that
feature's lookup table; then it visits the chosen pairs of features the same
way with trees of one cut on each side. A score is the sum of table entries, by
vectorised bin additions, through the logistic function.

Fitting reads a hash sample of at most ``FIT_ROWS`` labelled rows; everything
else covers all documents. Null and empty texts score as a text with no words.
Extra columns are left out of features and kept by the stage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm.common import Words, powers, labelled_sample, slices, text_array

FIT_ROWS = 12_000
BINS = 32
PAIR_BINS = 8
THRESHOLD = 0.7
FEATURES = [
    "log_words", "log_bytes", "bytes_per_word", "upper", "digit", "punct", "symbol", "bang", "pipe", "newline",
    "non_ascii", "space", "stop", "alpha_words", "short_words", "long_words", "distinct_words", "top_word",
    "distinct_pairs", "distinct_lines", "runs", "cap_words", "angle", "punct_words",
]

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = _ALPHA[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b".,;:?'\"-()")] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#$%&*+/=@\\^_`~{}[]")] = True


def _distinct_share(values: np.ndarray, doc: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document: distinct values / values, most frequent value's share (1 and 0 without values)."""
    n = np.bincount(doc, minlength=rows).astype(float)
    order = np.lexsort((values, doc))
    v, d = values[order], doc[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(v)))
    most = np.zeros(rows)
    np.maximum.at(most, d[at], size)
    return np.where(n > 0, np.bincount(d[at], minlength=rows) / np.maximum(n, 1), 1.0), most / np.maximum(n, 1)


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Feature rows (documents x FEATURES) of a slice."""
    w = Words(data, off)
    rows = w.rows
    size = np.diff(off).astype(float)
    per_byte = np.maximum(size, 1)
    nw = np.diff(w.first).astype(float)
    per_word = np.maximum(nw, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(mask)])
        return (c[off[1:]] - c[off[:-1]]) / per_byte

    def words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(w.doc, weights=mask, minlength=rows) / per_word

    length = w.end - w.start
    alpha = np.concatenate([[0], np.cumsum(_ALPHA[data])])
    pun = np.concatenate([[0], np.cumsum(_PUNCT[data])])
    n_alpha = alpha[w.end] - alpha[w.start]
    h = w.hashes()
    distinct, top = _distinct_share(h, w.doc, rows)
    same = w.doc[1:] == w.doc[:-1]
    pairs = (h[:-1] * np.uint64(3) + h[1:])[same]
    pair_share, _ = _distinct_share(pairs, w.doc[1:][same], rows)
    # lines as hashes of their bytes: a line ends at a newline or with its document
    stops = np.union1d(np.flatnonzero(data == 10), off[1:] - 1) if len(data) else np.zeros(0, np.int64)
    stops = stops[stops >= 0]
    if len(stops):
        begin = np.concatenate([[0], stops[:-1] + 1])
        p, inv = powers(len(data) + 1)
        c = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:-1], dtype=np.uint64, out=c[1:])
        last = stops + (data[stops] != 10)
        line = (c[last] - c[begin]) * inv[begin]
        line_doc = np.searchsorted(off, begin, "right") - 1
        lines, _ = _distinct_share(line, line_doc, rows)
    else:
        lines = np.ones(rows)
    same_byte = np.zeros(len(data), bool)
    same_byte[1:] = (data[1:] == data[:-1])
    first = w.data[w.start] if len(w.start) else np.zeros(0, np.uint8)
    return np.column_stack([
        np.log1p(nw), np.log1p(size), size / per_word, share(_UPPER[data]), share(_DIGIT[data]),
        share(_PUNCT[data]), share(_SYMBOL[data]), share(data == 33), share(data == 124), share(data == 10),
        share(data >= 128), share(data == 32), words((length <= 3) & (n_alpha == length)), words(n_alpha == length),
        words(length <= 2), words(length >= 15), distinct, top, pair_share, lines, share(same_byte),
        words(_UPPER[first]), share((data == 60) | (data == 62)), words(pun[w.end] > pun[w.start]),
    ])


# -- model --------------------------------------------------------------------

class Model:
    """``edges``: per feature its bin edges; ``tables``: per feature an entry
    per bin; ``pairs``: (feature, feature, edges, edges, table)."""

    def __init__(self, intercept, edges, tables, pairs):
        self.intercept, self.edges, self.tables, self.pairs = intercept, edges, tables, pairs

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            z += t[np.searchsorted(e, x[:, j], "right")]
        for a, b, ea, eb, t in self.pairs:
            z += t[np.searchsorted(ea, x[:, a], "right"), np.searchsorted(eb, x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Quantile edges, and the quantiles of the outer twentieths, as junk is rare."""
    q = np.concatenate([np.linspace(0, 1, bins + 1)[1:-1], [0.002, 0.005, 0.01, 0.02, 0.98, 0.99, 0.995, 0.998]])
    return np.unique(np.quantile(x, q))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, l2: float) -> np.ndarray:
    """Newton steps of a tree over ordered bins with gradient and curvature sums."""
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    cuts = [0, len(g)]
    for _ in range(leaves - 1):
        best, at = 1e-9, None
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a < 2:
                continue
            m = np.arange(a + 1, b)
            left, right = cg[m] - cg[a], cg[b] - cg[m]
            gain = left**2 / (ch[m] - ch[a] + l2) + right**2 / (ch[b] - ch[m] + l2) - (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + l2)
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, at = gain[k], int(m[k])
        if at is None:
            break
        cuts = sorted([*cuts, at])
    out = np.zeros(len(g))
    for a, b in zip(cuts[:-1], cuts[1:]):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + l2)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[np.ndarray, float]:
    """Newton steps of the best cut on both sides of a pair's grid, and its gain."""
    G, H = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def parts(c):
        ll = c[:-1, :-1]
        lo, le, al = c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return ll, lo - ll, le - ll, al - lo - le + ll

    if g.shape[0] < 2 or g.shape[1] < 2:
        return np.zeros_like(g), 0.0
    gs, hs = parts(G), parts(H)
    gain = sum(a**2 / (b + l2) for a, b in zip(gs, hs))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.empty_like(g)
    v = [a[i, j] / (b[i, j] + l2) for a, b in zip(gs, hs)]
    out[: i + 1, : j + 1], out[: i + 1, j + 1:], out[i + 1:, : j + 1], out[i + 1:, j + 1:] = v
    return out, float(gain[i, j] - G[-1, -1] ** 2 / (H[-1, -1] + l2))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 60, n_pairs: int = 12,
        rate: float = 0.15, leaves: int = 4, l2: float = 3.0) -> Model:
    """Fit by cyclic boosting: first all features in turn, then the pairs with
    the largest gain over what the features leave."""
    n, m = x.shape
    base = float(np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    intercept = float(np.log(base / (1 - base)))
    edges = [_edges(x[:, j], BINS) if n else np.zeros(0) for j in range(m)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    if n == 0 or y.min() == y.max():
        return Model(intercept, edges, tables, [])
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    z = np.full(n, intercept)
    for _ in range(rounds):
        for j in range(m):
            p = 1 / (1 + np.exp(-z))
            step = rate * _tree(np.bincount(bins[j], y - p, len(tables[j])), np.bincount(bins[j], p * (1 - p), len(tables[j])), leaves, l2)
            tables[j] += step
            z += step[bins[j]]
    coarse = [_edges(x[:, j], PAIR_BINS) for j in range(m)]
    cb = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]

    def grids(a, b, p):
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        k = cb[a] * shape[1] + cb[b]
        return (np.bincount(k, y - p, shape[0] * shape[1]).reshape(shape), np.bincount(k, p * (1 - p), shape[0] * shape[1]).reshape(shape))

    p = 1 / (1 + np.exp(-z))
    gains = sorted(((_quadrants(*grids(a, b, p), l2)[1], a, b) for a in range(m) for b in range(a + 1, m)), reverse=True)
    pairs = [(a, b, coarse[a], coarse[b], np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for _, a, b in gains[:n_pairs]]
    for _ in range(pair_rounds):
        for a, b, _ea, _eb, t in pairs:
            p = 1 / (1 + np.exp(-z))
            step = rate * _quadrants(*grids(a, b, p), l2)[0]
            t += step
            z += step[cb[a], cb[b]]
    return Model(intercept, edges, tables, pairs)


# -- operator -----------------------------------------------------------------

def feature_rows(docs: DataFrame, label: str, text_col: str = "text") -> DataFrame:
    """Features of every text beside the column ``label``."""
    def run(batches):
        for batch in batches:
            texts = text_array(batch.column(0))
            for a, b, data, off in slices(texts):
                x = features(data, off)
                yield pa.RecordBatch.from_arrays(
                    [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64())), batch.column(1).slice(a, b - a)],
                    names=["x", "y"])
    return docs.select(text_col, F.col(label).cast("int").alias("y")).mapInArrow(run, "x array<double>, y int")


def train(docs: DataFrame, labels: DataFrame, target: str, id_col: str = "doc_id", text_col: str = "text",
          max_rows: int = FIT_ROWS) -> Model:
    """Fit on the labelled documents (0 or 1 in ``target``), a hash sample of
    about ``max_rows`` of them. The sampled numbers, not texts, reach the driver."""
    got = feature_rows(labelled_sample(docs, labels, target, id_col, text_col, max_rows), "_y").toPandas()
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(FEATURES))
    order = np.lexsort([*x.T, got["y"].to_numpy()])  # the order of rows must not change the fit
    return fit(x[order], got["y"].to_numpy(float)[order])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` for every row of ``docs``."""
    def run(batches):
        for batch in batches:
            texts = text_array(batch.column(1))
            parts = [model.score(features(data, off)) for _, _, data, off in slices(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts) if parts else np.zeros(0))], names=[id_col, "score"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns as they are, whose text scores at least ``threshold``."""
    names = docs.columns

    def run(batches):
        for batch in batches:
            texts = text_array(batch.column(names.index(text_col)))
            parts = [model.score(features(data, off)) for _, _, data, off in slices(texts)]
            yield batch.filter(pa.array(np.concatenate(parts) >= threshold if parts else np.zeros(0, bool)))
    return docs.mapInArrow(run, docs.schema)

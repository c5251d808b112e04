"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Words are runs of letters and digits (every byte above 127 counts as a letter),
A-Z lower-cased. Words, pairs of neighbours and pairs with one word between are
hashed to ``2**BITS`` coordinates; a text has each of its coordinates once.
Every coordinate has its own learning rate, and an L1 penalty holds coordinates
at zero that don't earn their weight; the others are the compact model sent to
the tasks.

Fitting runs in one task over a hash sample of at most about ``FIT_ROWS``
labelled rows; scoring covers all whole texts. Null and empty texts have no
words and score by the intercept. An empty table gives an empty result;
further columns are ignored. Rows that repeat get equal scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm.common import U64, Words, mix, labelled_sample, slices, text_array

FIT_ROWS = 20_000
BITS = 20
EPOCHS = 4
THRESHOLD = 0.7
GAPS = np.ones(256, bool)
GAPS[48:58] = GAPS[65:91] = GAPS[97:123] = GAPS[128:] = False


def coordinates(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, coordinate) of every word, neighbour pair and skip pair of a slice."""
    w = Words(data, off, GAPS)
    h = w.hashes()
    docs, idx = [w.doc], [h]
    for gap, mult in ((1, 3), (2, 5)):
        same = w.doc[gap:] == w.doc[:-gap] if len(h) > gap else np.zeros(0, bool)
        docs.append(w.doc[: len(same)][same])
        idx.append(mix(h[: len(same)] * U64(mult) + h[gap:][: len(same)])[same])
    return np.concatenate(docs), (np.concatenate(idx) >> U64(64 - BITS)).astype(np.int64)


class Ftrl:
    """State per coordinate; the last one is the intercept, without penalty."""

    def __init__(self, alpha: float = 6.0, beta: float = 1.0, l1: float = 4.0, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, i: np.ndarray) -> np.ndarray:
        z, l1 = self.z[i], np.where(i == 1 << BITS, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(self.n[i])) / self.alpha + self.l2))

    def learn(self, i: np.ndarray, y: float) -> None:
        w = self.weights(i)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[i] = n + g * g


def train(docs: DataFrame, labels: DataFrame, target: str, id_col: str = "doc_id", text_col: str = "text",
          max_rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, weights) other than zero, the intercept last."""
    drawn = labelled_sample(docs, labels, target, id_col, text_col, max_rows)
    sample = drawn.select(F.xxhash64(id_col, "text").alias("at"), "text", "_y")

    def rows(batches):
        for batch in batches:
            for a, b, data, off in slices(text_array(batch.column(1))):
                doc, idx = coordinates(data, off)
                both = np.unique(doc * (1 << BITS) + idx)
                doc, idx = both >> BITS, (both & ((1 << BITS) - 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(np.searchsorted(doc, np.arange(b - a + 1)).astype(np.int32), pa.array(idx))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists, batch.column(2).slice(a, b - a)], names=["at", "i", "y"])

    def fit(batches):
        at, lists, ys = [], [], []
        for batch in batches:
            at += batch.column(0).to_pylist()
            lists += [x.values.to_numpy() for x in batch.column(1)]
            ys += batch.column(2).to_pylist()
        model = Ftrl()
        order = sorted(range(len(at)), key=lambda k: (at[k], ys[k]))
        for epoch in range(EPOCHS):
            for k in np.random.default_rng(epoch).permutation(order) if order else []:
                model.learn(np.append(lists[k], 1 << BITS), ys[k])
        every = np.arange((1 << BITS) + 1)
        w = model.weights(every)
        keep = (w != 0) | (every == 1 << BITS)
        yield pa.RecordBatch.from_arrays([pa.array(every[keep]), pa.array(w[keep])], names=["i", "w"])

    drawn = sample.mapInArrow(rows, "at long, i array<int>, y int").repartition(1)  # the bounded sample only: texts are read in many tasks
    got = drawn.mapInArrow(fit, "i long, w double").toPandas().sort_values("i")
    return got["i"].to_numpy(), got["w"].to_numpy()


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` for every row of ``docs``."""
    index, weight = model

    def run(batches):
        table = np.zeros((1 << BITS) + 1)
        table[index] = weight
        for batch in batches:
            parts = []
            for a, b, data, off in slices(text_array(batch.column(1))):
                doc, idx = coordinates(data, off)
                hit = np.flatnonzero(table[idx])
                both = np.unique(doc[hit] * (1 << BITS) + idx[hit])
                z = np.bincount(both >> BITS, table[both & ((1 << BITS) - 1)], b - a) + table[-1]
                parts.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts) if parts else np.zeros(0))], names=[id_col, "score"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, score double")

"""Language ID by multilingual mixture inference.

Letters of the lower-cased text are read as byte trigrams, with anything else as
a blank, and hashed to ``BUCKETS`` counts. Each language has a smoothed
distribution over them. A document is taken as a mixture of languages whose
proportions expectation-maximisation estimates; then the language sets made of
its one, two ... most likely languages are compared by penalised likelihood
(log-likelihood less ``PENALTY`` for each further language), and the best set's
largest proportion names the language.

Counts cover all training documents, and a whole text each. Null texts and texts
without a letter are ``und`` with score 0, as is everything if nothing was
learned. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm.common import LOWER, slices, text_array

BUCKETS = 4096
ROUNDS = 12
PENALTY = 12.0
SMOOTH = 0.5
UND = "und"
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def trigram_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Documents x BUCKETS counts of a slice."""
    rows = len(off) - 1
    out = np.zeros((rows, BUCKETS), np.float32)
    if len(data) < 3:
        return out
    c = np.where(_LETTER[data], LOWER[data], 32).astype(np.uint32)
    gram = (c[:-2] << np.uint32(16)) | (c[1:-1] << np.uint32(8)) | c[2:]
    doc = np.searchsorted(off, np.arange(len(gram)), "right") - 1 if rows == 1 else np.repeat(np.arange(rows), np.diff(off))[: len(gram)]
    keep = (np.arange(2, len(gram) + 2) < off[1:][doc]) & ((c[1:-1] != 32) | ((c[:-2] != 32) & (c[2:] != 32)))
    bucket = ((gram * np.uint32(2654435761)) >> np.uint32(32 - 12)).astype(np.int64)
    for a in range(0, rows, 256):
        b = min(rows, a + 256)
        sel = slice(int(off[a]), min(int(off[b]), len(gram)))
        k = keep[sel]
        out[a:b] = np.bincount((doc[sel][k] - a) * BUCKETS + bucket[sel][k], minlength=(b - a) * BUCKETS).reshape(b - a, BUCKETS)
    return out


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """(languages, languages x BUCKETS probabilities) from the rows with a language."""
    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for a, b, data, off in slices(text_array(batch.column(0))):
                counts = trigram_counts(data, off)
                names = np.array(langs[a:b], object)
                for name in set(langs[a:b]):
                    sums[name] = sums.get(name, 0) + counts[names == name].sum(0, dtype=np.float64)
        for name, v in sums.items():
            hit = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(hit), pa.string()), pa.array(hit), pa.array(v[hit])], names=["lang", "bucket", "n"])
    counted = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(text_col, lang_col).mapInArrow(run, "lang string, bucket long, n double")
    got = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages x BUCKETS rows at most
    langs = sorted(got["lang"].unique())
    table = np.full((len(langs), BUCKETS), SMOOTH)
    table[[langs.index(x) for x in got["lang"]], got["bucket"].to_numpy(int)] += got["n"].to_numpy()
    return langs, table / table.sum(1, keepdims=True)


def _em(counts: np.ndarray, probs: np.ndarray, share: np.ndarray, rounds: int) -> np.ndarray:
    """Proportions after ``rounds`` of expectation and maximisation; ``share``: start, zeros stay."""
    total = np.maximum(counts.sum(1, keepdims=True), 1)
    for _ in range(rounds):
        mixed = share @ probs
        share = share * ((counts / np.maximum(mixed, 1e-12)) @ probs.T) / total
    return share / np.maximum(share.sum(1, keepdims=True), 1e-12)


def infer(counts: np.ndarray, probs: np.ndarray) -> np.ndarray:
    """Documents x languages proportions of each document's best language set. A
    larger set is left untried only where no proportions at all could pay for it."""
    rows, n = len(counts), len(probs)
    p = probs.astype(np.float32)
    single = counts @ np.log(p).T  # log-likelihood of each language alone
    share = _em(counts, p, np.full((rows, n), 1 / n, np.float32), ROUNDS)
    best = np.zeros((rows, n), np.float32)
    top = np.argsort(-share, axis=1, kind="stable")
    alone = single.argmax(1)
    best[np.arange(rows), alone] = 1
    value = (counts * np.log(p[alone])).sum(1, dtype=float)
    # what no set can exceed: the likelihood is concave, so it lies below its tangent at ``share``
    total = np.maximum(counts.sum(1, dtype=float), 1)
    mix = np.maximum(share @ p, 1e-12)
    slope = ((counts / mix) @ p.T).max(1) / total
    bound = (counts * np.log(mix)).sum(1, dtype=float) + total * np.log(np.maximum(slope, 1)) + 1e-5 * total
    for k in range(2, n + 1):
        mixed = np.flatnonzero(bound - PENALTY * (k - 1) > value)
        if not len(mixed):
            break
        start = np.zeros((len(mixed), n), np.float32)
        at = np.arange(len(mixed))[:, None], top[mixed, :k]
        start[at] = np.maximum(share[mixed][at], 1e-3)
        some = _em(counts[mixed], p, start / start.sum(1, keepdims=True), ROUNDS)
        got = (counts[mixed] * np.log(np.maximum(some @ p, 1e-12))).sum(1, dtype=float) - PENALTY * (k - 1)
        better = got > value[mixed]
        best[mixed[better]], value[mixed[better]] = some[better], got[better]
    return best


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs``: id, ``lang_pred``, ``score`` (its proportion)
    and ``langs``, the chosen set as name:proportion, largest first."""
    names, probs = model

    def run(batches):
        for batch in batches:
            preds, scores, sets = [], [], []
            texts = text_array(batch.column(1))
            for a, b, data, off in slices(texts):
                for lo in range(0, b - a, 256):
                    hi = min(b - a, lo + 256)
                    part, at = data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
                    share = infer(trigram_counts(part, at), probs) if names else np.zeros((hi - lo, 1))
                    for i in range(hi - lo):
                        raw = part[at[i]: at[i + 1]]
                        ascii_letter = bool((_LETTER[raw] & (raw < 128)).any())
                        if not names or not (ascii_letter or any(ch.isalpha() for ch in raw.tobytes().decode("utf8", "replace"))):
                            preds.append(UND), scores.append(0.0), sets.append("")
                            continue
                        order = np.argsort(-share[i], kind="stable")
                        preds.append(names[order[0]])
                        scores.append(float(min(1.0, share[i][order[0]])))
                        sets.append(",".join(f"{names[j]}:{share[i][j]:.3f}" for j in order if share[i][j] > 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.string())],
                                             names=["id", "lang_pred", "score", "langs"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, lang_pred string, score double, langs string").withColumnRenamed("id", id_col)

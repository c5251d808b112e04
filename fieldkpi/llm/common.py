"""Shared helpers: scratch tables, bounded broadcasts, vectorised text buffers.

The text helpers work on one Arrow batch at a time. Whole texts are read from
the batch's byte buffer, in slices of whole documents, so a task's memory is
bounded by the slice size or its longest document.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldkpi.session import ensure_checkpoint_dir

SLICE_BYTES = 1 << 18
FILE_ROWS = 500_000
U64 = np.uint64


# -- Spark side ---------------------------------------------------------------

def stored(df: DataFrame, name: str, rows: int | None = None, per_file: int = FILE_ROWS) -> DataFrame:
    """Write ``df`` as Parquet into the cluster's shared checkpoint folder and
    read it back: cuts the lineage, and survives the loss of executors. ``rows``,
    the most rows it can have, if known, keeps a small table to a few files a
    core, of ``per_file`` rows at most: each file costs as much as many rows."""
    if rows is not None:
        df = df.coalesce(max(4 * df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / per_file)))
    return stored_at(df, name)[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`stored`, with the table's path."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a table that :func:`stored_at` wrote and that no later plan reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcast if its counted rows stay within ``max_rows``;
    beyond that as it is, for a shuffled join. ``df`` must be cheap to count."""
    return F.broadcast(df) if df.count() <= max_rows else df


def broadcast_within(df: DataFrame, row_bytes: Column, max_bytes: int) -> DataFrame:
    """As :func:`bounded_broadcast`, by the summed ``row_bytes``; for rows of any length."""
    return F.broadcast(df) if (df.agg(F.sum(row_bytes)).first()[0] or 0) <= max_bytes else df


def crc_mod(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % mod


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def sample_fraction(rows: DataFrame, key: str, max_rows: int) -> DataFrame:
    """A repeatable hash sample of about ``max_rows`` rows at most (all rows,
    if there are fewer). Only for fitting a classifier on labelled rows."""
    n = rows.count()
    if n <= max_rows:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("fit"), F.col(key)), F.lit(1_000_000)) < int(1e6 * max_rows / n))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, id_col: str, text_col: str, max_rows: int) -> DataFrame:
    """About ``max_rows`` rows at most to fit a classifier on: ``id_col``, ``text``
    and ``_y``, the label (0 or 1). Ids are sampled by hash; rows that repeat an id
    and text are one, and where an id has many texts these are sampled again."""
    known = labels.where(F.col(target).isin(0, 1)).groupBy(id_col).agg(F.max(target).alias("_y"))
    sample = F.broadcast(sample_fraction(known, id_col, max_rows))
    rows = docs.select(id_col, F.col(text_col).alias("text")).join(sample, id_col).withColumn("__key", F.xxhash64(id_col, "text"))
    rows = stored(rows.dropDuplicates(["__key"]), "fit_rows")
    return sample_fraction(rows, "__key", max_rows).drop("__key")


# -- text buffers -------------------------------------------------------------

def _lut(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


WHITESPACE = _lut(b" \t\n\x0b\x0c\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MULT = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier modulo 2**64, and of its inverse."""
    if len(_POWERS.get("p", ())) < n:
        n2 = max(n, SLICE_BYTES + 1)
        for k, base in (("p", _MULT), ("i", pow(_MULT, -1, 1 << 64))):
            a = np.full(n2, base, U64)
            a[0] = 1
            _POWERS[k] = np.cumprod(a, dtype=U64)
    return _POWERS["p"][:n], _POWERS["i"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(29)
    h *= U64(0xC2B2AE3D27D4EB4F)
    h ^= h >> U64(32)
    return h


def text_array(column) -> pa.Array:
    """A string column of a batch as a string array with '' for null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    return pc.fill_null(column, "")


def slices(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of consecutive
    rows with up to ``max_bytes`` bytes, or of one longer row."""
    n = len(texts)
    if not n:
        return
    bufs = texts.buffers()
    off = np.frombuffer(bufs[1], np.int64)[texts.offset: texts.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + max_bytes, "right")) - 1)
        b = min(b, n)
        yield a, b, data[off[a]: off[b]], off[a: b + 1] - off[a]
        a = b


class Words:
    """Words (runs of bytes that aren't ``gaps``, by default whitespace) of a slice.

    ``start``, ``end``: byte positions; ``doc``: row in the slice; ``first``:
    per row the index of its first word, with one more entry at the end;
    ``hash``: 64-bit hashes of the words with A-Z lower-cased."""

    def __init__(self, data: np.ndarray, off: np.ndarray, gaps: np.ndarray = WHITESPACE):
        n, rows = len(data), len(off) - 1
        self.data, self.off, self.rows = data, off, rows
        solid = ~gaps[data]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        before = np.zeros(n, bool)
        before[1:] = solid[:-1]
        after = np.zeros(n, bool)
        after[:-1] = solid[1:]
        self.start = np.flatnonzero(solid & (~before | edge[:n]))
        self.end = np.flatnonzero(solid & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, off)
        self.doc = np.repeat(np.arange(rows), np.diff(self.first))
        self.low = LOWER[data]

    def hashes(self) -> np.ndarray:
        p, inv = powers(len(self.data) + 1)
        h = np.zeros(len(self.data) + 1, U64)
        np.cumsum((self.low.astype(U64) + U64(1)) * p[:-1], dtype=U64, out=h[1:])
        return mix((h[self.end] - h[self.start]) * inv[self.start])


def window_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words, and per document the index of its
    first one (one more entry at the end). A document with fewer words has its
    whole sequence as its one window; without words it has none."""
    counts = np.diff(first)
    n = len(words)
    long = counts >= size
    h = np.zeros(n, U64)
    if n >= size:
        full = np.zeros(n - size + 1, U64)
        for j in range(size):
            full += words[j: n - size + 1 + j] * U64((0xA0761D6478BD642F + 0x9E3779B97F4A7C16 * j) & 0xFFFFFFFFFFFFFFFF | 1)
        h[: n - size + 1] = mix(full)
    doc = np.repeat(np.arange(len(counts)), counts)
    pos = np.arange(n) - first[:-1][doc]
    keep = long[doc] & (pos <= counts[doc] - size)
    for d in np.flatnonzero(~long & (counts > 0)):
        a, b = first[d], first[d + 1]
        s = U64(0x51ED27 + int(b - a))
        for x in words[a:b]:
            s = mix(np.array([(int(s) * 31 + int(x)) & 0xFFFFFFFFFFFFFFFF], U64))[0]
        h[a] = s
        keep[a] = True
    n_win = np.where(long, counts - size + 1, (counts > 0).astype(counts.dtype))
    return h[keep], np.concatenate([[0], np.cumsum(n_win)])

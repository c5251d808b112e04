"""Vector code compression: product codes by exact k-means with norm-of-sum bounds.

Components become integers ``floor(scale * x)``, a vector is cut into consecutive
parts, and each part position has a codebook of a few entries. A round assigns
every part to its nearest entry (squared distance, ties to the lower index), then
moves each entry to its parts' componentwise floored mean.

Most parts keep their entry, and bounds prove it without a scan of the codebook.
A row carries, for each part, an upper bound of the distance to its entry and a
lower bound of the distance to every other entry, each with the round in which it
was measured. All codebooks of earlier rounds are retained, so a bound is carried
to the present by the *net* displacement of an entry since the bound's own round
(the norm of the sum of its moves), which is never more than the sum of the moves'
norms. Where the bounds still leave doubt, first the distance to the own entry is
measured anew, and then all entries are rescanned. Integers make every distance,
sum and mean exact; a tie never passes the bounds, which need a strict order.

The rows and their state are one table, written again each round in the shared
folder; a batch's first row also holds what the batch's changed parts add to or
take from the sums. The driver sees the codebooks and these sums only, both of
the codebook's size.

Vectors that are null or hold a null, NaN or infinite component take no part, nor
do vectors whose length isn't the table's most frequent one (ties: the longest).
The first entries are the parts of the smallest ids; repeated ids go by the
vector, null ids come last. With fewer rows than entries the codebooks are that
much shorter. A length that the parts don't divide is cut as evenly as possible.
Empty tables give an empty result. A component so large that squared distances
would leave 64 bits ends the job with an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldkpi.llm.common import bounded_broadcast, discard, stored, stored_at

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
MAX_BROADCAST_LABELS = 200_000
CHUNK = 1 << 21  # components worked on at once in a task

# what a row keeps for each part: its entry, the two bounds and the rounds they were measured in
STATE = np.dtype([("code", "u1"), ("near", "f4"), ("far", "f4"), ("near_at", "u1"), ("far_at", "u1")])


@dataclass
class Coded:
    """``rows``: the kept columns, ``codes`` (a byte per part) and ``error``; ``history``: the codebooks
    before each round and after the last (entries x dimensions); ``rescans``: parts scanned in full, by pass."""

    rows: DataFrame
    history: list[np.ndarray]
    edges: np.ndarray
    rescans: list[int] = field(default_factory=list)

    def codebook_text(self) -> str:
        """All final components by part, entry and position, comma-joined."""
        if not self.history:
            return ""
        last = self.history[-1]
        return ",".join(str(v) for a, b in zip(self.edges[:-1], self.edges[1:]) for v in last[:, a:b].ravel().tolist())


def usable(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(False))


def quantised(flat: np.ndarray, dim: int, scale: int) -> np.ndarray:
    v = np.floor(scale * flat.astype(np.float64)).reshape(-1, dim)
    limit = np.sqrt(2.0 ** 61 / max(dim, 1)) / 2
    if v.size and np.abs(v).max() >= limit:
        raise ValueError(f"a component reaches {np.abs(v).max():.0f} after scaling; squared distances need less than {limit:.0f}")
    return v.astype(np.int64)


def _up(squared: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(squared).astype(np.float32), np.float32(np.inf))


def _down(squared: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(squared).astype(np.float32), np.float32(-np.inf))


def _scan(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry (lowest index of ties), its squared distance and the second smallest one."""
    d = np.empty((len(entries), len(x)), np.int64)
    for j, e in enumerate(entries):
        d[j] = ((x - e) ** 2).sum(1)
    code = d.argmin(0)
    rows = np.arange(len(x))
    best = d[code, rows]
    second = np.full(len(x), np.inf)
    if len(entries) > 1:
        d[code, rows] = np.iinfo(np.int64).max
        second = d.min(0).astype(np.float64)
    return code, best, second


class Pass:
    """One assignment of all parts to the newest codebook of ``history``."""

    def __init__(self, history: list[np.ndarray], edges: np.ndarray):
        self.history, self.edges = history, edges
        self.now, self.parts = len(history) - 1, len(edges) - 1
        # net displacement of every entry since each earlier round, and the largest one among the other entries
        self.moved = np.zeros((self.now + 1, self.parts, len(history[-1])))
        for t, old in enumerate(history):
            for p in range(self.parts):
                a, b = edges[p: p + 2]
                self.moved[t, p] = np.sqrt(((history[-1][:, a:b] - old[:, a:b]) ** 2).sum(1).astype(np.float64))
        ranked = np.sort(self.moved, axis=2)
        second = ranked[:, :, -2] if ranked.shape[2] > 1 else np.zeros(ranked.shape[:2])
        self.others = np.where(self.moved == ranked[:, :, -1:], second[:, :, None], ranked[:, :, -1:])
        many = (self.moved == ranked[:, :, -1:]).sum(2) > 1
        self.others[many] = np.broadcast_to(ranked[:, :, -1:], self.others.shape)[many]

    def assign(self, x: np.ndarray, state: np.ndarray, fresh: bool) -> int:
        """Brings ``state`` (rows x parts) to this round; returns how many parts were scanned."""
        scanned = 0
        for p in range(self.parts):
            a, b = self.edges[p: p + 2]
            xs, entries, s = x[:, a:b], self.history[-1][:, a:b], state[:, p]
            if fresh:
                todo = np.arange(len(x))
            else:
                code = s["code"]
                far = s["far"] - self.others[s["far_at"], p, code]
                doubt = np.flatnonzero(~(s["near"] + self.moved[s["near_at"], p, code] < far))
                s["near"][doubt] = _up(((xs[doubt] - entries[code[doubt]]) ** 2).sum(1))
                s["near_at"][doubt] = self.now
                todo = doubt[~(s["near"][doubt] < far[doubt])]
            code, best, second = _scan(xs[todo], entries)
            s["code"][todo], s["near"][todo], s["far"][todo] = code, _up(best), _down(second)
            s["near_at"][todo] = s["far_at"][todo] = self.now
            scanned += len(todo)
        return scanned

    def errors(self, x: np.ndarray, state: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for p in range(self.parts):
            a, b = self.edges[p: p + 2]
            out += ((x[:, a:b] - self.history[-1][state["code"][:, p], a:b]) ** 2).sum(1)
        return out


def _changes(x: np.ndarray, new: np.ndarray, old: np.ndarray | None, edges: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
    """Adds each changed part to its new entry's sum and takes it from its old one's."""
    for p in range(len(edges) - 1):
        a, b = edges[p: p + 2]
        rows = np.arange(len(x)) if old is None else np.flatnonzero(new[:, p] != old[:, p])
        np.add.at(sums[:, a:b], new[rows, p], x[rows, a:b])
        np.add.at(counts[p], new[rows, p], 1)
        if old is not None:
            np.subtract.at(sums[:, a:b], old[rows, p], x[rows, a:b])
            np.subtract.at(counts[p], old[rows, p], 1)


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a C-ordered array as binary values."""
    n, size = len(rows), rows.dtype.itemsize * (rows.shape[1] if rows.ndim > 1 else 1)
    offsets = (np.arange(n + 1, dtype=np.int64) * size).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    bufs = column.buffers()
    off = np.frombuffer(bufs[1], np.int32)[column.offset: column.offset + len(column) + 1]
    return np.frombuffer(bufs[2], np.uint8)[off[0]: off[-1]].view(dtype).reshape(len(column), width)


def _round(keep: list[str], history: list[np.ndarray], edges: np.ndarray, scale: int, fresh: bool, last: bool):
    dim, parts = int(edges[-1]), len(edges) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = Pass(history, edges)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if fresh:
                flat = batch.column("__vc_x").flatten()
                x = quantised(flat.to_numpy(zero_copy_only=False), dim, scale)
                state = np.zeros((n, parts), STATE)
            else:
                x = _matrix(batch.column("__vc_x"), np.int32, dim)
                state = _matrix(batch.column("__vc_state"), STATE, parts).copy()
            sums, counts = np.zeros((len(history[-1]), dim), np.int64), np.zeros((parts, len(history[-1])), np.int64)
            scanned, errors = 0, np.zeros(n, np.int64)
            size = max(1, CHUNK // dim)
            for a in range(0, n, size):
                xs, s = x[a: a + size].astype(np.int64), state[a: a + size]
                old = None if fresh else s["code"].copy()
                scanned += step.assign(xs, s, fresh)
                if last:
                    errors[a: a + size] = step.errors(xs, s)
                else:
                    _changes(xs, s["code"], old, edges, sums, counts)
            delta = np.concatenate([sums.ravel(), counts.ravel(), [scanned]]).astype(np.int64)
            kept = [batch.column(c) for c in keep]
            first = pa.array([delta.tobytes()] + [None] * (n - 1), pa.binary())
            if last:
                yield pa.RecordBatch.from_arrays([*kept, _binary(state["code"]), pa.array(errors), first], [*keep, "codes", "error", "__vc_delta"])
            else:
                yield pa.RecordBatch.from_arrays([*kept, _binary(x.astype(np.int32)), _binary(state), first],
                                                 [*keep, "__vc_x", "__vc_state", "__vc_delta"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's deltas as one sum: a row per position."""
    total = None
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            d = np.frombuffer(raw, np.int64)
            total = d.copy() if total is None else total + d
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["pos", "value"])


def _delta(rows: DataFrame) -> np.ndarray:
    parts = rows.where(F.col("__vc_delta").isNotNull()).select("__vc_delta").mapInArrow(_added, "pos long, value long")
    got = parts.groupBy("pos").agg(F.sum("value").alias("value")).collect()  # as many rows as a codebook has numbers
    out = np.zeros(len(got), np.int64)
    for r in got:
        out[r["pos"]] = r["value"]
    return out


def encode(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", keep: tuple[str, ...] = (), parts: int = PARTS,
           entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Coded:
    """Codebooks and codes of ``vectors``; the rows keep ``id_col`` and the columns ``keep``."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's index is one byte")
    spark, names = vectors.sparkSession, [id_col, *keep]
    kept = vectors.where(usable(F.col(vec_col)))
    lengths = kept.groupBy(F.size(vec_col).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    fields = [vectors.schema[c] for c in names]
    if not lengths or not lengths[0]["d"]:
        out = T.StructType([*fields, T.StructField("codes", T.BinaryType()), T.StructField("error", T.LongType())])
        return Coded(spark.createDataFrame([], out), [], np.zeros(parts + 1, np.int64))
    dim = lengths[0]["d"]
    kept = kept.where(F.size(vec_col) == dim).select(*names, F.col(vec_col).alias("__vc_x"))
    start = kept.orderBy(F.col(id_col).asc_nulls_last(), "__vc_x").limit(entries).collect()
    history = [quantised(np.array([r["__vc_x"] for r in start]), dim, scale)]
    edges = np.arange(parts + 1) * dim // parts
    size = len(history[0]) * dim
    state = T.StructType([*fields, *(T.StructField(c, T.BinaryType()) for c in ("__vc_x", "__vc_state", "__vc_delta"))])
    sums, counts = np.zeros((len(history[0]), dim), np.int64), np.zeros((parts, len(history[0])), np.int64)
    rows, path, rescans = kept, None, []
    for t in range(rounds):
        done, new = stored_at(rows.mapInArrow(_round(names, list(history), edges, scale, t == 0, False), state), "vc_round")
        if path:
            discard(spark, path)
        rows, path = done, new
        delta = _delta(rows)
        sums += delta[:size].reshape(sums.shape)
        counts += delta[size:-1].reshape(counts.shape)
        rescans.append(int(delta[-1]))
        entry = history[-1].copy()
        for p in range(parts):
            a, b = edges[p: p + 2]
            used = np.flatnonzero(counts[p])
            entry[used, a:b] = sums[used, a:b] // counts[p, used, None]
        history.append(entry)
    final = T.StructType([*fields, T.StructField("codes", T.BinaryType()), T.StructField("error", T.LongType()), T.StructField("__vc_delta", T.BinaryType())])
    rows = stored(rows.mapInArrow(_round(names, history, edges, scale, not rounds, True), final), "vc_codes")
    if path:
        discard(spark, path)
    rescans.append(int(_delta(rows)[-1]))
    return Coded(rows.drop("__vc_delta"), history, edges, rescans)


def digest(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """The contract's columns for ``vec_id``, ``embedding`` and ``label``."""
    got = encode(vectors, keep=("label",))
    per_label = got.rows.groupBy(F.col("label").alias("__vc_label")).agg(F.sum("error").alias("label_error"))
    rows = got.rows.join(bounded_broadcast(per_label, MAX_BROADCAST_LABELS), F.col("label").eqNullSafe(F.col("__vc_label")))
    return rows.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
                       F.sha2(F.lit(got.codebook_text()), 256).alias("codebooks_sha256"))


def digest_sql(table: str = "embeddings", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL for :func:`digest`: every part meets every entry in each round (small tables)."""
    def assigned(t: int) -> str:
        return f"""a{t} AS MATERIALIZED (
  SELECT vec_id, p.part, any_value(x) AS x,
         min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * {entries} + e) AS m
  FROM p JOIN c{t} ON c{t}.part = p.part GROUP BY vec_id, p.part)"""

    def moved(t: int) -> str:
        return f"""u{t} AS MATERIALIZED (SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
    SELECT part, e, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n
    FROM (SELECT part, m % {entries} AS e, x, unnest(range(1, len(x) + 1)) AS i FROM a{t}) GROUP BY part, e, i) GROUP BY part, e),
c{t + 1} AS MATERIALIZED (SELECT c{t}.part, c{t}.e, coalesce(u{t}.c, c{t}.c) AS c FROM c{t} LEFT JOIN u{t} ON u{t}.part = c{t}.part AND u{t}.e = c{t}.e)"""

    steps = ",\n".join(f"{assigned(t)},\n{moved(t)}" for t in range(rounds))
    return f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM {table}
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
p AS MATERIALIZED (SELECT vec_id, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS x FROM k, range({parts}) r(part)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k QUALIFY e < {entries}),
c0 AS MATERIALIZED (SELECT part, e, x AS c FROM p JOIN f USING (vec_id)),
{steps},
{assigned(rounds)},
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM c{rounds}),
r AS (SELECT vec_id, string_agg(printf('%02x', CAST(m % {entries} AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
SELECT k.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM k JOIN r USING (vec_id), h"""

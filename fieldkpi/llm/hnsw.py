"""Approximate nearest neighbours: a navigable small-world graph per shard.

Equal vectors become one node with their smallest ids (a query needs no more of
them than it returns, and one for itself). Nodes are dealt to shards of about
``SHARD_ROWS`` by the band of their norm, and within it by a hash: in a shard with
one far longer vector no link would lead to that vector. A shard's index is one row of flat arrays: a node's
level is drawn from its id's hash, each level has ``neighbours`` with a fixed
number of slots per node, and every higher level holds a sixteenth of the nodes.

Largest inner product becomes nearest direction: a node is scaled by the
shard's longest vector and gets one more component that makes its length one.
A node's links go to near nodes in different directions (a candidate nearer to
a chosen link than to the node is passed over), and back, and along a ring that
keeps each level in one piece. A search goes down the levels greedily, then
holds a beam on the lowest; all queries of a block go in step. Each query goes to
every shard, and the shards' results are merged by exact scores on the original
vectors in double precision, ties to the smaller id.

Vectors that are null, empty, zero, or hold null or non-finite components take
no part; nor do rows with a null id. Rows that repeat an id count once per
distinct vector. Queries only meet vectors of their own length. Fewer candidates
give shorter results; an empty table gives none; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldkpi.llm.common import bounded_broadcast, stored

SHARD_ROWS = 8192
BAND = 8  # longest to shortest norm of a shard
BLOCK_QUERIES = 1024
LINKS = 16  # slots of a node on the higher levels; twice as many on the lowest
CANDIDATES = 48
BEAM = 128
STEP = 4  # nodes opened at a time


# -- graph (numpy, one shard) -------------------------------------------------

def _links(x: np.ndarray, last: np.ndarray, slots: int) -> np.ndarray:
    """Flat neighbours (nodes x slots, -1: none) of the unit vectors (``x``, ``last``).

    Nearness is half the squared distance, in double precision and negated: the
    products are all near 1 where one vector is much longer than the others, so
    their differences would be lost."""
    n = len(x)
    out = np.full((n, slots), -1, np.int32)
    if n < 2:
        return out
    k = min(CANDIDATES, n - 1)
    half = (x**2).sum(1) / 2
    src, dst, sim = [], [], []
    for a in range(0, n, 256):
        part = x[a: a + 256] @ x.T
        part -= half[a: a + 256, None] + half + (last[a: a + 256, None] - last) ** 2 / 2
        m = len(part)
        part[np.arange(m), np.arange(a, a + m)] = -np.inf
        near = np.argpartition(-part, k - 1, axis=1)[:, :k]
        s = np.take_along_axis(part, near, 1)
        by = np.argsort(-s, axis=1, kind="stable")
        near, s = np.take_along_axis(near, by, 1), np.take_along_axis(s, by, 1)
        vec = x[near]
        among = vec @ vec.transpose(0, 2, 1)
        among -= half[near][:, :, None] + half[near][:, None, :] + (last[near][:, :, None] - last[near][:, None, :]) ** 2 / 2
        chosen = np.zeros((m, k), bool)
        for j in range(k):
            covered = (chosen[:, :j] & (among[:, j, :j] > s[:, j: j + 1])).any(1)
            chosen[:, j] = ~covered & (chosen.sum(1) < slots // 2)
        # slots that are left go to the nearest
        fill = ~chosen & ((~chosen).cumsum(1) <= (slots // 2 - chosen.sum(1))[:, None])
        i, j = np.nonzero(chosen | fill)
        src.append(i + a), dst.append(near[i, j]), sim.append(s[i, j])
    src, dst, sim = np.concatenate(src), np.concatenate(dst), np.concatenate(sim)
    ring = np.arange(n)
    s = np.concatenate([ring, src, dst])
    d = np.concatenate([(ring + 1) % n, dst, src])
    kind = np.repeat([0, 1, 2], [n, len(src), len(src)])  # the ring, then own links, then links back
    order = np.lexsort((np.concatenate([np.zeros(n), -sim, -sim]), kind, s))
    s, d = s[order], d[order]
    _, first = np.unique(s * n + d, return_index=True)
    keep = np.zeros(len(s), bool)
    keep[first] = True  # lexsort is stable: of equal links the first, so the best ranked, stays
    s, d = s[keep], d[keep]
    at = np.arange(len(s)) - np.searchsorted(s, s)
    ok = at < slots
    out[s[ok], at[ok]] = d[ok]
    return out


def build(vectors: np.ndarray, draws: np.ndarray) -> dict:
    """Index of a shard; ``draws``: a number in (0, 1] per node, for its level."""
    norms = np.sqrt((vectors.astype(float) ** 2).sum(1))
    top = norms.max() if len(norms) else 1.0
    scaled = vectors.astype(float) / top
    last = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(1)))
    unit = np.column_stack([scaled, last]).astype(np.float32)
    level = np.floor(-np.log(draws) / math.log(LINKS)).astype(int)
    levels = []
    for lv in range(int(level.max()) + 1 if len(level) else 0):
        nodes = np.flatnonzero(level >= lv)
        levels.append((nodes.astype(np.int32), _links(scaled[nodes], last[nodes], LINKS * (2 if lv == 0 else 1))))
    return {"unit": unit, "levels": levels}


def search(index: dict, queries: np.ndarray, k: int, beam: int = BEAM) -> np.ndarray:
    """Per query (unit vectors with a last component 0) the nodes of its beam, best first, -1 where there are fewer."""
    unit, levels = index["unit"], index["levels"]
    q, n = len(queries), len(unit)
    entry = np.zeros(q, np.int64)  # numbers within the level
    for lv in range(len(levels) - 1, 0, -1):
        nodes, links = levels[lv]
        if lv == len(levels) - 1:
            entry[:] = 0
        vec = unit[nodes]
        cur = np.einsum("qd,qd->q", queries, vec[entry])
        while True:
            near = links[entry]
            s = np.where(near >= 0, np.einsum("qd,qmd->qm", queries, vec[near]), -np.inf)
            j = s.argmax(1)
            better = s[np.arange(q), j] > cur
            if not better.any():
                break
            entry = np.where(better, near[np.arange(q), j], entry)
            cur = np.maximum(cur, s[np.arange(q), j])
        below = levels[lv - 1][0]
        entry = np.searchsorted(below, nodes[entry])
    links = levels[0][1]
    beam = max(beam, k)
    ids = np.full((q, beam), -1, np.int64)
    sims = np.full((q, beam), -np.inf, np.float32)
    opened = np.ones((q, beam), bool)
    seen = np.zeros((q, n), bool)
    ids[:, 0], opened[:, 0] = entry, False
    sims[:, 0] = np.einsum("qd,qd->q", queries, unit[entry])
    seen[np.arange(q), entry] = True
    live = np.arange(q)
    while len(live):
        waiting = np.where(opened[live], -np.inf, sims[live])
        pick = np.argsort(-waiting, axis=1, kind="stable")[:, :STEP]
        real = np.take_along_axis(waiting, pick, 1) > -np.inf
        live, pick, real = live[real[:, 0]], pick[real[:, 0]], real[real[:, 0]]
        if not len(live):
            break
        opened[live[:, None], pick] |= real
        near = np.where(real[:, :, None], links[np.take_along_axis(ids[live], pick, 1)], -1).reshape(len(live), -1)
        near = np.sort(near, axis=1)
        fresh = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(fresh)
        seen[live[r], near[r, c]] = True
        s = np.full(near.shape, -np.inf, np.float32)
        s[r, c] = np.einsum("ed,ed->e", queries[live[r]], unit[near[r, c]])
        all_s = np.concatenate([sims[live], s], axis=1)
        best = np.argsort(-all_s, axis=1, kind="stable")[:, :beam]
        sims[live] = np.take_along_axis(all_s, best, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1), best, 1)
        opened[live] = np.take_along_axis(np.concatenate([opened[live], ~fresh], axis=1), best, 1)
    return np.where(sims > -np.inf, ids, -1)[:, :max(k, 1)]


# -- operator -----------------------------------------------------------------

def _valid(col: str) -> Column:
    v = F.col(col)
    real = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(real, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _band(col: str) -> Column:
    """Band of the norm of a valid vector: norms up to ``BAND`` times apart, 1 in the middle of its band."""
    longest = F.array_max(F.transform(col, F.abs))
    squares = F.aggregate(col, F.lit(0.0), lambda s, x: s + (x / longest) * (x / longest))
    return F.floor((F.log(longest) + F.log(squares) / 2) / math.log(BAND) + 0.5).cast("int")


def build_index(vectors: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = SHARD_ROWS):
    """(nodes, index, shards per vector length and band): a row per distinct vector with
    its smallest ids, and a row of flat arrays per shard."""
    rows = vectors.where(F.col(id_col).isNotNull() & _valid(vec_col)).select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).distinct()
    first = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    nodes = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("node", F.col("ids")[0]).withColumn("dim", F.size("v"))
    nodes = stored(nodes, "nn_nodes")
    banded = nodes.withColumn("band", _band("v"))
    per_band = stored(banded.groupBy("dim", "band").agg(F.count("*").alias("n"))
                      .withColumn("shards", F.ceil(F.col("n") / F.lit(shard_rows)).cast("int")).drop("n"), "nn_bands")
    dealt = banded.join(bounded_broadcast(per_band, 100_000), ["dim", "band"]).withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), F.col("node")), F.col("shards")).cast("int"))
    draw = (F.pmod(F.xxhash64(F.lit("level"), F.col("node")), F.lit(1 << 40)) + 1) / F.lit(float(1 << 40))
    n_shards = per_band.agg(F.sum("shards")).first()[0] or 1
    dealt = dealt.select("dim", "band", "shard", "node", "v", draw.alias("draw")).repartition(int(n_shards) * 2, "dim", "band", "shard")

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", kind="stable")
        ix = build(np.array(pdf["v"].tolist()), pdf["draw"].to_numpy())
        return pd.DataFrame({
            "dim": pdf["dim"].iloc[:1], "band": pdf["band"].iloc[:1], "shard": pdf["shard"].iloc[:1], "nodes": [pdf["node"].to_numpy(np.int64).tobytes()],
            "unit": [ix["unit"].tobytes()], "members": [[m.tobytes() for m, _ in ix["levels"]]], "neighbours": [[e.tobytes() for _, e in ix["levels"]]]})
    index = dealt.groupBy("dim", "band", "shard").applyInPandas(make, "dim int, band int, shard int, nodes binary, unit binary, members array<binary>, neighbours array<binary>")
    return nodes, stored(index, "nn_index"), per_band


def nearest(queries: DataFrame, vectors: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
            shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES, beam: int = BEAM) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``id_col``, ``score``: the ``k`` nearest rows of
    ``vectors`` found for each of ``queries`` (id, vector), without a row of the query's own id."""
    nodes, index, per_band = build_index(vectors, k, id_col, vec_col, shard_rows)
    asked = stored(queries.where(F.col(id_col).isNotNull() & _valid(vec_col)).select(
        F.col(id_col).cast("long").alias("query_id"), F.col(vec_col).cast("array<double>").alias("qv")).distinct(), "nn_query")
    n_blocks = max(1, math.ceil(asked.count() / block_queries))
    blocks = (asked.select("query_id", "qv", F.size("qv").alias("dim"), F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int").alias("block"))
              .groupBy("dim", "block").agg(F.sort_array(F.collect_list(F.struct("query_id", "qv"))).alias("asked")))
    # the stated queries, in blocks, go to every shard of their length; cells are dealt by shard
    n_cells = n_blocks * int(per_band.agg(F.sum("shards")).first()[0] or 1)
    sent = blocks.join(bounded_broadcast(per_band, 100_000), "dim").select("dim", "band", "block", "asked", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    cells = sent.join(index, ["dim", "band", "shard"]).repartition(2 * n_cells, "dim", "band", "shard", "block")

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in pdf.itertuples():
            unit = np.frombuffer(row.unit, np.float32).reshape(-1, row.dim + 1)
            names = np.frombuffer(row.nodes, np.int64)
            levels = [(m := np.frombuffer(a, np.int32), np.frombuffer(e, np.int32).reshape(len(m), -1)) for a, e in zip(row.members, row.neighbours)]
            q = np.array([x["qv"] for x in row.asked])
            unit_q = np.column_stack([q / np.sqrt((q**2).sum(1, keepdims=True)), np.zeros(len(q))]).astype(np.float32)
            got = search({"unit": unit, "levels": levels}, unit_q, k + 1, beam)
            i, j = np.nonzero(got >= 0)
            out.append(pd.DataFrame({"query_id": np.array([x["query_id"] for x in row.asked], np.int64)[i], "node": names[got[i, j]],
                                     "dim": np.full(len(i), row.dim, np.int32)}))
        return pd.concat(out)
    found = cells.groupBy("dim", "band", "shard", "block").applyInPandas(find, "query_id long, node long, dim int")
    # a node's id can name several vectors if rows repeat an id
    scored = found.join(nodes.select("node", "dim", "ids", "v"), ["node", "dim"]).join(asked.withColumn("dim", F.size("qv")), ["query_id", "dim"])
    dot = F.aggregate(F.zip_with("v", "qv", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    each = scored.select("query_id", dot.alias("score"), F.explode("ids").alias(id_col)).where(F.col(id_col) != F.col("query_id"))
    each = each.groupBy("query_id", id_col).agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), id_col)
    return (each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col(id_col).cast("long").alias(id_col), "score"))

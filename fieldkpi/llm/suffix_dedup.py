"""Suffix-array dedup: bytes covered by a long string that occurs elsewhere.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere
else in the corpus (the same text included) is removed; strings are judged on
the input, and matches never cross documents.

Sharding. The leftmost smallest hash of the ``GRAM``-byte strings inside a
window of ``LENGTH`` bytes depends on the window's bytes alone, so equal windows
have equal anchors at equal offsets. Every window belongs to its anchor; an
anchor's context is the bytes of all its windows. Contexts whose anchor hash
occurs once in the corpus can't hold a repeat. The other contexts, equal ones
as one with their number, are dealt to shards by anchor hash. The contexts of
an anchor with many different ones are dealt to several shards.

Per shard, in numpy: a suffix array of the joined contexts by Larsson-Sadakane
refinement (groups of equal prefixes, doubled in length, sorted ones skipped),
and common prefixes of neighbours by Kasai's rule, all contexts in step. Runs of
suffixes with common prefixes of ``LENGTH`` bytes are the classes of equal
windows; a class that counts two or more is a repeat.

Across shards: only for anchors on several shards, each shard gives one
fingerprint per class, sorted; these are dealt by fingerprint, and each shard's
list is looked up in the union by binary search.

Results depend on the text alone: null and repeated ids and further columns
don't matter, null text counts as empty, an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm.common import U64, mix, powers, slices, stored, text_array

LENGTH = 400
GRAM = 100
SHARD_BYTES = 1_500_000
SPLIT_CONTEXTS = 1000  # different contexts of one anchor on one shard
_PLACE = 23  # bits for the place in a piece
_PIECE = 1 << 22


# -- anchors ------------------------------------------------------------------

def _prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, inverse powers): the hash of bytes a to b is (sums[b] - sums[a]) * inverse[a]."""
    p, inv = powers(len(data) + 1)
    h = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * p[:-1], dtype=U64, out=h[1:])
    return h, inv


def _anchors_of(data: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Anchors of the windows of joined texts; ``ends``: per byte the end of its
    text. Returns (key, context hash, first window, number of windows)."""
    n = len(data)
    if n < length:
        return (np.zeros(0, U64),) * 2 + (np.zeros(0, np.int64),) * 2
    h, inv = _prefix_sums(data)
    g = mix((h[gram:] - h[:-gram]) * inv[: n - gram + 1])
    low = (g >> U64(_PLACE)) << U64(_PLACE) | np.arange(len(g), dtype=U64)
    span, width = 1, length - gram + 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span:])
    x = np.flatnonzero(np.arange(n - length + 1) + length <= ends[: n - length + 1])
    if not len(x):
        return (np.zeros(0, U64),) * 2 + (np.zeros(0, np.int64),) * 2
    place = (low[x] & U64((1 << _PLACE) - 1)).astype(np.int64)
    new = np.ones(len(x), bool)
    new[1:] = (place[1:] != place[:-1]) | (x[1:] != x[:-1] + 1)
    at = np.flatnonzero(new)
    first, count, place = x[at], np.diff(np.append(at, len(x))), place[at]
    context = (h[first + count + length - 1] - h[first]) * inv[first]
    context = mix(context + (place - first).astype(U64) * U64(0x9E3779B97F4A7C15)) + count.astype(U64)
    return g[place], context, first, count


def _pieces(data: np.ndarray, off: np.ndarray, length: int):
    """(bytes, offsets, text number, shift) so that no piece is over-long; pieces of one text share length - 1 bytes."""
    if len(data) <= _PIECE:
        yield data, off, 0, 0
        return
    for k, (a, b) in enumerate(zip(off[:-1], off[1:])):
        for s in range(a, max(a + 1, b - length + 1), _PIECE):
            e = min(b, s + _PIECE + length - 1)
            yield data[s:e], np.array([0, e - s]), k, s - a


def anchors(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """A row per text with windows: ``h`` (its hash) and ``m``, an array of key,
    ctx, n and ``firsts``, every place of that context in the text: a line that a
    text repeats is one entry."""
    def run(batches):
        for batch in batches:
            texts = text_array(batch.column(1))
            for a, b, data, off in slices(texts):
                for part, at, base, shift in _pieces(data, off, length):
                    ends = np.repeat(at[1:], np.diff(at))
                    key, ctx, first, count = _anchors_of(part, ends, length, gram)
                    doc = np.searchsorted(at, first, "right") - 1
                    rows = len(at) - 1
                    by = np.lexsort((ctx, key, doc))  # stable: places stay in order
                    key, ctx, first, count, doc = key[by], ctx[by], first[by], count[by], doc[by]
                    new = np.ones(len(key), bool)
                    new[1:] = (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1]) | (doc[1:] != doc[:-1])
                    one = np.flatnonzero(new)
                    places = pa.ListArray.from_arrays(np.append(one, len(key)).astype(np.int32), pa.array((first - at[doc] + shift).astype(np.int64)))
                    item = pa.StructArray.from_arrays(
                        [pa.array(key[one].view(np.int64)), pa.array(ctx[one].view(np.int64)), pa.array(count[one].astype(np.int32)), places],
                        names=["key", "ctx", "n", "firsts"])
                    starts = np.searchsorted(doc[one], np.arange(rows + 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a + base, rows), pa.ListArray.from_arrays(pa.array(starts), item)], names=["h", "m"])
    rows = docs.where(F.octet_length(text_col) >= length).select(F.unhex(F.substring(F.sha2(text_col, 256), 1, 32)).alias("h"), F.col(text_col))
    return rows.mapInArrow(run, "h binary, m array<struct<key:long,ctx:long,n:int,firsts:array<long>>>")


# -- suffix arrays ------------------------------------------------------------

def suffix_array(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, rank, words) of the suffixes of ``s`` (values 0 to 256); words: seven values packed at each place."""
    n = len(s)
    wide = np.zeros(n + 7, np.int64)
    wide[:n] = s
    words = np.zeros(n, np.int64)
    for j in range(7):
        words = (words << 9) | wide[j: n + j]
    order = np.argsort(words, kind="stable")
    sorted_words = words[order]
    new = np.ones(n, bool)
    new[1:] = sorted_words[1:] != sorted_words[:-1]
    slot = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = slot
    last = np.append(new[1:], True)
    open_slots = np.flatnonzero(~(new & last))
    h = 7
    while len(open_slots):
        pos = order[open_slots]
        beyond = pos + h
        second = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        key = rank[pos] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        pos, key = pos[by], key[by]
        order[open_slots] = pos
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        start = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        rank[pos] = open_slots[start]
        open_slots = open_slots[~(new & np.append(new[1:], True))]
        h *= 2
    return order, rank, words


def common_prefixes(order, rank, words, begin, count, length) -> np.ndarray:
    """Per place the common prefix, up to ``length``, of its suffix and the one
    before it in order, for the first ``count`` places of each context. By
    Kasai's rule a place's prefix is at most one shorter than the one to its left."""
    n = len(order)
    out = np.zeros(n, np.int64)
    lanes = np.argsort(-count, kind="stable")
    begin, count = begin[lanes], count[lanes]
    h = np.zeros(len(begin), np.int64)
    for j in range(int(count[0]) if len(count) else 0):
        m = int(np.searchsorted(-count, -j, "left"))  # lanes with more than j places
        x = begin[:m] + j
        y = order[rank[x] - 1]
        cur = np.maximum(h[:m] - 1, 0)
        cur[rank[x] == 0] = length  # taken back below; nothing comes before it
        live = np.flatnonzero(cur < length)
        while len(live):
            a, b = x[live] + cur[live], y[live] + cur[live]
            ok = (a < n) & (b < n)
            wa, wb = words[np.minimum(a, n - 1)], words[np.minimum(b, n - 1)]
            same = (wa == wb) & ok
            cur[live[same]] += 7
            diff = live[~same]
            da, db = wa[~same], wb[~same]
            step = np.zeros(len(diff), np.int64)
            for k in range(1, 7):
                step += (da >> (9 * (7 - k))) == (db >> (9 * (7 - k)))
            step[~ok[~same]] = 0
            cur[diff] += step
            live = live[same]
            live = live[cur[live] < length]
        cur[rank[x] == 0] = 0
        h[:m] = np.minimum(cur, length)
        out[x] = h[:m]
    return out


def repeats_in_shard(contexts: list[bytes], count: np.ndarray, weight: np.ndarray, length: int = LENGTH):
    """Windows of a shard's contexts: (context number, window number, class,
    class weight, place in the joined bytes), and the joined bytes."""
    size = np.array([len(c) for c in contexts], np.int64)
    joined = b"\0".join(contexts) + b"\0"
    data = np.frombuffer(joined, np.uint8)
    begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]]).astype(np.int64)
    s = data.astype(np.int64) + 1
    s[begin + size] = 0
    order, rank, words = suffix_array(s)
    lcp = common_prefixes(order, rank, words, begin, count, length)
    ctx = np.repeat(np.arange(len(contexts)), count)
    win = np.arange(len(ctx)) - np.repeat(np.cumsum(count) - count, count)
    place = begin[ctx] + win
    by = np.argsort(rank[place], kind="stable")
    ctx, win, place = ctx[by], win[by], place[by]
    cls = np.cumsum(lcp[place] < length) - 1
    if len(cls):
        cls -= cls[0]
    total = np.bincount(cls, weights=weight[ctx]) if len(cls) else np.zeros(0)
    return ctx, win, cls, total, place, data


# -- operator -----------------------------------------------------------------

def _cut_contexts(batches):
    """(h, text, c: array of key, ctx, first, size, ...) to a row per context with its bytes."""
    for batch in batches:
        texts = text_array(batch.column(0))
        bufs = texts.buffers()
        off = np.frombuffer(bufs[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
        data = np.frombuffer(bufs[2], np.uint8) if len(texts) else np.zeros(0, np.uint8)
        col = batch.column(1)
        flat = col.flatten()
        doc = np.repeat(np.arange(len(col)), np.diff(np.asarray(col.offsets)))
        first = off[doc] + flat.field("first").to_numpy()
        size = flat.field("size").to_numpy()
        for a in range(0, len(flat), 4000):
            part = flat.slice(a, 4000)
            cut = pa.array([data[s: s + z].tobytes() for s, z in zip(first[a: a + 4000], size[a: a + 4000])], pa.binary())
            yield pa.RecordBatch.from_arrays([*(part.field(k) for k in ("shard", "key", "ctx", "n", "w", "split")), cut],
                                             names=["shard", "key", "ctx", "n", "w", "split", "bytes"])


def _search_shards(length: int):
    """Per shard a row per context: ``marks`` (a bit per window: repeated), and
    for split anchors the windows that stand for a class with its fingerprint."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        contexts = list(pdf["bytes"])
        count = pdf["n"].to_numpy(np.int64)
        ctx, win, cls, total, place, data = repeats_in_shard(contexts, count, pdf["w"].to_numpy(float), length)
        hit = total[cls] >= 2
        marks = np.zeros((len(contexts), int(count.max()) if len(count) else 0), bool)
        marks[ctx[hit], win[hit]] = True
        split = pdf["split"].to_numpy(bool)
        new = np.ones(len(cls), bool)
        new[1:] = cls[1:] != cls[:-1]
        rep = np.flatnonzero(new & split[ctx])
        reps: list[list] = [[] for _ in contexts]
        if len(rep):
            h, inv = powers(len(data) + 1)[0], powers(len(data) + 1)[1]
            sums = np.zeros(len(data) + 1, U64)
            np.cumsum((data.astype(U64) + U64(1)) * h[:-1], dtype=U64, out=sums[1:])
            prints = mix((sums[place[rep] + length] - sums[place[rep]]) * inv[place[rep]] ^ U64(0x2545F4914F6CDD1D)).view(np.int64)
            for c, w, f in zip(ctx[rep], win[rep], prints):
                reps[c].append({"win": int(w), "print": int(f)})
        return pd.DataFrame({"shard": pdf["shard"], "key": pdf["key"], "ctx": pdf["ctx"],
                             "marks": [np.packbits(m[:k]).tobytes() if m.any() else None for m, k in zip(marks, count)], "reps": reps})
    return run


def _merge_shards(batches):
    """One partition of (shard, key, ctx, win, print): the windows whose print another shard has too."""
    rows = [b.to_pandas() for b in batches]
    if not rows:
        return
    r = pd.concat(rows)
    lists = {s: np.sort(g.to_numpy()) for s, g in r.groupby("shard")["print"]}
    union = np.sort(np.concatenate(list(lists.values())))
    keep = []
    for s, g in r.groupby("shard"):
        x = g["print"].to_numpy()
        n = np.searchsorted(union, x, "right") - np.searchsorted(union, x, "left")
        own = np.searchsorted(lists[s], x, "right") - np.searchsorted(lists[s], x, "left")
        keep.append(g[n > own])
    yield pa.RecordBatch.from_pandas(pd.concat(keep)[["key", "ctx", "win"]], preserve_index=False)


def repeated_windows(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                     shard_bytes: int = SHARD_BYTES, split_contexts: int = SPLIT_CONTEXTS) -> DataFrame:
    """Per text hash ``h``: ``m``, an array of (firsts, marks, wins): from each
    byte of ``firsts`` on, a bit per window start that is repeated elsewhere, or
    the numbers of such window starts."""
    all_anchors = stored(anchors(docs, text_col, length, gram), "sa_anchor")
    each = all_anchors.select("h", F.explode("m").alias("m")).select("h", "m.*")
    keys = each.groupBy("key").agg(F.sum(F.size("firsts")).alias("c")).where("c > 1").select("key")
    found = stored(each.join(keys, "key", "left_semi").groupBy("key", "ctx", "h", "firsts", "n").agg(
        (F.count("*") * F.size("firsts")).alias("w")), "sa_found")

    # one of equal contexts, with their number, and its shard
    contexts = stored(found.groupBy("key", "ctx").agg(F.sum("w").alias("w"), F.min(F.struct("h", F.col("firsts")[0].alias("first"), "n")).alias("x"))
                      .select("key", "ctx", "w", "x.*"), "sa_context")
    n_bytes = contexts.agg(F.sum(F.col("n") + length)).first()[0] or 0
    n_shards = max(1, math.ceil(n_bytes / shard_bytes))
    per_key = contexts.groupBy("key").agg(F.ceil(F.count("*") / F.lit(split_contexts)).cast("int").alias("parts"))
    dealt = contexts.join(per_key, "key").select(
        "h", F.struct(F.pmod(F.xxhash64("key", F.pmod("ctx", "parts")), F.lit(n_shards)).cast("int").alias("shard"), "key", "ctx", "first",
                      (F.col("n") + (length - 1)).alias("size"), "n", F.col("w").cast("long").alias("w"), (F.col("parts") > 1).alias("split")).alias("c"))
    per_text = dealt.groupBy("h").agg(F.collect_list("c").alias("c"))  # at most a text's own windows
    texts = (docs.where(F.octet_length(text_col) >= length)
             .select(F.unhex(F.substring(F.sha2(text_col, 256), 1, 32)).alias("h"), F.col(text_col).alias("text"))
             .join(per_text.select("h"), "h", "left_semi").dropDuplicates(["h"]))
    cut = texts.join(per_text, "h").select("text", "c").mapInArrow(
        _cut_contexts, "shard int, key long, ctx long, n int, w long, split boolean, bytes binary")
    searched = stored(cut.groupBy("shard").applyInPandas(
        _search_shards(length), "shard int, key long, ctx long, marks binary, reps array<struct<win:int,print:long>>"), "sa_searched")

    marked = searched.where("marks IS NOT NULL").select("key", "ctx", "marks")
    extra = searched.where(F.size("reps") > 0).select("shard", "key", "ctx", F.explode("reps").alias("r")).select("shard", "key", "ctx", "r.win", "r.print")
    n_extra = extra.count()
    found = found.select("key", "ctx", "h", "firsts")
    got = found.join(marked, ["key", "ctx"]).select("h", "firsts", "marks", F.lit(None).cast("array<int>").alias("wins"))
    if n_extra:
        across = (extra.repartition(max(1, math.ceil(n_extra / 200_000)), "print").mapInArrow(_merge_shards, "key long, ctx long, win int")
                  .groupBy("key", "ctx").agg(F.collect_list("win").alias("wins")))
        got = got.unionAll(found.join(across, ["key", "ctx"]).select("h", "firsts", F.lit(None).cast("binary").alias("marks"), "wins"))
    return got.groupBy("h").agg(F.collect_list(F.struct("firsts", "marks", "wins")).alias("m"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   shard_bytes: int = SHARD_BYTES, split_contexts: int = SPLIT_CONTEXTS) -> DataFrame:
    """A row per row of ``docs``: id, ``n_bytes``, ``spans`` (removed runs, start
    and end in bytes) and ``kept`` (the remaining bytes)."""
    m = repeated_windows(docs, text_col, length, gram, shard_bytes, split_contexts)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "h", F.unhex(F.substring(F.sha2("text", 256), 1, 32)))
    both = rows.join(m, "h", "left").select("id", "text", "m")

    def run(batches):
        for batch in batches:
            texts = text_array(batch.column(1))
            col = batch.column(2)
            for a, b, data, off in slices(texts):
                spans, kept = [], []
                for i in range(b - a):
                    own, runs = data[off[i]: off[i + 1]], []
                    marks = col[a + i].as_py()
                    if marks:
                        gone = np.zeros(len(own) + 1, np.int64)
                        starts = np.zeros(len(own), bool)
                        for x in marks:
                            bits = np.flatnonzero(np.unpackbits(np.frombuffer(x["marks"], np.uint8))) if x["marks"] is not None else np.array(x["wins"])
                            starts[(np.array(x["firsts"])[:, None] + bits).ravel()] = True
                        s = np.flatnonzero(starts)
                        np.add.at(gone, s, 1)
                        np.add.at(gone, s + length, -1)
                        out = np.cumsum(gone[:-1]) > 0
                        edge = np.flatnonzero(np.diff(np.concatenate([[0], out.view(np.int8), [0]])))
                        runs = [{"start": int(p), "end": int(q)} for p, q in zip(edge[::2], edge[1::2])]
                        own = own[~out]
                    spans.append(runs)
                    kept.append(own.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(off)),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                    names=["id", "n_bytes", "spans", "kept"])
    kind = docs.schema[id_col].dataType.simpleString()
    return both.mapInArrow(run, f"id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary").withColumnRenamed("id", id_col)

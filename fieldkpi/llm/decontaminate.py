"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

Each fixed mask picks five of up to eight consecutive word positions and ignores
the others. The picked words' hash is made at every position of the benchmark items
and of whole documents, and the two are joined. A hit fixes an alignment of item
and document; along it the words are compared one by one, and the stretch with
the best balance of equal words (+1) over replaced ones (-1) is the overlap.
A document is contaminated by an item if that balance reaches ``MIN_SCORE``, or
``MIN_SHARE`` of a shorter item. The masks meet every way to replace words that this
accepts in items of 8 to 20 words (a test counts them out), and every stretch with
five equal words in a row in items of any length.

An item of fewer than ``SPAN`` words must occur whole, word for word; its only mask
picks all its words. An item of fewer than ``MIN_WORDS`` words must be the whole
document, since such short phrases stand in any text.

Words are runs of letters and digits of the lower-cased text. Null and empty texts
have no words. A null id takes part like any other. Every alignment of every
distinct text is verified; rows that repeat an id, of a document or an item, then
give that id's best overlap. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm.common import bounded_broadcast, broadcast_within, stored

# fixed masks: picked word positions
MASKS = [(0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 3, 5, 6), (0, 1, 2, 3, 6), (0, 1, 3, 6, 7)]
SPAN = 8
MIN_WORDS = 4
MIN_SCORE = 12
MIN_SHARE = 0.6
MAX_BROADCAST_SEEDS = 300_000
MAX_BROADCAST_BYTES = 64 << 20


def _words(col: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(col), F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _text_key(col: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(col), F.lit("")), 256))


def _seeds(words: DataFrame, masks: list[tuple[int, ...]]) -> DataFrame:
    """A row per mask and position of the rows' arrays ``w`` where the mask fits: ``at``, ``seed``."""
    least = min(m[-1] for m in masks) + 1
    rows = words.where(F.size("w") >= least).select("*", F.explode(F.sequence(F.lit(0), F.size("w") - least)).alias("at"))
    hashes = [F.when(F.col("at") + m[-1] < F.size("w"), F.xxhash64(F.lit(",".join(map(str, m))), *[F.get("w", F.col("at") + k) for k in m])) for m in masks]
    return rows.select("*", F.explode(F.array(*hashes)).alias("seed")).where(F.col("seed").isNotNull())


def _overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str,
              min_score: int, min_share: float) -> DataFrame:
    """A row per accepted alignment of a distinct (id, text) and an item: ``id``,
    ``text_key``, ``item_id``, ``n_words``, ``shift``, ``score``."""
    items = stored(benchmark.select(F.col(item_col).alias("item_id"), _text_key(item_text).alias("item_key"), _words(item_text).alias("w"))
                   .where(F.size("w") > 0).distinct(), "dc_items")
    # at most seven lengths; an item shorter than the span has one seed, of all its words
    short = sorted(r["n"] for r in items.where(F.size("w") < SPAN).select(F.size("w").alias("n")).distinct().collect())
    whole_masks = [tuple(range(n)) for n in short]
    made = [_seeds(items.where(F.size("w") == len(m)), [m]) for m in whole_masks] + [_seeds(items.where(F.size("w") >= SPAN), MASKS)]
    seeds = made[0]
    for more in made[1:]:
        seeds = seeds.unionByName(more)
    seeds = stored(seeds.select("seed", "item_key", F.col("at").alias("j"), F.size("w").alias("n")).distinct(), "dc_seeds")
    rows = docs.select(F.col(id_col).alias("id"), _text_key(text_col).alias("text_key"), _words(text_col).alias("w"))
    start = F.greatest(F.col("at") - F.col("j"), F.lit(0))
    hits = _seeds(rows, MASKS + [m for m in whole_masks if m not in MASKS]).join(bounded_broadcast(seeds, MAX_BROADCAST_SEEDS), "seed").select(
        "id", "text_key", "item_key", (F.col("at") - F.col("j")).alias("shift"), F.size("w").alias("of"),
        F.slice("w", start + 1, F.greatest(F.col("n") + F.col("at") - F.col("j") - start, F.lit(1))).alias("part"))
    # rows of a group have the same part: it is a stretch of one text
    lines = hits.groupBy("id", "text_key", "item_key", "shift").agg(F.first("part").alias("part"), F.first("of").alias("of"))
    whole = items.select("item_id", "item_key", F.col("w").alias("iw"))
    size = F.octet_length(F.array_join("iw", " ")) + 32 * F.size("iw") + 64
    skip = F.greatest(-F.col("shift"), F.lit(0))
    best = F.aggregate(
        F.zip_with(F.col("part"), F.slice("iw", skip + 1, F.size("part")), lambda x, y: F.when(x == y, 1).otherwise(-1)),
        F.struct(F.lit(0).alias("run"), F.lit(0).alias("best")),
        lambda s, x: F.struct(F.greatest(s["run"] + x, F.lit(0)).alias("run"), F.greatest(s["best"], s["run"] + x).alias("best")),
        lambda s: s["best"])
    n = F.col("n_words")
    enough = F.when(n >= SPAN, F.least(F.lit(min_score), F.ceil(n * min_share))).otherwise(n)
    return (lines.join(broadcast_within(whole, size, MAX_BROADCAST_BYTES), "item_key")
            .select("id", "text_key", "item_id", F.size("iw").alias("n_words"), "of", "shift", best.alias("score"))
            .where((F.col("score") >= enough) & ((n >= MIN_WORDS) | (F.col("of") == n))).drop("of"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", min_score: int = MIN_SCORE,
                  min_share: float = MIN_SHARE) -> DataFrame:
    """A row per document id and item that overlap: id, ``item_id``, ``score``
    (equal less replaced words of the best stretch), ``n_words`` of the item and
    ``at``, the document's word position aligned with the item's start."""
    scored = _overlaps(docs, benchmark, id_col, text_col, item_col, item_text, min_score, min_share)
    top = scored.groupBy("id", "item_id").agg(F.max(F.struct("score", (-F.col("shift")).alias("back"), "n_words")).alias("x"))
    return top.select(F.col("id").alias(id_col), "item_id", F.col("x.score").cast("long").alias("score"),
                      F.col("x.n_words").cast("long").alias("n_words"), (-F.col("x.back")).cast("long").alias("at"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose own text is contaminated, all columns as they are."""
    found = _overlaps(docs, benchmark, id_col, text_col, "item_id", "text", MIN_SCORE, MIN_SHARE)
    bad = stored(found.select(F.col("text_key").alias("__dc_bad")).distinct(), "dc_bad")
    return docs.join(bounded_broadcast(bad, 200_000), _text_key(text_col) == F.col("__dc_bad"), "left_anti")

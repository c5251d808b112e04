"""Outcome classification: exact lookup, ordered substring rules, fuzzy fallback.

Cleaning, exact and substring rules and the fuzzy scorer are native expressions.
All run once per *distinct* text: the distinct raw texts are aggregated (partial
aggregation first, so a hot text costs one row per task), cleaned and written to the
checkpoint folder; of these, the cleaned texts that no rule resolves are scored.
The measured sizes decide how the categories meet the rows again: the vocabulary of
raw texts is broadcast under a limit. Beyond it every row is cleaned and ruled in
place (no join, no shuffle), and only the scores are joined: broadcast under a limit,
otherwise a join on the text in which rows that need no score are spread over keys of
their own. Scoring runs when the plan is built, as its size is part of the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import fuzzy
from ..functions.contact import levels
from ..functions.text import blank_markers, clean_closing_text
from ..session import cut_lineage

# broadcast limit for the classified vocabulary, in estimated bytes
BROADCAST_BYTES = 64 * 1024 * 1024
# the same for the vocabulary of raw texts; beyond it cleaning in place costs less than a join
VOCABULARY_BYTES = 8 * 1024 * 1024


def exact_rule(text: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in K.EXACT_RULES.items() for x in kv])
    return F.element_at(m, text)


def substring_rule(text: Column) -> Column:
    expr = None
    for pattern, category in K.SUBSTRING_RULES:
        cond = text.contains(pattern)
        expr = F.when(cond, category) if expr is None else expr.when(cond, category)
    return expr


def rule_category(text: Column | str) -> Column:
    """Exact lookup, then the first substring rule that hits; null if none."""
    t = F.col(text) if isinstance(text, str) else text
    return F.coalesce(exact_rule(t), substring_rule(t))


SCORED = T.StructType([T.StructField("text", T.StringType()), T.StructField("category", T.StringType()),
                       T.StructField("score", T.DoubleType())])


def score_texts(rows: DataFrame, text: str, rule: str, floor: float = 0.0) -> DataFrame:
    """Distinct cleaned texts that no rule resolves -> (text, category, score),
    and a row with a null text. Under ``floor`` a score may be null.

    Resolved texts become one null rather than being filtered: a filter on the
    rule would be pushed below the cleaning and repeat it in every rule."""
    unresolved = F.when(F.col(rule).isNull(), F.col(text)).alias("text")
    # dealt anew: a few distinct texts are much work, and would share a task
    texts = rows.select(unresolved).distinct().repartition(rows.sparkSession.sparkContext.defaultParallelism, "text")
    best = texts.select("text", fuzzy.best_label("text", K.CATEGORIES_ALL, floor).alias("best"))
    return best.select("text", F.when(F.col("best.score") >= K.FUZZY_ACCEPT, F.col("best.label")).otherwise(K.NO_MATCH).alias("category"),
                       F.col("best.score").alias("score"))


def classify_vocabulary(texts: DataFrame, text: str, fuzzy_fallback: bool = True) -> DataFrame:
    """Distinct raw texts -> (raw, text, category, score, method): the rules'
    category, else the scorer's."""
    vocab = texts.select(F.col(text).alias("raw")).distinct()
    vocab = vocab.withColumn("text", clean_closing_text("raw")).withColumn("rule", rule_category("text"))
    if fuzzy_fallback:
        scored = cut_lineage(score_texts(vocab, "text", "rule"))
    else:
        scored = vocab.sparkSession.createDataFrame([], SCORED)
    return vocab.join(scored, "text", "left").select(
        "raw", "text", F.coalesce("rule", "category", F.lit(K.NO_MATCH)).alias("category"),
        F.when(F.col("rule").isNull(), F.col("score")).alias("score"),
        F.when(F.col("rule").isNotNull(), "rule").when(F.col("score").isNotNull(), "fuzzy").otherwise("none").alias("method"))


SPREAD_KEYS = 4096


def classify_outcomes(df: DataFrame, raw_text: str = K.COL_CLOSING, text_out: str = K.COL_CLEAN_TEXT,
                      out: str = K.COL_CATEGORY, fuzzy_fallback: bool = True,
                      broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Attach the cleaned text and category of each row's raw closing text."""
    if not fuzzy_fallback:
        rows = df.withColumn(text_out, clean_closing_text(raw_text))
        return rows.withColumn(out, F.coalesce(rule_category(text_out), F.lit(K.NO_MATCH)))
    vocab = df.select(F.col(raw_text).alias("__raw")).distinct().withColumn("__text", clean_closing_text("__raw"))
    vocab = cut_lineage(vocab.withColumn("__rule", rule_category("__text")))
    scored = cut_lineage(score_texts(vocab, "__text", "__rule", K.FUZZY_ACCEPT))
    side = scored.select(F.col("text").alias("__text"), F.col("category").alias("__scored"))
    wide = vocab.agg(F.sum(F.coalesce(F.octet_length("__raw"), F.lit(0)) + F.octet_length("__text") + F.lit(96)).alias("b")).first()["b"] or 0
    if wide <= min(broadcast_bytes, VOCABULARY_BYTES):
        known = vocab.join(F.broadcast(side), "__text", "left").select("__raw", F.col("__text").alias(text_out), F.coalesce("__rule", "__scored").alias(out))
        names = [c for c in df.columns if c not in (text_out, out)]
        return df.select(*names).join(F.broadcast(known), F.col(raw_text).eqNullSafe(F.col("__raw")), "left").select(*names, text_out, out)
    rows = df.withColumn(text_out, clean_closing_text(raw_text))
    rows = rows.withColumn("__rule", rule_category(text_out))
    size = scored.agg(F.sum(F.octet_length("text") + F.octet_length("category") + F.lit(48)).alias("b")).first()["b"] or 0
    if size <= broadcast_bytes:
        key, side = F.col(text_out), F.broadcast(side)
    else:
        other = F.concat(F.lit("\u0000#"), F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD_KEYS)).cast("string"))
        key = F.when(F.col("__rule").isNull(), F.col(text_out)).otherwise(other)
    got = rows.withColumn("__key", key).join(side, F.col("__key") == F.col("__text"), "left")
    return got.withColumn(out, F.coalesce("__rule", "__scored")).drop("__rule", "__key", "__text", "__scored")


def with_closing_text(df: DataFrame) -> DataFrame:
    """Empty markers -> null on supervisor note and result; closing text is the
    note, else the result."""
    return (df.withColumn(K.COL_SUPERVISOR, blank_markers(K.COL_SUPERVISOR, K.EMPTY_MARKERS))
              .withColumn(K.COL_RESULT, blank_markers(K.COL_RESULT, K.EMPTY_MARKERS))
              .withColumn(K.COL_CLOSING, F.coalesce(F.col(K.COL_SUPERVISOR), F.col(K.COL_RESULT))))


def closing_columns(df: DataFrame, fuzzy_fallback: bool = True) -> DataFrame:
    """Closing text, cleaned and classified; two-level hierarchy added."""
    df = classify_outcomes(with_closing_text(df), fuzzy_fallback=fuzzy_fallback)
    level, gives = levels(K.COL_CATEGORY)
    return df.withColumn(K.COL_CONTACT_LEVEL, level).withColumn(K.COL_GIVES_DATA, gives)

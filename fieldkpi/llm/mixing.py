"""Mixing sources to target weights by Poisson replication.

A source's rate is its target share of the output over its share of the input.
Every document draws a repetition count from a Poisson distribution with its
source's rate as mean, by inverting the distribution at a uniform number hashed
from a seed and the document's id; it is exploded by that count. The copies are
shuffled globally: a hash of seed, id and copy gives each a random place in
[0, 1), and partition k of n holds the k-th n-th of the places, sorted.

Targets default to each source's count to the power ``alpha`` (1: as found, 0:
all alike); the output has about as many rows as the input unless ``total`` says
otherwise. A null source is a source of its own; a null id is hashed as the text
``null``. Rows that repeat an id draw alike. Texts don't matter. A source
with no target weight, or zero, is left out, as asked for. Columns that clash
with the added ``copy`` and ``place`` are replaced. Empty tables give an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm.common import bounded_broadcast, stored

SEED = 17
ALPHA = 0.5
MAX_BROADCAST_SOURCES = 10_000
ROWS_PER_BUCKET = 20_000


def _uniform(*parts) -> Column:
    """A number in [0, 1) hashed from the parts: 52 bits of an md5."""
    key = F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def rates(docs: DataFrame, source_col: str = "source", weights: dict | None = None, alpha: float = ALPHA,
          total: float | None = None) -> DataFrame:
    """Per source: ``n`` rows, mean repetition ``rate`` and ``cdf``, the
    distribution function at 0, 1, 2 ... up to where less than 1e-15 is left."""
    n = stored(docs.groupBy(F.col(source_col).alias("_source")).agg(F.count("*").alias("n")), "mix_n")
    if weights is None:
        w = F.pow(F.col("n").cast("double"), F.lit(float(alpha)))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        w = F.coalesce(F.create_map(*pairs)[F.col("_source")], F.lit(0.0)) if pairs else F.lit(0.0)
    weighed = n.withColumn("w", w)
    sums = weighed.agg(F.sum("n"), F.sum("w")).first()
    if not sums[0] or not sums[1]:
        return weighed.select("_source", "n", F.lit(0.0).alias("rate"), F.array(F.lit(1.0)).alias("cdf"))
    want = float(total if total is not None else sums[0])
    rate = F.lit(want) * F.col("w") / F.lit(float(sums[1])) / F.col("n")
    last = F.ceil(F.col("rate") + F.sqrt("rate") * 12 + 30).cast("int")
    # log of k! as a running sum; each mass is exp(k ln rate - rate - ln k!)
    cdf = F.aggregate(
        F.sequence(F.lit(0), last),
        F.struct(F.lit(0.0).alias("lf"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("out")),
        lambda s, k: F.struct(
            (s["lf"] + F.ln(F.greatest(k, F.lit(1)).cast("double"))).alias("lf"),
            (s["sum"] + F.exp(k * F.ln("rate") - F.col("rate") - s["lf"] - F.ln(F.greatest(k, F.lit(1)).cast("double")))).alias("sum"),
            F.concat(s["out"], F.array(s["sum"] + F.exp(k * F.ln("rate") - F.col("rate") - s["lf"] - F.ln(F.greatest(k, F.lit(1)).cast("double"))))).alias("out")),
        lambda s: s["out"])
    return weighed.withColumn("rate", rate).select("_source", "n", "rate", F.when(F.col("rate") > 0, cdf).otherwise(F.array(F.lit(1.0))).alias("cdf"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", weights: dict | None = None,
        alpha: float = ALPHA, total: float | None = None, seed: int = SEED) -> DataFrame:
    """The mixture: the columns of ``docs``, ``copy`` (from 1) and ``place`` (a
    random number in [0, 1); the global order is by it, then id and copy)."""
    r = stored(rates(docs, source_col, weights, alpha, total), "mix_rate")
    n_rows = r.agg(F.sum(F.col("n") * F.col("rate"))).first()[0] or 0
    buckets = max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(n_rows / ROWS_PER_BUCKET))
    keep = [c for c in docs.columns if c not in ("copy", "place")]
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    drawn = docs.join(bounded_broadcast(r.select(F.col("_source").alias("__mix_source"), F.col("cdf").alias("__mix_cdf")), MAX_BROADCAST_SOURCES), F.col(source_col).eqNullSafe(F.col("__mix_source")))
    u = _uniform(seed, "n", key)
    count = F.size(F.filter("__mix_cdf", lambda c: c <= F.col("__mix_u")))
    copies = (drawn.withColumn("__mix_u", u).withColumn("__mix_k", count).where("__mix_k > 0")
              .select(*keep, F.explode(F.sequence(F.lit(1), F.col("__mix_k"))).alias("copy")))
    placed = copies.withColumn("place", _uniform(seed, "p", key, F.col("copy").cast("string")))
    return placed.repartitionById(buckets, F.floor(F.col("place") * buckets).cast("int")).sortWithinPartitions("place", id_col, "copy")


def mix_sql(alpha: float = ALPHA, seed: int = SEED, table: str = "documents", columns: str = "d.*") -> str:
    """DuckDB SQL for the rows of :func:`mix` with default targets."""
    u = "CAST('0x' || substr(md5({}), 1, 13) AS BIGINT) / 4503599627370496.0"
    key = "coalesce(CAST(d.doc_id AS VARCHAR), 'null')"
    return f"""
WITH n AS (SELECT source, count(*) AS n FROM {table} GROUP BY source),
r AS (SELECT source, (SELECT sum(n) FROM n) * pow(n, {alpha}) / (SELECT sum(pow(n, {alpha})) FROM n) / n AS rate FROM n),
k AS (SELECT source, rate, unnest(range(CAST(ceil(rate + sqrt(rate) * 12 + 30) AS BIGINT) + 1)) AS k FROM r),
c AS (SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf FROM k),
x AS (SELECT d.doc_id AS x_id, unnest(range(1, 1 + (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM d.source
        AND c.cdf <= {u.format(f"'{seed}:n:' || {key}")}))) AS copy FROM {table} d)
SELECT {columns}, CAST(x.copy AS INTEGER) AS copy, {u.format(f"'{seed}:p:' || {key} || ':' || x.copy")} AS place
FROM {table} d JOIN x ON d.doc_id = x.x_id"""

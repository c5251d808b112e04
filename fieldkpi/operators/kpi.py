"""Weekly indicators per zone and for the whole area.

All indicators of one report come out of a single aggregation with
conditional counts (no per-indicator pass, no join between count series).
Restrictions to "the last 8 weeks" are a filter against the oldest of the 8
latest weeks (a scalar subquery, which prunes week partitions of a stored
clean history at run time) placed *before* the aggregation, or a rank over
the already aggregated rows, never a scan per week or per zone.

Boards, summary and totals only need counts per zone and day. These add up, so
they are kept as a small table (:func:`daily_counts`) that the weekly run renews
by month (plans/aggregates.py); the reports take that table or clean rows.
"""

from __future__ import annotations

import datetime
import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..session import cut_lineage
from ..functions.contact import contact_class, contact_class_dashboard
from ..functions.dates import (first_number, label_board_week, label_day_month, label_iso, pct_with_count, share_pct,
                               week_monday)
from .evolution import top_weeks

COUNTS = ["total", "cis", "calls", "n_contact", "n_no_contact", "n_uncovered"]
CLASS_COUNTS = [("n_contact", K.CONTACT), ("n_no_contact", K.NO_CONTACT), ("n_uncovered", K.UNCOVERED)]


def indicator_aggs(contact: Column, cis_condition: Column, card: str = K.COL_CARD) -> list[Column]:
    """total, CIS, automatic calls and the three contact classes among calls."""
    auto = F.col(card) == K.CARD_AUTOMATIC
    aggs = [F.count(F.lit(1)).alias("total"),
            F.count_if(F.coalesce(cis_condition, F.lit(False))).alias("cis"),
            F.count_if(F.coalesce(auto, F.lit(False))).alias("calls")]
    for name, cls in CLASS_COUNTS:
        aggs.append(F.count_if(F.coalesce(auto & (contact == cls), F.lit(False))).alias(name))
    return aggs


def with_shares(df: DataFrame, denominator: Column | None = None) -> DataFrame:
    """Half-even percentage of each class and the 'P% (N)' text."""
    den = denominator if denominator is not None else (
        F.col("n_contact") + F.col("n_no_contact") + F.col("n_uncovered"))
    for name, _ in CLASS_COUNTS:
        pct = name.replace("n_", "pct_")
        df = df.withColumn(pct, share_pct(F.col(name), den))
        df = df.withColumn(name.replace("n_", "fmt_"), pct_with_count(F.col(pct), F.col(name)))
    return df


def _baselines(selector: Column, cases: list[tuple[object, list[str]]], default: list[str]) -> list[Column]:
    cols = []
    for i, name in enumerate(["base_total", "base_cis", "base_calls", "base_contact", "base_no_contact",
                              "base_uncovered"]):
        expr = None
        for value, vals in cases:
            cond = selector == F.lit(value)
            expr = F.when(cond, vals[i]) if expr is None else expr.when(cond, vals[i])
        cols.append(expr.otherwise(default[i]).alias(name))
    return cols


def dashboard_kpis(clean: DataFrame, last_weeks: int = K.LAST_WEEKS, zones: list[int] = K.DASH_ZONES,
                   ts: str = K.COL_START, zone: str = K.COL_ZONE) -> DataFrame:
    """Dashboard indicators for zones 1..15 (exact zone equality) and the total.

    Weeks: the ``last_weeks`` latest Monday weeks of the whole table; a scope
    without rows in a week gets zeros. Contact class: the dashboard rule. One
    grouping-sets aggregation yields the per-zone and the total rows.
    """
    stored = K.CLEAN_PART in clean.columns
    base = clean.select(week_monday(ts).alias("week"), F.col(zone).alias("zone"), K.COL_STATE, K.COL_RESULT,
                        K.COL_CARD, *([K.CLEAN_PART] if stored else []))
    listing = base
    if stored:
        # every month holding data holds a week with data, so the latest weeks
        # lie in the latest months: those come from the partition column alone
        months = (clean.select(K.CLEAN_PART).where(F.col(K.CLEAN_PART).isNotNull()).distinct()
                  .orderBy(F.col(K.CLEAN_PART).desc()).limit(last_weeks))
        listing = base.where(F.col(K.CLEAN_PART) >= months.agg(F.min(K.CLEAN_PART)).scalar())
    weeks = top_weeks(listing, "week", last_weeks)
    # On a clean history stored by month (plans.weekly): week >= the oldest of
    # the latest weeks (a scalar subquery), also applied to the partition
    # column, so the scan prunes months at run time.
    if stored:
        cutoff = weeks.agg(F.min("week")).scalar()
        base = base.where(F.col(K.CLEAN_PART) >= F.date_format(cutoff, "yyyy-MM")).drop(K.CLEAN_PART)
        base = base.where(F.col("week") >= cutoff)
    else:
        # nothing to prune: an 8-row broadcast semi join keeps a single pass
        base = base.join(F.broadcast(weeks), "week", "left_semi")
    contact = contact_class_dashboard(K.COL_STATE, K.COL_RESULT, "zone")
    aggs = indicator_aggs(contact, F.col(K.COL_RESULT) == K.RESULT_CIS)
    g = base.groupingSets([["week", "zone"], ["week"]], "week", "zone").agg(*aggs, F.grouping_id().alias("gid"))
    zone_vals = [float(z) for z in zones]
    scoped = g.where(((F.col("gid") == 0) & F.col("zone").isin(zone_vals)) | (F.col("gid") == 1)).select(
        "week",
        F.when(F.col("gid") == 1, F.lit(K.DASH_TOTAL_SCOPE))
         .otherwise(F.concat(F.lit("c"), F.col("zone").cast("int").cast("string"))).alias("scope"),
        *COUNTS)
    scopes = [f"c{z}" for z in zones] + [K.DASH_TOTAL_SCOPE]
    scaffold = weeks.withColumn("scope", F.explode(F.array(*[F.lit(s) for s in scopes])))
    out = scaffold.join(scoped, ["week", "scope"], "left").select(
        "scope", "week", label_day_month("week").alias("week_label"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTS])
    out = with_shares(out)
    base_cols = _baselines(F.col("scope"), [("c2", K.DASH_BASELINE_ZONE2), ("c14", K.DASH_BASELINE_ZONE14),
                                            (K.DASH_TOTAL_SCOPE, K.DASH_BASELINE_TOTAL)], K.DASH_BASELINE_EMPTY)
    return out.select("*", *base_cols)


SUMMED = ["total", "calls", "cis_result", "cis_category", "n_contact", "n_no_contact", "n_uncovered"]


def daily_counts(clean: DataFrame, ts: str = K.COL_START, zone: str = K.COL_ZONE) -> DataFrame:
    """Rows of the clean history counted per ``zone`` and ``day`` (with its
    ``week``): all, automatic calls, CIS by result and by category, and the
    contact classes among calls (plain rule). Null zones and days are kept."""
    category = F.coalesce(F.col(K.COL_CATEGORY) == K.CATEGORY_CIS, F.lit(False))
    aggs = indicator_aggs(contact_class(K.COL_STATE, K.COL_RESULT), F.col(K.COL_RESULT) == K.RESULT_CIS)
    counted = clean.groupBy(F.col(zone).alias("zone"), F.to_date(ts).alias("day")).agg(*aggs, F.count_if(category).alias("cis_category"))
    return counted.withColumnRenamed("cis", "cis_result").select("zone", "day", week_monday("day").alias("week"), *SUMMED)


def _daily(rows: DataFrame, ts: str, zone: str) -> DataFrame:
    return rows if set(SUMMED) <= set(rows.columns) else daily_counts(rows, ts, zone)


def _sums(cis: str) -> list[Column]:
    return [F.sum(cis if c == "cis" else c).alias(c) for c in COUNTS]


def _first_day(start: str) -> Column:
    """``start`` as a date; the counts know no time of day."""
    at = datetime.datetime.fromisoformat(start)
    if at.time() != datetime.time():
        raise ValueError(f"accumulation starts with a day, not at {start}")
    return F.lit(at.date())


def zone_boards(rows: DataFrame, last_weeks: int = K.LAST_WEEKS, ts: str = K.COL_START,
                zone: str = K.COL_ZONE) -> DataFrame:
    """Sheet board per distinct zone value (2.5 and 14.5 are zones of their own):
    the zone's own ``last_weeks`` latest weeks, plain contact rule, shares over
    the automatic calls, board baseline by zone. ``rows``: daily counts or clean rows."""
    base = _daily(rows, ts, zone).where(F.col("zone").isNotNull() & F.col("week").isNotNull())
    g = base.groupBy("zone", "week").agg(*_sums("cis_result"))
    rank = F.dense_rank().over(Window.partitionBy("zone").orderBy(F.col("week").desc()))
    g = g.withColumn("__r", rank).where(F.col("__r") <= last_weeks).drop("__r")
    g = with_shares(g)
    base_cols = _baselines(F.col("zone"), [(2.0, K.BOARD_BASELINE_ZONE2), (14.0, K.BOARD_BASELINE_ZONE14)],
                           K.BOARD_BASELINE_CITY)
    return g.select("zone", "week", label_board_week("week").alias("week_label"),
                    *[F.col(c).cast("bigint").alias(c) for c in COUNTS],
                    "pct_contact", "pct_no_contact", "pct_uncovered", "fmt_contact", "fmt_no_contact",
                    "fmt_uncovered", *base_cols)


def zone_accumulated(rows: DataFrame, start: str = K.ACCUMULATION_START, ts: str = K.COL_START,
                     zone: str = K.COL_ZONE) -> DataFrame:
    """Totals per zone since ``start``: rows, CIS by category, calls and the
    three contact classes among calls (plain rule). Null zone is left out.
    ``rows``: daily counts or clean rows."""
    base = _daily(rows, ts, zone).where((F.col("day") >= _first_day(start)) & F.col("zone").isNotNull())
    g = base.groupBy("zone").agg(*_sums("cis_category"))
    return g.select("zone", *[F.col(c).cast("bigint").alias(c) for c in
                              ("total", "cis", "calls", "n_contact", "n_no_contact", "n_uncovered")]) \
        .withColumnsRenamed({"total": "acum_total", "cis": "acum_cis", "calls": "acum_llamados",
                             "n_contact": "Se contacta_y", "n_no_contact": "No se contacta_y",
                             "n_uncovered": "Sin cubrir_y"})


def weekly_zone_summary(rows: DataFrame, start: str = K.ACCUMULATION_START, ts: str = K.COL_START,
                        zone: str = K.COL_ZONE) -> DataFrame:
    """Unified week x zone summary with the accumulated columns per zone.

    Rows with null zone are dropped and zones truncate to int (2.5 -> 2,
    14.5 -> 14). CIS counts by category; shares use the automatic calls as
    denominator. Columns carry the report's display names. ``rows``: daily
    counts or clean rows.
    """
    base = (_daily(rows, ts, zone).where(F.col("zone").isNotNull())
            .withColumn("__z", F.col("zone").cast("int").cast("double"))
            .withColumn("__w", F.col("week"))
            .withColumn("__late", F.coalesce(F.col("day") >= _first_day(start), F.lit(False))))
    # one aggregation of the counts, split at the start of the accumulation, serves both parts
    parts = base.groupBy("__w", "__z", "__late").agg(*_sums("cis_category"))
    acc_names = {"total": "acum_total", "cis": "acum_cis", "calls": "acum_llamados",
                 "n_contact": "Se contacta_y", "n_no_contact": "No se contacta_y", "n_uncovered": "Sin cubrir_y"}
    weekly = parts.groupBy("__z", "__w").agg(*[F.sum(c).alias(c) for c in COUNTS],
                                             *[F.sum(F.when(F.col("__late"), F.col(c)).otherwise(0)).alias(f"late_{c}") for c in COUNTS])
    per_zone = Window.partitionBy("__z")  # at most a row per week
    for c, name in acc_names.items():
        weekly = weekly.withColumn(name, F.sum(f"late_{c}").over(per_zone))
    j = with_shares(weekly.where(F.col("__w").isNotNull()), F.col("calls"))
    acc_cols = list(acc_names.values())
    return j.select(
        label_iso("__w").alias("Semana"),
        F.concat(F.lit("Comuna "), F.col("__z").cast("int").cast("string")).alias("Comuna"),
        F.col("total").alias("Intervenciones totales"),
        F.col("cis").alias("Derivaciones CIS"),
        F.col("calls").alias("Llamados 108"),
        F.col("fmt_contact").alias("% Se contacta"),
        F.col("fmt_no_contact").alias("% No se contacta"),
        F.col("fmt_uncovered").alias("% Sin cubrir"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in acc_cols])


def _zone_number():
    return first_number("Comuna")


def summary_order(summary: DataFrame) -> DataFrame:
    """Week descending, then the zone number ascending (sink order)."""
    return summary.orderBy(F.col("Semana").desc(), _zone_number().asc())


def with_position(summary: DataFrame) -> DataFrame:
    """The sink order as a column ``pos`` from 1, without a task that holds all rows:
    the sorted rows (ranges of the order) are checkpointed, which fixes their
    partitions, and a row's position is its place in its partition after the rows of
    the partitions before. The driver gets one count per partition."""
    rows = cut_lineage(summary_order(summary))
    at = F.monotonically_increasing_id()  # partition << 33 | place in it
    counts = dict(rows.select(F.shiftright(at, 33).alias("part")).groupBy("part").count().collect())
    before = list(itertools.accumulate((counts.get(i, 0) for i in range(max(counts, default=0))), initial=0))
    placed = rows.withColumn("__at", at)
    pos = F.get(F.lit(before), F.shiftright("__at", 33).cast("int")) + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.withColumn("pos", pos.cast("int")).drop("__at")


def dashboard_payload(kpis: DataFrame) -> DataFrame:
    """One JSON document per scope: week labels and the six indicator rows
    (label, baseline, eight values: numbers for the counts), in week order."""
    pts = F.sort_array(F.collect_list(F.struct(
        "week", "week_label", "total", "cis", "calls", "fmt_contact", "fmt_no_contact", "fmt_uncovered")))
    firsts = [F.first(c).alias(c) for c in ("base_total", "base_cis", "base_calls", "base_contact",
                                             "base_no_contact", "base_uncovered")]
    g = kpis.groupBy("scope").agg(pts.alias("p"), *firsts)

    def row(i, base, field):
        vals = F.transform("p", lambda x: x[field])
        return F.to_json(F.struct(F.lit(K.INDICATORS[i]).alias("label"), F.col(base).alias("base"), vals.alias("vals")))

    rows = [row(0, "base_total", "total"), row(1, "base_cis", "cis"), row(2, "base_calls", "calls"),
            row(3, "base_contact", "fmt_contact"), row(4, "base_no_contact", "fmt_no_contact"),
            row(5, "base_uncovered", "fmt_uncovered")]
    weeks = F.to_json(F.transform("p", lambda x: x["week_label"]))
    # counts are JSON numbers and shares texts, so the rows are rendered one by one
    return g.select("scope", F.concat(F.lit('{"weeks":'), weeks, F.lit(',"rows":['), F.concat_ws(",", *rows), F.lit("]}")).alias("payload"))


def board_sheet(boards: DataFrame) -> DataFrame:
    """Sheet layout of the zone boards: per zone a header row of week labels
    (row 0) and the six indicator rows, baseline first, then the zone's weeks
    oldest to newest in slots s1..s8 (bounded: at most eight weeks)."""
    slot = F.row_number().over(Window.partitionBy("zone").orderBy("week"))
    b = boards.withColumn("slot", slot)
    cells = F.array(
        F.struct(F.lit(0).alias("row_no"), F.lit("Indicador").alias("Indicador"), F.lit("Linea base").alias("base"),
                 F.col("week_label").alias("v")),
        *[F.struct(F.lit(i + 1).alias("row_no"), F.lit(K.BOARD_INDICATORS[i]).alias("Indicador"),
                   F.col(base).alias("base"), val.alias("v"))
          for i, (base, val) in enumerate([
              ("base_total", F.col("total").cast("string")), ("base_cis", F.col("cis").cast("string")),
              ("base_calls", F.col("calls").cast("string")), ("base_contact", F.col("fmt_contact")),
              ("base_no_contact", F.col("fmt_no_contact")), ("base_uncovered", F.col("fmt_uncovered"))])])
    long = b.select("zone", "slot", F.explode(cells).alias("c")).select(
        "zone", "slot", "c.row_no", "c.Indicador", F.col("c.base").alias("Linea base"), "c.v")
    slots = list(range(1, K.LAST_WEEKS + 1))
    wide = long.groupBy("zone", "row_no", "Indicador", "Linea base").pivot("slot", slots).agg(F.first("v"))
    return wide.select("zone", "row_no", "Indicador", "Linea base",
                       *[F.col(str(s)).alias(f"s{s}") for s in slots])

"""Person-week evolution: weekly de-duplication, previous zone, class labels.

The week-by-week state machine of the source (last zone and seen-set per
person) reduces, once there is one row per (week, person), to a ``lag`` over
the person's weeks. The reduction to one row per (week, person) is an
aggregation with ``max_by`` / ``min_by`` and partial (map-side) aggregation,
so a hot key - for example every foreign document sharing one key - is cut to
one row per task before it moves. Picks carry only a zone and use a decimal
(time, row id) key, so they run as hash aggregations. The window then sees at
most one row per week and person.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.contact import evolution_class, is_target_zone, population_class
from ..functions.dates import label_day_month, week_monday, week_sunday


_SHIFT = "10000000000000000000"   # 10^19 > any long row id
_BEFORE = 10 ** 18                 # microseconds from about the year -29700 to 1970; null times order first


def order_key(ts: str, row_id: str):
    """(time, row id) as one decimal(38,0), so ``min_by``/``max_by`` keep a
    fixed-width buffer and run as a hash aggregation with partial (map-side)
    aggregation. Row ids must be non-negative longs. Times are counted from
    before any timestamp, so that the key is never negative and its remainder
    by 10^19 is the row id."""
    dec = "decimal(38,0)"
    micros = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")).cast(dec) + F.lit(_BEFORE).cast(dec), F.lit(0).cast(dec))
    return (micros.cast("decimal(19,0)") * F.lit(_SHIFT).cast("decimal(20,0)")).cast(dec) + F.col(row_id).cast(dec)


def label_rows(df: DataFrame, key: str = K.COL_KEY, zone: str = K.COL_ZONE, ts: str = K.COL_START,
               row_id: str = K.COL_ROW_ID, out: str = K.COL_EVOLUTION,
               anonymous: list[str] = K.ANONYMOUS_KEYS, prior: DataFrame | None = None,
               keyed: DataFrame | None = None) -> DataFrame:
    """Row evolution label of the clean step.

    Identified keys: one row kept per (Monday week, key) - the last by time -
    then first sighting -> new, previous zone equal -> recurring, else migrant.
    Rows of anonymous keys and rows with no date (they cannot be placed in the
    week sequence) are never grouped: each is kept and labelled unclassifiable.

    The winners are picked on narrow columns (key, week, time, row id, zone) by
    a hash aggregation that reduces a hot key map-side; ``lag`` runs over the
    winners; their labels meet the wide rows on the row id, which spreads
    evenly. So the wide rows move once. Row ids must be unique; a null id
    raises (``writers.append_batch`` assigns them). ``keyed`` may give the narrow
    columns of the same rows from a shorter plan than ``df``'s.

    ``prior`` (columns ``key``, ``last_zone``) carries the state of keys seen
    before the first week of ``df``: such a key is not new, and its first row
    here compares with ``last_zone``. This is what makes incremental runs give
    the same labels as a full recompute.
    """
    cols = df.columns
    rid = F.coalesce(F.col(row_id), F.raise_error(F.lit(f"null {row_id}")).cast("long"))
    base = df.withColumn(row_id, rid)
    unplaced = F.coalesce(F.col(key).isin(anonymous), F.lit(False)) | F.col(ts).isNull()
    narrow = (base if keyed is None else keyed.withColumn(row_id, rid)).select(F.col(key).alias("__g"), week_monday(ts).alias("__w"),
                                          order_key(ts, row_id).alias("__o"), F.col(zone).alias("__z"), unplaced.alias("__u"))
    # unplaced rows go as groups (a key and week have them only or none): a filter on the rows
    # would be pushed below the key's rules and work each of them out several times
    won = narrow.groupBy("__w", "__g").agg(F.max("__o").alias("__o"), F.max_by("__z", "__o").alias("__z"), F.max("__u").alias("__u"))
    won = won.where("NOT __u").drop("__u")
    w = Window.partitionBy("__g").orderBy("__w")
    won = won.withColumn("__first", F.lag("__w").over(w).isNull()).withColumn("__prev", F.lag("__z").over(w))
    is_first, prev_zone = F.col("__first"), F.col("__prev")
    if prior is not None:
        p = prior.select(F.col("key").alias("__pk"), F.col("last_zone").alias("__pz"), F.lit(True).alias("__seen"))
        won = won.join(p, F.col("__g").eqNullSafe(F.col("__pk")), "left")
        is_first = F.col("__first") & F.col("__seen").isNull()
        prev_zone = F.when(F.col("__first"), F.col("__pz")).otherwise(F.col("__prev"))
    labels = won.select((F.col("__o") % F.lit(_SHIFT).cast("decimal(38,0)")).cast("long").alias("__rid"),
                        evolution_class(is_first, prev_zone, F.col("__z")).alias(out))
    got = base.join(labels, F.col(row_id) == F.col("__rid"), "left")
    return (got.where(unplaced | F.col(out).isNotNull())
               .withColumn(out, F.when(unplaced, F.lit(K.EVO_UNCLASSIFIED)).otherwise(F.col(out))).select(*cols, out))


def prior_state(clean: DataFrame, before_week, key: str = K.COL_KEY, zone: str = K.COL_ZONE,
                ts: str = K.COL_START, anonymous: list[str] = K.ANONYMOUS_KEYS) -> DataFrame:
    """(key, last_zone, last_week) from a stored clean history: each identified
    key's zone in its latest kept week before ``before_week``."""
    wk = week_monday(ts)
    past = clean.where((wk < F.lit(before_week)) & ~F.coalesce(F.col(key).isin(anonymous), F.lit(False)))
    return past.groupBy(F.col(key).alias("key")).agg(F.max_by(F.col(zone), wk).alias("last_zone"), F.max(wk).alias("last_week"))


PERSON_DAY = ["key", "day", "zone"]


def person_days(clean: DataFrame, key: str = K.COL_KEY, zone: str = K.COL_ZONE, ts: str = K.COL_START,
                row_id: str = K.COL_ROW_ID) -> DataFrame:
    """(key, day, zone): the zone of each key's first row of a day. A week of
    either kind (from Monday or from Sunday) has its first zone on its first day.
    Null keys and null days are kept; a key that many rows share is cut to one row
    per day map-side."""
    return clean.groupBy(F.col(key).alias("key"), F.to_date(ts).alias("day")).agg(F.min_by(F.col(zone), order_key(ts, row_id)).alias("zone"))


def _first_zones(rows: DataFrame, week_of, key: str, zone: str, ts: str, row_id: str) -> DataFrame:
    """(key, week, zone) with the zone of the week's first row, from clean rows or
    person days. Person days bucketed by key are neither shuffled here nor by a
    window over the key afterwards."""
    if set(PERSON_DAY) <= set(rows.columns) and ts not in rows.columns:
        first = F.coalesce(F.col("day"), F.to_date(F.lit("0001-01-01")))
        return rows.groupBy("key", week_of("day").alias("week")).agg(F.min_by("zone", first).alias("zone"))
    return rows.groupBy(F.col(key).alias("key"), week_of(ts).alias("week")).agg(F.min_by(F.col(zone), order_key(ts, row_id)).alias("zone"))


def top_weeks(weeks: DataFrame, week: str, n: int = K.LAST_WEEKS) -> DataFrame:
    """The n latest distinct weeks (bounded result: n rows)."""
    return weeks.select(week).where(F.col(week).isNotNull()).distinct().orderBy(F.col(week).desc()).limit(n)


def zone_evolution(df: DataFrame, targets: list[float] = (2.0, 14.0), key: str = K.COL_KEY,
                   zone: str = K.COL_ZONE, ts: str = K.COL_START, row_id: str = K.COL_ROW_ID,
                   last_weeks: int = K.LAST_WEEKS) -> DataFrame:
    """Weekly new / recurring / migrant counts for target zones (dashboard).

    All keys count, anonymous ones included (each anonymous value is one
    person). One row per (week, key) is kept - the first by time - and the
    state is carried over all zones. Output: the last ``last_weeks`` weeks present
    in the data, for every target, zero where the target has no rows. ``df``:
    clean rows or :func:`person_days`.
    """
    week = "week"
    if key not in df.columns and K.COL_DNI in df.columns:
        key = K.COL_DNI  # no categorised key yet: the raw ID column stands in
    first_rows = _first_zones(df, week_monday, key, zone, ts, row_id).where(F.col(week).isNotNull())
    w = Window.partitionBy("key").orderBy(week)
    lab = (first_rows.withColumn("is_first", F.lag(week).over(w).isNull())
                     .withColumn("prev_zone", F.lag("zone").over(w)))
    tgt = [float(t) for t in targets]
    # target test (numbers by value; text zones as 'N', 'N.0', 'COMUNAN')
    target, prev_is_target = None, None
    for t in tgt:
        here, before = is_target_zone(F.col("zone"), t), is_target_zone(F.col("prev_zone"), t)
        target = F.when(here, F.lit(t)) if target is None else target.when(here, F.lit(t))
        prev_is_target = (F.when(F.col("target") == F.lit(t), before) if prev_is_target is None
                          else prev_is_target.when(F.col("target") == F.lit(t), before))
    lab = lab.withColumn("target", target).where(F.col("target").isNotNull())
    lab = lab.withColumn("prev_is_target", F.coalesce(prev_is_target, F.lit(False)))
    counts = (lab.groupBy("target", week)
                 .agg(F.count_if("is_first").alias("nuevos"),
                      F.count_if(~F.col("is_first") & F.col("prev_is_target")).alias("recurrentes"),
                      F.count_if(~F.col("is_first") & ~F.col("prev_is_target")).alias("migratorios")))
    weeks = top_weeks(first_rows, week, last_weeks)
    scaffold = weeks.withColumn("target", F.explode(F.array(*[F.lit(t) for t in tgt])))
    out = scaffold.join(counts, ["target", week], "left")
    n = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("nuevos", "recurrentes", "migratorios")]
    out = out.select("target", week, label_day_month(week).alias("week_label"), *n)
    return out.withColumn("total", F.col("nuevos") + F.col("recurrentes") + F.col("migratorios"))


def chart_series(evo: DataFrame) -> DataFrame:
    """Chart dataset per target: week labels and the three series, in week order."""
    pts = F.sort_array(F.collect_list(F.struct("week", "week_label", "nuevos", "recurrentes", "migratorios")))
    g = evo.groupBy("target").agg(pts.alias("p"))
    return g.select(
        "target",
        F.transform("p", lambda x: x["week_label"]).alias("labels"),
        F.transform("p", lambda x: x["nuevos"]).alias("nuevos"),
        F.transform("p", lambda x: x["recurrentes"]).alias("recurrentes"),
        F.transform("p", lambda x: x["migratorios"]).alias("migratorios"))


def chart_document(evo: DataFrame) -> DataFrame:
    """Published chart document per target: labels and coloured datasets, as JSON."""
    datasets = F.array(*[F.struct(F.lit(label).alias("label"), F.col(label.lower()).alias("data"), F.lit(colour).alias("backgroundColor"))
                         for label, colour in K.CHART_COLOURS.items()])
    return chart_series(evo).select("target", F.to_json(F.struct("labels", datasets.alias("datasets"))).alias("chart"))


def population_weekly(df: DataFrame, key: str = K.COL_KEY, zone: str = K.COL_ZONE, ts: str = K.COL_START,
                      row_id: str = K.COL_ROW_ID, excluded: list[str] = K.VIEW_EXCLUDED_KEYS) -> DataFrame:
    """SQL-view population class per (key, Sunday week).

    Keys in ``excluded`` are dropped with SQL semantics (a null key is dropped
    too); the week's zone is the first by time; previous zone by ``lag``; no
    previous -> new, equal -> recurring, else migrant. ``df``: clean rows or
    :func:`person_days`.
    """
    g = _first_zones(df, week_sunday, key, zone, ts, row_id).where(~F.col("key").isin(excluded))
    g = g.select(F.col("key").alias("DNI"), F.col("week").alias("Semana"), F.col("zone").alias("Comuna_Semanal"))
    w = Window.partitionBy("DNI").orderBy("Semana")
    g = g.withColumn("Comuna_Anterior", F.lag("Comuna_Semanal").over(w))
    return g.withColumn("Condicion_Poblacion", population_class("Comuna_Anterior", "Comuna_Semanal"))

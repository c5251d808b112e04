"""The weekly run: newest landed report -> append-only raw history -> clean
history, updated incrementally.

The clean history is stored by month (of each row's Monday week, so a week
never straddles two months) as snapshots: version folders and a manifest
(sources/snapshots.py). An update re-cleans the raw rows from the first Monday of
the earliest month that any batch not yet cleaned can change, starts the evolution
labels from each key's last earlier zone, writes those months as a new version and
commits the snapshot that names them. Readers keep the old snapshot until then.

The manifest also says which batch a snapshot covers. A run that failed before its
commit leaves its batch pending, and the next run cleans it, whether or not a
report came. ``<clean>_keys`` holds the last zone of every key as of the end of a
month: an update starts from the newest copy that no later update has made stale
and reads only the months since.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import week_monday
from ..operators.evolution import prior_state
from ..operators.incremental import rows_after
from ..session import ensure_checkpoint_dir
from ..sources.readers import batch_stats, list_versions, newest_file, read_batches, read_report
from ..sources.snapshots import Snapshot, commit, expire, next_version, publish, read_snapshot, snapshots
from ..sources.writers import append_batch
from .aggregates import refresh_daily, refresh_persons
from .clean import clean_history, type_report

CLEAN_PART = K.CLEAN_PART


@dataclass
class WeeklyResult:
    report: str | None
    appended: bool
    raw_batch: str | None
    rebuilt: bool = False
    from_week: datetime.date | None = None


def _write_weeks(clean: DataFrame, path: str) -> None:
    """Month partitions, each in as few files as its size needs (the rebalance
    hint splits large months and joins small ones), sorted by date."""
    out = clean.withColumn(CLEAN_PART, F.date_format(week_monday(K.COL_START), "yyyy-MM"))
    out = out.hint("rebalance", CLEAN_PART).sortWithinPartitions(CLEAN_PART, K.COL_START)
    out.write.mode("overwrite").option("compression", "snappy").partitionBy(CLEAN_PART).parquet(path)


def _write_snapshot(clean: DataFrame, clean_path: str, batch: int, from_month: str) -> Snapshot:
    spark = clean.sparkSession
    version = next_version(spark, clean_path)
    _write_weeks(clean, f"{clean_path}/version={version}")
    return commit(spark, clean_path, version, batch, from_month)


def _previous_month(month: str) -> str:
    first = datetime.date.fromisoformat(month + "-01")
    return (first - datetime.timedelta(days=1)).strftime("%Y-%m")


def key_state(spark: SparkSession, clean_path: str, month: str, from_week: datetime.date) -> DataFrame:
    """(key, last_zone, last_week) before ``from_week``, the first Monday of
    ``month``: the newest valid copy joined with the months stored since, and
    kept as a copy of its own."""
    done = snapshots(spark, clean_path)
    base, asof = f"{clean_path}_keys", _previous_month(month)
    copies = []
    for as_of_update in list_versions(spark, base, "copy"):
        name = spark.read.parquet(f"{base}/copy={as_of_update}").select("asof", "made_by").first()
        if name and name.asof <= asof and not any(u.update > name.made_by and u.from_month <= name.asof for u in done):
            copies.append((name.asof, as_of_update))
    stored = read_snapshot(spark, clean_path, done[-1]).where(F.col(CLEAN_PART) <= asof)
    if copies:
        last, n = max(copies)
        old = spark.read.parquet(f"{base}/copy={n}").select("key", "last_zone", "last_week")
        if last == asof:
            return old
        stored = stored.where(F.col(CLEAN_PART) > last)
        new = prior_state(stored, from_week)
        both = old.unionByName(new)
        state = both.groupBy("key").agg(F.max_by("last_zone", "last_week").alias("last_zone"), F.max("last_week").alias("last_week"))
    else:
        state = prior_state(stored, from_week)
    n = max(list_versions(spark, base, "copy"), default=0) + 1
    made_by = done[-1].update if done else 0
    state.select("key", "last_zone", "last_week", F.lit(asof).alias("asof"), F.lit(made_by).alias("made_by")).write.mode("overwrite").parquet(f"{base}/copy={n}")
    return spark.read.parquet(f"{base}/copy={n}").select("key", "last_zone", "last_week")


# -- building and updating ---------------------------------------------------------

def build_clean(spark: SparkSession, raw_base: str, clean_path: str, zones: DataFrame, strict_coordinates: bool = True) -> None:
    """Clean the whole raw history and store it partitioned by month."""
    stats = batch_stats(spark, raw_base)
    raw_all = read_batches(spark, raw_base)
    _write_snapshot(clean_history(type_report(raw_all, strict_coordinates), zones), clean_path, stats[-1].batch, "")


def update_clean(spark: SparkSession, raw_base: str, clean_path: str, zones: DataFrame,
                 earliest: datetime.datetime, strict_coordinates: bool = True) -> datetime.date:
    """Re-clean the raw rows from the first Monday of the month of
    ``earliest``'s week on and commit a snapshot with those months anew. Returns
    that first Monday."""
    batch = batch_stats(spark, raw_base)[-1].batch
    week = (earliest - datetime.timedelta(days=earliest.weekday())).date()
    first_day = week.replace(day=1)
    from_week = first_day + datetime.timedelta(days=(7 - first_day.weekday()) % 7)
    month = from_week.strftime("%Y-%m")
    affected = read_batches(spark, raw_base).where(F.col(K.COL_START) >= F.lit(from_week).cast("timestamp"))
    prior = key_state(spark, clean_path, month, from_week)
    _write_snapshot(clean_history(type_report(affected, strict_coordinates), zones, prior=prior), clean_path, batch, month)
    return from_week


def clean_pending(spark: SparkSession, raw_base: str, clean_path: str, zones: DataFrame,
                  strict_coordinates: bool = True) -> tuple[bool, datetime.date | None]:
    """Clean every batch that no finished update covers: (rebuilt, first week
    updated). A history without a finished build is built whole, and so is one
    whose pending batches hold rows without a date."""
    stats = batch_stats(spark, raw_base)
    if not stats:
        return False, None
    done = snapshots(spark, clean_path)
    pending = [r for r in stats if r.batch > (done[-1].batch if done else 0)]
    if done and not pending:
        return False, None
    if not done or any(r.undated or r.first is None for r in pending):
        build_clean(spark, raw_base, clean_path, zones, strict_coordinates)
        return True, None
    earliest = min(r.first for r in pending)
    return False, update_clean(spark, raw_base, clean_path, zones, earliest, strict_coordinates)


def weekly_run(spark: SparkSession, landing: str, raw_base: str, clean_path: str, zones: DataFrame,
               table: str | None = None, glob: str = "*.csv", fmt: str = "csv", strict_coordinates: bool = True,
               keep_snapshots: int = 3, person_buckets: int | None = None) -> WeeklyResult:
    """One weekly cycle: pick the newest landed report, keep rows strictly
    after the history's latest date, append them as a raw batch, then clean all
    that is pending and optionally publish the table. Running it again after a
    failure, or with nothing new, is safe. Bad coordinate text ends the run,
    unless ``strict_coordinates`` is False (then it gives no zone). ``person_buckets``:
    see ``aggregates.person_buckets``."""
    ensure_checkpoint_dir(spark)
    path = newest_file(spark, landing, glob)
    raw_batch = None
    if path is not None:
        landed = read_report(spark, path, fmt)
        landed = landed.withColumn(K.COL_START, F.try_to_timestamp(F.col(K.COL_START).cast("string")))
        done = batch_stats(spark, raw_base)
        mark = max((r.mark for r in done if r.mark is not None), default=None)
        raw_batch = append_batch(rows_after(landed, bool(done), mark), raw_base)
    rebuilt, from_week = clean_pending(spark, raw_base, clean_path, zones, strict_coordinates)
    if snapshots(spark, clean_path):
        refresh_daily(spark, clean_path, keep_snapshots)
        refresh_persons(spark, clean_path, person_buckets, keep_snapshots)
        if table:
            publish(spark, clean_path, table)
        expire(spark, clean_path, keep_snapshots)
    return WeeklyResult(path, raw_batch is not None, raw_batch, rebuilt, from_week)


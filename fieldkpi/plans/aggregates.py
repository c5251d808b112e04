"""Tables kept beside a clean history and renewed by month.

``<clean>_daily`` holds the counts per zone and day, ``<clean>_persons`` the first
zone of each key and day, bucketed by key. Both are tables of snapshots like the
clean history itself (sources/snapshots.py); a snapshot names the update of the
clean history that it covers. A refresh reads only the months that later updates
have written anew, from the clean history's newest snapshot, so a report over years
of history costs a small table and a weekly refresh costs the months of that week.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.dates import week_monday
from ..operators.evolution import person_days
from ..operators.kpi import daily_counts
from ..sources.snapshots import _folders, commit, expire, next_version, read_bucketed, read_snapshot, snapshots, write_bucketed


def daily_path(clean_path: str) -> str:
    return f"{clean_path}_daily"


def write_daily(counts: DataFrame, path: str) -> None:
    """Daily counts by month of their week, a file or two a month."""
    out = counts.withColumn(K.CLEAN_PART, F.date_format("week", "yyyy-MM")).hint("rebalance", K.CLEAN_PART)
    out.write.mode("overwrite").partitionBy(K.CLEAN_PART).parquet(path)


def _refresh(spark: SparkSession, clean_path: str, base: str, write: Callable[[DataFrame, str], None], keep: int) -> str | None:
    """Bring a table to the newest snapshot of the clean history: the first month
    written anew ('' for all), or None if it was up to date. Running it again after
    a failure is safe."""
    clean = snapshots(spark, clean_path)
    if not clean:
        return None
    done = snapshots(spark, base)
    now, covered = clean[-1], done[-1].batch if done else 0
    if covered == now.update:
        return None
    later = [s.from_month for s in clean if s.update > covered]
    from_month = min(later) if done else ""
    rows = read_snapshot(spark, clean_path, now)
    if from_month:
        rows = rows.where(F.col(K.CLEAN_PART) >= from_month)
    version = next_version(spark, base)
    write(rows, f"{base}/version={version}")
    commit(spark, base, version, now.update, from_month)
    expire(spark, base, keep)
    return from_month


def refresh_daily(spark: SparkSession, clean_path: str, keep: int = 3) -> str | None:
    """Bring the daily counts to the newest snapshot of the clean history."""
    return _refresh(spark, clean_path, daily_path(clean_path), lambda rows, path: write_daily(daily_counts(rows), path), keep)


def read_daily(spark: SparkSession, clean_path: str) -> DataFrame:
    """The daily counts of the clean history's newest snapshot, refreshed where they are behind."""
    refresh_daily(spark, clean_path)
    return read_snapshot(spark, daily_path(clean_path)).drop(K.CLEAN_PART)


def person_buckets(spark: SparkSession, clean_path: str) -> int:
    """Buckets of the person days: those the table has, else one per shuffle partition."""
    have = [int(n) for n in _folders(spark, f"{clean_path}_persons", "buckets") if n.isdigit()]
    return max(have) if have else int(spark.conf.get("spark.sql.shuffle.partitions"))


def persons_path(clean_path: str, buckets: int) -> str:
    """A table per bucket count: files of different counts don't mix."""
    return f"{clean_path}_persons/buckets={buckets}"


def write_persons(days: DataFrame, path: str, buckets: int) -> None:
    """Person days by month of their week, bucketed by key."""
    write_bucketed(days.withColumn(K.CLEAN_PART, F.date_format(week_monday("day"), "yyyy-MM")), path, "key", buckets)


def refresh_persons(spark: SparkSession, clean_path: str, buckets: int | None = None, keep: int = 3) -> str | None:
    """Bring the person days to the newest snapshot of the clean history."""
    n = buckets or person_buckets(spark, clean_path)
    return _refresh(spark, clean_path, persons_path(clean_path, n), lambda rows, path: write_persons(person_days(rows), path, n), keep)


def read_persons(spark: SparkSession, clean_path: str, buckets: int | None = None) -> DataFrame:
    """The person days of the clean history's newest snapshot, refreshed where they are behind."""
    n = buckets or person_buckets(spark, clean_path)
    refresh_persons(spark, clean_path, n)
    return read_bucketed(spark, persons_path(clean_path, n), "key", n).drop(K.CLEAN_PART)

"""Snapshots of a table stored by month: versioned month folders and a manifest.

A write fills a version folder of its own, ``<base>/version=N/<month>``, and never
touches another. A snapshot is a list of months, each with the version that holds
it, in ``<base>_log/update=K``; it exists once that folder is committed, which is
the last step of an update. So a reader always meets a whole snapshot, the old one
or the new one, and a write that fails leaves nothing that a reader sees.
:func:`expire` removes versions that no kept snapshot names.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from .readers import _fs, list_versions

MANIFEST = "update int, batch int, from_month string, part string, version int"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # folder name of rows without a month


@dataclass(frozen=True)
class Snapshot:
    update: int
    batch: int
    from_month: str
    months: dict[str | None, int]  # month (None: rows without one) -> version

    def paths(self, base: str) -> list[str]:
        return [f"{base}/version={v}/{K.CLEAN_PART}={NO_MONTH if m is None else m}" for m, v in sorted(self.months.items(), key=lambda x: x[0] or "")]


def snapshots(spark: SparkSession, base: str) -> list[Snapshot]:
    """Committed snapshots in order; a manifest has a row per month."""
    done = list_versions(spark, f"{base}_log", "update")
    if not done:
        return []
    found: dict[int, list] = {}
    for r in spark.read.schema(MANIFEST).parquet(*[f"{base}_log/update={i}" for i in done]).collect():
        found.setdefault(r.update, []).append(r)
    return [Snapshot(u, rows[0].batch, rows[0].from_month, {r.part: r.version for r in rows if r.version is not None}) for u, rows in sorted(found.items())]


def _folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    fs, p = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n[len(prefix) + 1:] for n in names if n.startswith(prefix + "="))


def next_version(spark: SparkSession, base: str) -> int:
    """A version no folder has yet, not even one that a failed write left."""
    return max(map(int, _folders(spark, base, "version")), default=0) + 1


def commit(spark: SparkSession, base: str, version: int, batch: int, from_month: str) -> Snapshot:
    """The snapshot in which ``version`` holds every month from ``from_month`` on
    ('' for a whole build, which holds the rows without a month too)."""
    done = snapshots(spark, base)
    old = done[-1].months if done and from_month else {}
    months = {m: v for m, v in old.items() if m is None or m < from_month}
    months |= {None if m == NO_MONTH else m: version for m in _folders(spark, f"{base}/version={version}", K.CLEAN_PART)}
    update = done[-1].update + 1 if done else 1
    rows = [(update, batch, from_month, m, v) for m, v in months.items()] or [(update, batch, from_month, None, None)]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{base}_log/update={update}")
    return Snapshot(update, batch, from_month, months)


def read_snapshot(spark: SparkSession, base: str, snapshot: Snapshot | None = None) -> DataFrame:
    """A snapshot's rows with their month, by default the newest one's. The
    newest version names the columns. A folder without snapshots is read as it is."""
    if snapshot is None:
        done = snapshots(spark, base)
        if not done:
            return spark.read.parquet(base)
        snapshot = done[-1]
    schema = spark.read.parquet(f"{base}/version={max(snapshot.months.values())}").schema
    return spark.read.schema(schema).option("basePath", base).parquet(*snapshot.paths(base)).drop("version")


def expire(spark: SparkSession, base: str, keep: int = 3) -> list[int]:
    """Removes the versions that none of the last ``keep`` snapshots names; those
    newer than the last committed one may be in writing and stay."""
    done = snapshots(spark, base)
    if not done:
        return []
    used = {v for s in done[-keep:] for v in s.months.values()}
    gone = [v for v in map(int, _folders(spark, base, "version")) if v not in used and v < max(used, default=0)]
    for v in gone:
        fs, p = _fs(spark, f"{base}/version={v}")
        fs.delete(p, True)
    return gone


def _shown_store(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").where(F.col("col_name") == "View Text").collect()
    return rows[0]["data_type"].rpartition(" ")[2].strip("`") if rows else ""


def _create_store(spark: SparkSession, store: str, base: str, now: Snapshot, layout: str = "") -> None:
    """An external table over a snapshot's month folders."""
    rows = read_snapshot(spark, base, now)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    spark.sql(f"DROP TABLE IF EXISTS {store}")  # left by a run that failed; external, so files stay
    spark.sql(f"CREATE TABLE {store} ({columns}) USING parquet PARTITIONED BY ({K.CLEAN_PART}) {layout} LOCATION '{base}/version={max(now.months.values())}'")
    parts = " ".join(f"PARTITION ({K.CLEAN_PART}={'null' if m is None else repr(m)}) LOCATION '{p}'"
                     for m, p in zip(sorted(now.months, key=lambda x: x or ""), now.paths(base)))
    spark.sql(f"ALTER TABLE {store} ADD {parts}")


def write_bucketed(rows: DataFrame, path: str, key: str, buckets: int) -> None:
    """Rows by month in ``buckets`` files a month, all rows of a key in files of
    one number; for :func:`read_bucketed`."""
    name = f"escritura_{uuid.uuid4().hex}"
    try:
        rows.repartition(buckets, key).write.partitionBy(K.CLEAN_PART).bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name, format="parquet")
    finally:
        rows.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay


def read_bucketed(spark: SparkSession, base: str, key: str, buckets: int) -> DataFrame:
    """The newest snapshot of rows that :func:`write_bucketed` wrote, through a
    catalog table that tells Spark of the buckets: grouping by the key, and windows
    over it, then need no shuffle, however many months there are."""
    now = snapshots(spark, base)[-1]
    prefix = f"cubos_{hashlib.sha256(base.encode()).hexdigest()[:16]}_"
    store = f"{prefix}{now.update}"
    tables = [t.name for t in spark.catalog.listTables() if t.name.startswith(prefix)]
    if store not in tables:
        _create_store(spark, store, base, now, f"CLUSTERED BY ({key}) INTO {buckets} BUCKETS")
        for t in tables:
            if int(t[len(prefix):]) < now.update - 1:
                spark.sql(f"DROP TABLE IF EXISTS {t}")
    return spark.table(store)


def publish(spark: SparkSession, base: str, name: str) -> str:
    """Publish the newest snapshot as ``name`` without copying it: a store of its
    own (an external table over the snapshot's month folders) and one switch of
    the view that hides the storage column. Readers see the old store until the
    switch, and the store before the last stays for queries that still run."""
    done = snapshots(spark, base)
    if not done:
        raise ValueError(f"{base}: no snapshot to publish")
    now = done[-1]
    store = f"{name}_almacen_{now.update}"
    tables = {t.name: t.tableType for t in spark.catalog.listTables()}
    shown = _shown_store(spark, name) if tables.get(name) == "VIEW" else ""
    if shown == store:
        return store
    _create_store(spark, store, base, now)
    if tables.get(name, "VIEW") != "VIEW":  # an earlier full copy makes way for the view, once
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * EXCEPT ({K.CLEAN_PART}) FROM {store}")
    for t in tables:
        if t.startswith(f"{name}_almacen_") and t not in (store, shown):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
    return store

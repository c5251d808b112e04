"""SparkSession construction and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package relies on. AQE re-plans joins from measured
# sizes (broadcast when the built side is small, skew splitting otherwise).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "fieldkpi", shuffle_partitions: int | None = None,
              driver_memory: str | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster, ``master`` stays None and the launcher decides; tests pass
    ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if driver_memory:  # local mode: the driver JVM is the executor
        b = b.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, named in ``spark.checkpoint.dir``.

    Only a local master (tests) gets a fresh temporary folder where it is unset;
    anywhere else that raises, as executors share no machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="fieldkpi-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"


_MATERIALIZED: dict[tuple, str] = {}


def stored_path(write, spark: SparkSession, name: str, key: tuple = ()) -> str:
    """A folder of this session: ``write(path)`` fills a fresh one under the
    shared checkpoint folder once per session and key."""
    k = (spark.sparkContext.applicationId, name) + tuple(key)
    path = _MATERIALIZED.get(k)
    if path is None:
        path = scratch_dir(spark, f"tables/{name}-{uuid.uuid4().hex}")
        write(path)
        _MATERIALIZED[k] = path
    return path


def materialize(write, spark: SparkSession, name: str, key: tuple = ()) -> DataFrame:
    """A stored table of this session, written once (:func:`stored_path`); later
    calls read it back."""
    return spark.read.parquet(stored_path(write, spark, name, key))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition of a scan that yields fewer partitions than the
    cluster can run at once (small inputs stored as one row group). Large
    inputs already split into many tasks pass through unchanged. For scans
    only: it counts the partitions by planning what it is given."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df

"""Readers: newest landed report, report scan, append-only raw history and its statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K

# Landing schema of the interventions report (every cell as text, as exported).
REPORT_COLUMNS = [K.COL_START, "Fecha Fin", "Recurso Fecha Liberado", "Recurso Fecha asignacion",
                  "Recurso Arribo", K.COL_LAT, K.COL_LON, K.COL_DNI, K.COL_FIRST, K.COL_LAST, K.COL_AGENCY,
                  K.COL_SUPERVISOR, K.COL_RESULT, K.COL_STATE, K.COL_CARD]


def newest_file(spark: SparkSession, folder: str, glob: str = "*.csv") -> str | None:
    """Path of the most recently modified file matching ``glob`` (one row
    reaches the driver; file contents are not read)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(folder).select("path", "modificationTime"))
    row = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first()
    return row["p"] if row else None


def read_report(spark: SparkSession, path: str, fmt: str = "csv", banner: bool = True,
                sep: str = ",") -> DataFrame:
    """Scan landed report(s). CSV exports carry one banner line above the
    header. The header line is peeked on the driver (two lines of the first
    file), the files are read with an explicit all-text schema, quoted cells
    may hold line breaks and doubled quotes (so a file is one task: weekly
    reports are small), and the banner and header rows (one of each per file)
    are filtered out by literal match. Typing is the clean step's job."""
    import csv

    if fmt == "parquet":
        return spark.read.parquet(path)
    lines = [r.value for r in spark.read.text(path).take(2 if banner else 1)]
    if len(lines) < (2 if banner else 1):
        return spark.createDataFrame([], history_schema())
    head = lines[1] if banner else lines[0]
    names = next(csv.reader([head], delimiter=sep))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = spark.read.schema(schema).option("header", False).option("sep", sep).option("mode", "PERMISSIVE") \
        .option("multiLine", True).option("escape", '"').csv(path)
    first = F.col(f"`{names[0]}`")
    is_header = F.coalesce(first == F.lit(names[0]), F.lit(False))
    if banner:
        banner_cell = next(csv.reader([lines[0]], delimiter=sep))[0]
        rest_null = F.lit(True)
        for n in names[1:]:
            rest_null = rest_null & F.col(f"`{n}`").isNull()
        is_banner = F.coalesce(first == F.lit(banner_cell), F.lit(False)) & rest_null
        return df.where(~is_header & ~is_banner)
    return df.where(~is_header)


def history_schema(columns: list[str] | None = None) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (columns or REPORT_COLUMNS)])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_versions(spark: SparkSession, base: str, prefix: str = "batch") -> list[int]:
    """Committed batches (``<prefix>=N`` folders with a _SUCCESS marker)."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix + "="):
            if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def read_batches(spark: SparkSession, base: str, schema: T.StructType | None = None) -> DataFrame | None:
    """An append-only table: the union of its committed batches (columns
    aligned by name across batches); None / empty frame when there is none
    (a missing history is an empty one)."""
    batches = list_versions(spark, base)
    if not batches:
        return spark.createDataFrame([], schema) if schema is not None else None
    paths = [f"{base}/batch={b}" for b in batches]
    return spark.read.option("mergeSchema", True).parquet(*paths)


STATS = T.StructType([T.StructField("batch", T.IntegerType()), T.StructField("rows", T.LongType()),
                      T.StructField("first", T.TimestampType()), T.StructField("mark", T.TimestampType()),
                      T.StructField("undated", T.LongType()), T.StructField("last_id", T.LongType())])


def write_batch_stats(spark: SparkSession, base: str, batch: int, ts: str = K.COL_START, row_id: str = K.COL_ROW_ID) -> None:
    """One row of figures about a committed batch, beside the batches."""
    rows = spark.read.parquet(f"{base}/batch={batch}").select(F.col(ts).cast("timestamp").alias("t"), F.col(row_id).cast("long").alias("i"))
    rows.agg(F.lit(batch).alias("batch"), F.count("*").alias("rows"), F.min("t").alias("first"), F.max("t").alias("mark"),
             F.count_if(F.col("t").isNull()).alias("undated"), F.max("i").alias("last_id")
             ).coalesce(1).write.mode("overwrite").parquet(f"{base}/_stats/batch={batch}")


def batch_stats(spark: SparkSession, base: str) -> list:
    """The figures of all committed batches, in order: one small row a batch,
    so that no run has to read the history for its latest date or id. Figures
    that are missing (a run that failed after its batch) are made up for."""
    batches = list_versions(spark, base)
    if not batches:
        return []
    for b in sorted(set(batches) - set(list_versions(spark, f"{base}/_stats"))):
        write_batch_stats(spark, base, b)
    paths = [f"{base}/_stats/batch={b}" for b in batches]
    return sorted(spark.read.schema(STATS).parquet(*paths).collect(), key=lambda r: r.batch)

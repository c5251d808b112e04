"""Writers: append-only batches, table replace, sheet-style CSV, JSON payload,
one output per zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from .readers import batch_stats, read_batches, write_batch_stats

# FIXED VALUES: whole-cell texts a spreadsheet export shows for missing values
SHEET_NULL_MARKERS = ["nan", "NaT", "None", "<NA>"]


def append_batch(df: DataFrame, base: str, ts: str = K.COL_START, row_id: str = K.COL_ROW_ID) -> str | None:
    """Append ``df`` to an append-only table as its next batch folder; None
    (and nothing written) if ``df`` has no rows.

    Only the new rows are written; earlier batches are never rewritten, so a
    weekly append costs the size of the week, not of the history. Readers
    (``readers.read_batches``) take committed batches only.

    Row ids are given here and nowhere else, to batch and streaming input
    alike. Rows without the column get ids beyond all earlier ones. Ids that
    come with the rows are checked: null, negative or repeated ids, or ids of
    an earlier batch, end the append before the batch is committed.
    """
    spark = df.sparkSession
    done = batch_stats(spark, base)
    nxt = (done[-1].batch + 1) if done else 1
    path = f"{base}/batch={nxt}"
    given = row_id in df.columns
    if not given:
        offset = 1 + max([r.last_id for r in done], default=-1)
        df = df.withColumn(row_id, F.monotonically_increasing_id() + F.lit(offset))
    if df.isEmpty():
        return None
    if given:
        ids = df.select(F.col(row_id).cast("long").alias("id"))
        bad = ids.groupBy("id").agg(F.count("*").alias("n")).where("id IS NULL OR id < 0 OR n > 1").select("id")
        if done and (ids.agg(F.min("id")).first()[0] or 0) <= max(r.last_id for r in done):
            bad = bad.unionAll(ids.join(read_batches(spark, base).select(F.col(row_id).alias("id")), "id", "left_semi"))
        if not bad.isEmpty():
            raise ValueError(f"{row_id}: null, negative, repeated or already stored ids")
    df.write.mode("errorifexists").option("compression", "snappy").parquet(path)
    write_batch_stats(spark, base, nxt, ts, row_id)
    return path


def replace_table(df: DataFrame, name: str) -> None:
    """Replace a catalog table (failures raise), without the storage column."""
    df.drop(K.CLEAN_PART).write.mode("overwrite").saveAsTable(name)


def sheet_frame(df: DataFrame) -> DataFrame:
    """Every column as text; nulls and null markers blanked."""
    cols = []
    for c in df.columns:
        txt = F.col(f"`{c}`").cast("string")
        cols.append(F.when(txt.isNull() | txt.isin(SHEET_NULL_MARKERS), F.lit("")).otherwise(txt).alias(c))
    return df.select(*cols)


def write_sheet(df: DataFrame, path: str, single_file: bool = True) -> None:
    """Sheet-style CSV (header + text cells), replacing the previous content.

    Reports are aggregates (weeks x zones), so one output file is fine;
    ``single_file=False`` keeps Spark's partitioned output for large frames.
    """
    out = sheet_frame(df)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_payload(payload: DataFrame, path: str) -> None:
    """JSON lines (one document per scope)."""
    payload.write.mode("overwrite").json(path)


def write_per_zone(boards: DataFrame, path: str, zone: str = "zone") -> None:
    """One output folder per zone value; zones without rows write nothing."""
    boards.write.mode("overwrite").partitionBy(zone).parquet(path)

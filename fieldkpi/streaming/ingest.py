"""Incremental ingest of landed reports with Structured Streaming.

A file-source stream over the landing folder, run with
``trigger(availableNow=True)``: every new file is processed once (the stream's
checkpoint records which), and each micro-batch goes through the same
high-water-mark filter as the batch job; only the new rows are written, as
the next batch of the append-only raw history, with row ids given by the same
``append_batch``. ``plans.weekly.clean_pending`` then cleans what was ingested.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..operators.incremental import rows_after
from ..sources.readers import batch_stats
from ..sources.writers import append_batch


def _append_batch(raw_base: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first = F.col(f"`{batch.columns[0]}`")
        rest = [F.col(f"`{c}`").isNull() for c in batch.columns[1:]]
        banner = first.isNotNull() & reduce(lambda a, b: a & b, rest, F.lit(True))
        header = F.coalesce(first == F.lit(batch.columns[0]), F.lit(False))
        landed = batch.where(~banner & ~header).withColumn(K.COL_START, F.try_to_timestamp(F.col(K.COL_START).cast("string")))
        done = batch_stats(spark, raw_base)
        mark = max((r.mark for r in done if r.mark is not None), default=None)
        append_batch(rows_after(landed, bool(done), mark), raw_base)
    return run


def start_ingest(spark: SparkSession, landing: str, schema: T.StructType, raw_base: str, checkpoint: str,
                 fmt: str = "csv"):
    """Start the stream; returns the StreamingQuery (call awaitTermination)."""
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        # the banner and header lines are told by their cells, as in read_report
        reader = reader.option("header", False).option("multiLine", True).option("escape", '"')
    stream = reader.format(fmt).load(landing)
    return (stream.writeStream.foreachBatch(_append_batch(raw_base))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())

"""Continuous intake of landed day batches with Structured Streaming.

The landing folder is a file stream; a micro-batch names the dates whose files arrived since the last
one (the stream checkpoint remembers them).  ``foreachBatch`` then ingests those dates from the landing
folder, whole, with the same step as the batch route.  So a date whose files are spread over
micro-batches, or that gets a file later, ends with all its rows, and a retried micro-batch finds its
files in the table.  ``trigger(availableNow=True)`` turns the daily job into "process whatever has
landed, then stop".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.plans.ingest import ingest_dates
from tillroll.plans.marts import refresh_marts
from tillroll.sources.sales_table import date_versions, read_sales


def runs_path(sales_path: str) -> str:
    return sales_path.rstrip("/") + "_runs"


def _process(spark: SparkSession, raw: DataFrame, landing: str, sales_path: str, fmt: str, marts_out: str | None,
             epoch_id: int) -> None:
    # Dates in one micro-batch: bounded by the calendar days that landed.
    dates = sorted(r.d for r in raw.select(F.col("batch_date").cast("date").alias("d")).distinct().collect())
    if not dates:
        return
    status = ingest_dates(spark, landing, sales_path, dates, fmt)
    status.withColumn("epoch", F.lit(epoch_id)).write.mode("append").parquet(runs_path(sales_path))
    if marts_out:
        refresh_marts(read_sales(spark, sales_path), marts_out, versions=date_versions(spark, sales_path))


def start_intake(spark: SparkSession, landing: str, sales_path: str, checkpoint: str, marts_out: str | None = None,
                 fmt: str = "array", available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the intake stream; with ``available_now`` it stops once every
    landed file is processed (``query.awaitTermination()``).  ``checkpoint``: the stream's own folder,
    the same on every start."""
    reader = spark.readStream.format("text").option("wholetext", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing).select("batch_date")
    writer = (stream.writeStream
              .foreachBatch(lambda df, epoch: _process(spark, df, landing, sales_path, fmt, marts_out, epoch))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()

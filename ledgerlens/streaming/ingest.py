"""Structured Streaming ingest and scoring.

``ingest``: CSV files arriving under ``<root>/incoming/`` (name ending in
.csv or .csv.gz) are appended to the raw table.  The checkpointed file
source remembers which files it has taken, so a file event delivered twice
is loaded once.  Each micro-batch writes its rows into its own folder of
the table with ``overwrite``: a retried batch replaces its output instead of
appending it again, and a per-file load report (S3) is written beside it.

``score_stream``: JSON requests arriving in a folder are typed, featurised,
scored and written out, micro-batch by micro-batch (M8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import RAW_SCHEMA
from ..sources.files import FILE_PREFIX, parse_requests


def incoming_stream(spark: SparkSession, root: str, sep: str = ",", max_files: int | None = None,
                    null_value: str = "") -> DataFrame:
    """S2 source: fixed-schema CSV under root/incoming/, *.csv or *.csv.gz only."""
    r = (spark.readStream.schema(RAW_SCHEMA).option("header", True).option("sep", sep).option("quote", '"')
         .option("nullValue", null_value)
         .option("escape", '"').option("multiLine", True).option("mode", "FAILFAST")
         .option("timestampNTZFormat", "yyyy-MM-dd[ ]['T']HH:mm:ss[.SSSSSS]")
         .option("pathGlobFilter", "*.{csv,csv.gz}").option("recursiveFileLookup", True))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.csv(f"{root.rstrip('/')}/{FILE_PREFIX}").withColumn("source_file", F.col("_metadata.file_path"))


def ingest(spark: SparkSession, root: str, table: str, checkpoint: str, report: str | None = None,
           sep: str = ",", available_now: bool = True, null_value: str = "") -> StreamingQuery:
    """S2 + S3: append arriving CSV files to ``table`` (parquet), one folder per
    micro-batch; per-file row counts to ``report``."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # the files are parsed once: the report counts the rows that were written
        path = f"{table.rstrip('/')}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        if report is not None:
            (batch.sparkSession.read.parquet(path).groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))
             .withColumn("batch_id", F.lit(batch_id))
             .write.mode("overwrite").parquet(f"{report.rstrip('/')}/batch_id={batch_id}"))

    w = (incoming_stream(spark, root, sep, null_value=null_value).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def read_ingested(spark: SparkSession, table: str) -> DataFrame:
    """The raw table written by ``ingest`` (batch folders read as one table)."""
    return spark.read.parquet(table).drop("batch_id", "source_file")


def score_stream(spark: SparkSession, requests_dir: str, out: str, checkpoint: str, preproc, model,
                 threshold: float, secs_median: float | None, available_now: bool = True) -> StreamingQuery:
    """M8 as a stream: JSON requests -> scored decisions (parquet, append)."""
    from ..operators.scoring import score_requests
    req = parse_requests(spark.readStream.text(requests_dir))
    scored = score_requests(req, preproc, model, threshold, secs_median)
    w = (scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()

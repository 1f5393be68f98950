"""The cleaner and the event counters as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from granary.functions.text import clean_text, is_english
from granary.operators.ids import with_row_ids


def read_stream(spark: SparkSession, path: str, schema, files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def clean_stream(calls: DataFrame) -> DataFrame:
    """Cleaned questions with an English answer, each question once for all time (state grows with the questions)."""
    cleaned = calls.select("call_id", clean_text(F.col("querytext")).alias("question"), clean_text(F.col("kccans")).alias("answer"))
    return cleaned.filter(is_english(F.col("answer"))).dropDuplicates(["question"])


def clean_stream_within(calls: DataFrame, time: str, delay: str) -> DataFrame:
    """The same with bounded state: each question once within `delay`."""
    cleaned = calls.select(time, "call_id", clean_text(F.col("querytext")).alias("question"), clean_text(F.col("kccans")).alias("answer"))
    return cleaned.filter(is_english(F.col("answer"))).withWatermark(time, delay).dropDuplicatesWithinWatermark(["question"])


def run_available(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> StreamingQuery:
    """All that is there now, appended to a table; run again, it goes on where it ended."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = (writer.partitionBy(*partition_by) if partition_by else writer).start()
    query.awaitTermination()
    return query


def number_batches(df: DataFrame, order: list[str], path: str, checkpoint: str) -> StreamingQuery:
    """All that is there now, numbered on from the last id of the table in the given order within a batch, below batch=n.

    A batch's ids follow from the rows of the batches before it, so one that is tried again gets the same.
    """
    spark = df.sparkSession

    def add(rows: DataFrame, batch: int) -> None:
        before = spark.read.option("basePath", path).parquet(path).filter(F.col("batch") < batch).count() if batch else 0
        with_row_ids(rows, order, "id", start=before + 1).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    query = df.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def month_bundles(df: DataFrame, time: str) -> DataFrame:
    """`df` with (year, month) to partition a sink by."""
    return df.withColumns({"year": F.year(time), "month": F.month(time)})


def event_counts(events: DataFrame, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events of each type in tumbling windows, late ones within `late`."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"))

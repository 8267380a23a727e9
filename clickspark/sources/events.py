"""The sample ``events`` table as clicks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.schema import FILE_COLUMN
from clickspark.sources.shared import shared_path

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def as_clicks(events: DataFrame) -> DataFrame:
    """Events in the click schema; the day of an event stands for its file.

    Timestamps are read as UTC: the session time zone must be set to it.
    """
    # A column of its own, so that the text is parsed once per row.
    parsed = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k = F.col("k")
    device = F.when(k % 10 == 1, F.lit("dev,1")).when(
        k % 10 != 0, F.concat(F.lit("dev_"), (k % 3).cast("string"))
    )
    return parsed.select(
        F.col("user_id").cast("string").alias("anonymous_id"),
        F.col("event_type").alias("browser_family"),
        device.alias("device_family"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("device_sent_timestamp"),
        F.col("event_type").alias("event"),
        F.col("event_id").alias("n"),
        F.concat(F.lit("os_"), (F.col("user_id") % 3).cast("string")).alias("os_family"),
        F.col("ts").cast("date").cast("string").alias(FILE_COLUMN),
    )


def event_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_clicks(spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet"))


def stream_event_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_clicks(
        spark.readStream.schema(EVENTS_SCHEMA)
        .option("pathGlobFilter", "events.parquet")
        .option("maxFilesPerTrigger", 1)
        .parquet(sf_dir)
    )


#: Bytes of a row group of a replayed file: a task reads a few, whatever the file's size.
ROW_GROUP_BYTES = 8 << 20


def replayed(clicks: DataFrame, arrived: Column, parts: int) -> DataFrame:
    """``clicks`` as a stream of ``parts`` files, one a micro-batch, in the order of the
    whole number ``arrived``: its range is cut into parts of equal width. For replaying
    samples: a part is written as one file, so that it is one batch."""
    path = written_in_order(clicks, arrived, parts)
    stream = clicks.sparkSession.readStream.schema(clicks.schema)
    return stream.option("maxFilesPerTrigger", 1).parquet(path)


def written_in_order(
    clicks: DataFrame,
    arrived: Column,
    parts: int,
    format: str = "parquet",
    columns: list[str] | None = None,
) -> str:
    """The folder of ``replayed``, whose files are the older the earlier their part is.
    They have all ``columns`` of ``clicks``, or those given."""
    path = shared_path(clicks.sparkSession, "replayed")
    columns = columns or clicks.columns
    timed = clicks.withColumn("__arrived", arrived)
    low, high = timed.agg(F.min("__arrived"), F.max("__arrived")).first()
    if low is None:
        clicks.select(*columns).write.format(format).save(path)
    else:
        share = (F.col("__arrived") - F.lit(low)) * parts
        at = F.floor(share / F.lit(high - low + 1)).cast("int")
        for part in range(parts):  # one after the other, as files are taken by their age
            # Read and worked out in many tasks, written by one.
            chosen = timed.where(at == part).select(*columns).repartition(1)
            # Row groups small enough that the one file of a batch is read by many tasks.
            chosen.write.format(format).option("parquet.block.size", ROW_GROUP_BYTES).mode("append").save(path)
    return path

"""Session ids on a stream whose events arrive out of order.

Events wait in Spark's state store until the watermark has passed their block of
time. What is late by then, and what has no time, goes to a table of its own.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickspark.functions.columns import event_time, seconds, session_id, slot_start
from clickspark.operators.layout import fingerprint
from clickspark.schema import SessionSpec
from clickspark.streaming import reorder
from clickspark.streaming.sinks import BATCH_COLUMN

cloudpickle.register_pickle_by_value(reorder)

#: Every digit of a time, which JSON would else leave out.
_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_NULLS = {"ignoreNullFields": "false"}
PARTS = 64
_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _owner(spec: SessionSpec) -> Column:
    """Whose sessions are numbered together, as text; null without a user."""
    names = F.to_json(F.array(*(F.col(c).cast("string") for c in spec.owner)), _NULLS)
    return F.when(F.col(spec.user).isNotNull(), names)


def _sortable(column: Column, kind: T.DataType) -> Column:
    """Text that sorts as the values do, nulls first."""
    if isinstance(kind, T.TimestampType):
        column, kind = F.unix_micros(column), T.LongType()
    elif isinstance(kind, T.DateType):
        column, kind = F.unix_date(column), T.LongType()
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        order = F.lpad(F.hex(column.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    elif isinstance(kind, T.StringType):
        order = column
    else:
        raise TypeError(f"events cannot be put in order by a {kind.simpleString()} on a stream")
    return F.coalesce(F.concat(F.lit("1"), order), F.lit("0"))


def _rank(df: DataFrame, spec: SessionSpec) -> Column:
    """Order among the events of one user and moment, as the batch operators have it."""
    parts = [_sortable(F.col(c), df.schema[c].dataType) for c in spec.tiebreak]
    parts.append(_sortable(fingerprint(df, spec), T.LongType()))
    parts += [_sortable(F.col(c).cast("string"), T.StringType()) for c in spec.dims]
    return F.concat_ws("\x01", *parts)


def _waiting(
    stream: DataFrame, spec: SessionSpec, lateness: str, block_ms: int, parts: int
) -> DataFrame:
    """Events as the reorder buffer takes them, and reports to the block after."""
    ts, width = F.col("ts"), F.lit(block_ms).cast("long")
    timed = event_time(F.col(spec.ts))
    events = stream.select(
        timed.alias("__time"),
        F.pmod(F.xxhash64(*spec.keys), F.lit(parts)).cast("int").alias("part"),
        F.when(timed.isNotNull(), F.col(spec.ts)).alias("ts"),
        _owner(spec).alias("owner"),
        F.to_json(F.array(*(F.col(c).cast("string") for c in spec.keys)), _NULLS).alias("key"),
        _rank(stream, spec).alias("rank"),
        F.to_json(F.struct(*stream.columns), _TIMES | _NULLS).alias("row"),
    )
    # The time goes no further than the watermark: with it, Spark would drop late rows unseen.
    events = events.withWatermark("__time", lateness).drop("__time")
    block = slot_start(ts, block_ms)
    near = F.when(ts >= block + width - F.lit(spec.gap_ms), F.array(block, block + width))
    blocks = F.coalesce(near, F.array(block))
    placed = events.select("*", F.posexplode(blocks).alias("ahead", "block"))
    untimed = F.lit(reorder.UNTIMED).cast("long")
    return placed.select(
        "part",
        F.coalesce("block", untimed).alias("block"),
        "owner",
        "key",
        F.coalesce(ts, F.lit(0).cast("long")).alias("ts"),
        "rank",
        F.when(F.col("ahead") == 0, F.col("row")).alias("row"),
    )


def start_event_time(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    spec: SessionSpec = SessionSpec(mode="strict"),
    lateness: str = "1 day",
    block_ms: int | None = None,
    parts: int = PARTS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Sessionize a stream into ``out`` as the batch operator would, in any order of
    arrival within ``lateness``. Read it with ``read_released`` and ``read_aside``.

    An event is late if it is older than the watermark: the latest time of the
    micro-batches before, less ``lateness``. Late events, and events whose time is
    null or none that a timestamp can hold, are written aside with their reason;
    released, aside and ``held_events`` together are all that arrived.

    Events wait by key and by block of ``block_ms`` (at least the inactivity limit,
    which is the default); ``parts`` bounds how many such groups there are. A group
    is one part of the keys in one block, so neither memory nor state of a group
    holds a whole user. What crosses blocks is little: an event less than one limit
    before the end of its block is reported to the next. When a block is passed by
    the watermark its events are marked and released; a second keyed stage, which
    sees only where sessions start or go on (one row each), numbers those of each
    user. Users of null have no ids and are not numbered. Ties are ordered as in batch; ``tiebreak`` columns may be whole numbers,
    text, dates or timestamps. Columns travel as JSON, which must be able to hold them.

    A batch that runs again replaces its folders.
    """
    block_ms = max(spec.gap_ms, block_ms or spec.gap_ms)
    waiting = _waiting(stream, spec, lateness, block_ms, parts)
    released = waiting.groupBy("part", "block").transformWithStateInPandas(
        reorder.Reorder(spec.gap_ms, block_ms), reorder.RELEASED, "Append", "EventTime"
    )
    numbered = released.groupBy("lane").transformWithStateInPandas(
        reorder.Number(spec.gap_ms, block_ms), reorder.NUMBERED, "Append", "None"
    )
    schema = stream.schema

    def write(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        folder = f"{out}/released/{BATCH_COLUMN}={batch}"
        df.write.mode("overwrite").parquet(folder)
        rows = spark.read.schema(df.schema).parquet(folder)
        read = F.from_json("row", schema, _TIMES).alias("r")
        sessions = _identified(rows, spec).select(read, "is_start", "delta_ms", "number").select(
            "r.*",
            (~F.col("is_start")).alias("same_section"),
            seconds(F.col("delta_ms")).alias("delta_seg"),
            event_time(F.col("r." + spec.ts)).alias("event_time"),
            session_id(F.col("number"), F.col("r." + spec.user)).alias("session_id"),
        )
        sessions.write.mode("overwrite").parquet(f"{out}/events/{BATCH_COLUMN}={batch}")
        aside = rows.where("kind in ('late', 'untimed')").select(F.col("kind").alias("reason"), read)
        aside.select("r.*", "reason").write.mode("overwrite").parquet(f"{out}/aside/{BATCH_COLUMN}={batch}")

    # State of several kinds per key needs RocksDB, whatever the session was built with.
    # A query keeps the settings it started with, so the session gets its own back.
    conf = stream.sparkSession.conf
    before = conf.get(_PROVIDER_KEY, None)
    conf.set(_PROVIDER_KEY, _ROCKSDB)
    try:
        return (
            numbered.writeStream.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .foreachBatch(write)
            .start()
        )
    finally:
        if before is None:
            conf.unset(_PROVIDER_KEY)
        else:
            conf.set(_PROVIDER_KEY, before)


def _identified(rows: DataFrame, spec: SessionSpec) -> DataFrame:
    """Released events with the ``number`` of their session. The joins are by key and
    block, or by user and block, and may be split where they are skewed."""
    events = rows.where("kind = 'event'").drop("number")
    if spec.mode == "strict":
        numbers = rows.where("kind = 'number'").select("key", "ref", "number")
        return events.join(numbers, ["key", "ref"], "left")
    # What the user has started by then: before the block, and in it.
    block = F.substring_index("ref", ":", 1)
    bases = rows.where("kind = 'base'").select(
        F.col("key").alias("owner"), F.col("ref").alias("block"), F.col("number").alias("base")
    )
    at_moment = Window.partitionBy("owner", "block").orderBy("ts")
    owned = events.withColumn("block", block)
    keys = F.from_json("key", "array<string>")
    owner = F.to_json(F.slice(keys, 1, len(spec.owner)), _NULLS)
    owned = owned.withColumn("owner", F.when(keys[len(spec.owner) - 1].isNotNull(), owner))
    owned = owned.withColumn("started", F.sum(F.col("is_start").cast("long")).over(at_moment))
    joined = owned.join(bases, ["owner", "block"], "left")
    return joined.withColumn("number", F.col("base") + F.col("started"))


def read_released(spark: SparkSession, out: str) -> DataFrame:
    """Events that the watermark has passed, with their sessions."""
    return spark.read.parquet(f"{out}/events").drop(BATCH_COLUMN)


def read_aside(spark: SparkSession, out: str) -> DataFrame:
    """Events that are in no session, with the ``reason`` (``late`` or ``untimed``)
    and the ``batch`` that they came with. Counting them is exact over any number of
    batches, as each keeps its rows."""
    return spark.read.parquet(f"{out}/aside")


def held_events(spark: SparkSession, checkpoint: str, schema: T.StructType) -> DataFrame:
    """Events that still wait for the watermark, out of the state store."""
    # Operators are numbered from the end of the query: the buffer is the second.
    held = (
        spark.read.format("statestore")
        .option("path", checkpoint)
        .option("operatorId", 1)
        .option("stateVarName", "held")
        .load()
    )
    rows = held.select(F.explode("list_element.row").alias("row")).where(F.col("row").isNotNull())
    return rows.select(F.from_json("row", schema, _TIMES).alias("r")).select("r.*")

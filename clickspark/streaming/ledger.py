"""Session ids on a stream, by the batch operators.

``stateful.stream_sessionize`` brings the new events of a user to one Python
task. Here a micro-batch is sessionized like any other data, so a user may hold
any part of it. What earlier batches leave behind is kept in two tables under
the output folder, to which each batch adds a part of its own:

- ``open``: the last event of each key, to continue its session;
- ``users``: the number of sessions a user has started so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickspark.functions.columns import event_time, seconds, session_id
from clickspark.operators.layout import join_on_keys
from clickspark.operators.sessions import marked
from clickspark.schema import SessionSpec
from clickspark.streaming.sinks import BATCH_COLUMN, read_batches

_COUNT = T.LongType()


def _table_schema(source: T.StructType, columns: list[str], more: list[str]) -> T.StructType:
    fields = [source[c] for c in columns] + [T.StructField(m, _COUNT) for m in more]
    return T.StructType(fields)


class SessionLedger:
    """Writes sessionized batches and what the next batch needs to know of them.

    A batch reads only what lower batch ids wrote and replaces its own folders,
    so it may be run again. Every ``whole_every`` batches its part of the two
    tables is a whole one, before which no batch has to be read any more.
    """

    def __init__(self, out: str, spec: SessionSpec, whole_every: int = 50):
        self.out, self.spec, self.whole_every = out, spec, whole_every

    def _earlier(
        self, spark: SparkSession, name: str, schema: T.StructType, batch: int
    ) -> DataFrame:
        """Parts of a table from the last whole one on. None before batch 0."""
        if batch == 0:
            return spark.createDataFrame([], schema)
        whole = (batch - 1) // self.whole_every * self.whole_every
        parts = spark.read.schema(schema).parquet(f"{self.out}/{name}")
        at = F.col(BATCH_COLUMN)
        return parts.where((at >= whole) & (at < batch)).drop(BATCH_COLUMN)

    def _write(self, df: DataFrame, name: str, batch: int) -> None:
        path = f"{self.out}/{name}/{BATCH_COLUMN}={batch}"
        df.write.mode("overwrite").parquet(path)

    def add(self, df: DataFrame, batch: int) -> None:
        """Sessionize one micro-batch; the function for ``foreachBatch``."""
        spark, spec, ts = df.sparkSession, self.spec, F.col(self.spec.ts)
        keys, owner = spec.keys, spec.owner
        df = df.where(ts.isNotNull())
        first = df.agg(F.min(ts)).first()[0]
        since = F.lit(first if first is not None else 0) - F.lit(spec.gap_ms)
        open_schema = _table_schema(df.schema, keys, ["last_ts", "own"])
        users_schema = _table_schema(df.schema, owner, ["started"])

        latest = F.max(F.struct("last_ts", "own")).alias("l")
        open_ = (
            self._earlier(spark, "open", open_schema, batch)
            .where(F.col("last_ts") > since)
            .groupBy(*keys)
            .agg(latest)
            .select(*keys, "l.last_ts", "l.own")
        )
        users = (
            self._earlier(spark, "users", users_schema, batch)
            .groupBy(*owner)
            .agg(F.max("started").alias("started"))
        )

        # The last event of each open key goes in front of the new ones.
        carried = open_.select(
            *keys, F.col("last_ts").alias(spec.ts), F.lit(0).alias("__new")
        )
        rows = df.withColumn("__new", F.lit(1)).unionByName(carried, allowMissingColumns=True)
        ordered = spec.with_(tiebreak=("__new", *spec.tiebreak))
        new = marked(rows, ordered, numbered=True).where("__new = 1").drop("__new")

        # It counted as a start there, ahead of all that are new.
        ahead = open_.groupBy(*owner).agg(F.count(F.lit(1)).alias("__ahead"))
        known = join_on_keys(join_on_keys(new, users, owner, "left"), ahead, owner, "left")
        none = F.lit(0).cast("long")
        place = F.col("ordinal") - F.coalesce("__ahead", none)
        number = F.coalesce("started", none) + place
        if spec.mode == "strict":
            known = join_on_keys(known, open_.drop("last_ts"), keys, "left")
            number = F.when(place > 0, number).otherwise(F.col("own"))
        gap = F.when(F.col("is_start"), F.lit(0.0)).otherwise(seconds(ts - F.col("lag")))
        events = known.withColumns({"__number": number, "delta_seg": gap}).select(
            *df.columns,
            (~F.col("is_start")).alias("same_section"),
            "delta_seg",
            event_time(ts).alias("event_time"),
            session_id(F.col("__number"), F.col(spec.user)).alias("session_id"),
            F.col("__number").alias("number"),
        )
        self._write(events, "events", batch)

        written = spark.read.schema(events.schema).parquet(
            f"{self.out}/events/{BATCH_COLUMN}={batch}"
        )
        last = F.max(F.struct(ts.alias("last_ts"), F.col("number").alias("own"))).alias("l")
        still_open = written.groupBy(*keys).agg(last).select(*keys, "l.last_ts", "l.own")
        started = written.groupBy(*owner).agg(F.max("number").alias("started"))
        if batch % self.whole_every == 0:
            # Duplicates of a key do no harm: readers take the latest.
            still_open = still_open.unionByName(open_)
            started = started.unionByName(users)
        self._write(still_open, "open", batch)
        self._write(started, "users", batch)


def start_sessionizing(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    spec: SessionSpec = SessionSpec(mode="strict"),
    trigger: dict | None = None,
    whole_every: int = 50,
) -> StreamingQuery:
    """Sessionize a stream into ``out``; read it with ``read_sessions``.

    Batches must follow each other in time, as files of a log do. Events without
    a timestamp are left to the batch sessionizer.
    """
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(SessionLedger(out, spec, whole_every).add)
        .start()
    )


def read_sessions(spark: SparkSession, out: str) -> DataFrame:
    return read_batches(spark, f"{out}/events").drop("number")

"""Sessions as event-time session windows."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from clickspark.functions.columns import event_time, seconds
from clickspark.schema import SessionSpec
from clickspark.streaming.sinks import read_batches


def stream_session_windows(
    stream: DataFrame, spec: SessionSpec = SessionSpec(), lateness: str = "1 day"
) -> DataFrame:
    """One row per session: the keys, ``start_ts``, ``end_ts``, ``events`` and
    ``duration``. With the package's settings each task merges what it holds of
    a session before the shuffle, so a busy user sends one row per session.

    Spark's session window takes in an event exactly one gap after the last;
    here it begins a new session, hence one millisecond less. In append mode a
    session comes out once the watermark has passed its end, and leaves the state;
    ``all_windows`` adds those that are open when the stream stops. Complete mode
    would keep every session for ever.
    """
    if spec.gap_ms < 2:
        raise ValueError("session windows need a gap of at least 2 ms")
    window = F.session_window("__time", f"{spec.gap_ms - 1} milliseconds")
    span = F.col("end_ts") - F.col("start_ts")
    return (
        stream.withColumn("__time", event_time(F.col(spec.ts)))
        .withWatermark("__time", lateness)
        .groupBy(window, *spec.keys)
        .agg(
            F.min(spec.ts).alias("start_ts"),
            F.max(spec.ts).alias("end_ts"),
            F.count(F.lit(1)).alias("events"),
        )
        .select(*spec.keys, "start_ts", "end_ts", "events", seconds(span).alias("duration"))
    )


def open_windows(
    spark: SparkSession, checkpoint: str, spec: SessionSpec = SessionSpec()
) -> DataFrame:
    """Sessions that an append-mode query of ``stream_session_windows`` still keeps, as
    they stand after its last batch: read out of the state store, in the columns of
    the output. Nothing of the query has to run."""
    state = spark.read.format("statestore").option("path", checkpoint).load()
    # The window, the keys, and then the aggregates in the order of the query.
    names = [f.name for f in state.schema["value"].dataType][1:]
    kept = dict(zip([*spec.keys, "start_ts", "end_ts", "events"], names))
    columns = [F.col(f"value.`{name}`").alias(c) for c, name in kept.items()]
    span = F.col("end_ts") - F.col("start_ts")
    return state.select(*columns).withColumn("duration", seconds(span))


def all_windows(
    spark: SparkSession, out: str, checkpoint: str, spec: SessionSpec = SessionSpec()
) -> DataFrame:
    """Every session of a stopped append-mode query: those written when the watermark
    passed them, none of them ever rewritten, and those still open."""
    return read_batches(spark, out).unionByName(open_windows(spark, checkpoint, spec))


class DroppedRows(StreamingQueryListener):
    """Rows that a watermark made Spark drop, by query id, over all batches since
    ``spark.streams.addListener``: progress reports that a query no longer keeps
    are in it. Session windows are merged within a task first, and count as one row
    then; ``event_time.read_aside`` has the events themselves."""

    def __init__(self) -> None:
        self.rows: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for operator in event.progress.stateOperators:
            self.rows[str(event.progress.id)] += operator.numRowsDroppedByWatermark

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

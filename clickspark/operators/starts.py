"""Session starts by aggregation alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.functions.columns import slot_start
from clickspark.schema import SessionSpec


def session_starts(df: DataFrame, spec: SessionSpec = SessionSpec()) -> DataFrame:
    """Where sessions begin: the key columns, ``start_ts`` and ``starts``.

    Time is cut into slots as wide as the inactivity limit. Two events of a key
    in one slot are closer than the limit, so only the first event of a slot can
    start a session, and whether it does depends only on the last event of the
    slot before. Each event therefore reports to its own slot and, as a
    predecessor, to the next one; one aggregate with map-side combine settles
    all slots. There is no window, no sort and no group that grows with a user:
    shuffled rows are at most two per key and slot and task.

    ``starts`` is 1, or the number of events for those without a timestamp,
    each of which counts as a session.
    """
    ts = F.col(spec.ts)
    slot = slot_start(ts, spec.gap_ms)
    nothing = F.lit(None).cast("long")
    reports = df.select(
        *spec.keys,
        F.stack(
            F.lit(2),
            slot, ts, nothing, F.lit(1),
            F.try_add(slot, F.lit(spec.gap_ms).cast("long")), nothing, ts, F.lit(0),
        ).alias("__slot", "__own", "__before", "__here"),
    )
    slots = reports.groupBy(*spec.keys, "__slot").agg(
        F.min("__own").alias("start_ts"),
        F.max("__before").alias("__previous"),
        F.sum("__here").alias("__events"),
    )
    near = F.try_subtract("start_ts", "__previous") < F.lit(spec.gap_ms)
    starts = (
        F.when(F.col("__slot").isNull(), F.col("__events"))
        .when(F.coalesce(near, F.lit(False)), F.lit(0).cast("long"))
        .otherwise(F.lit(1).cast("long"))
    )
    return (
        slots.where("__events > 0")
        .withColumn("starts", starts)
        .where("starts > 0")
        .select(*spec.keys, "start_ts", "starts")
    )

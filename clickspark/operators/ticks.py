"""Sessions without large groups: the ticks layout.

A tick is one timestamp of one key, whatever the number of events on it. Events
are reduced to ticks before the first shuffle, so a user, a device or a group of
copies that holds a large part of the data weighs no more than the timestamps it
covers. Gaps and numbers are worked out on ticks, in blocks of time, and brought
back to the events by a join whose skewed partitions Spark can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickspark.functions.columns import continues
from clickspark.operators.layout import (
    blocked_running,
    fingerprint,
    join_on_keys,
    numbered_in_order,
    repeated,
)
from clickspark.schema import SessionSpec
from clickspark.sources.shared import materialize


def _rank_of_row(df: DataFrame, spec: SessionSpec) -> Column:
    """Order among the events of one tick; equal only for copies of an event."""
    return F.struct(*[F.col(c) for c in spec.tiebreak], fingerprint(df, spec).alias("__print"))


def gap_ticks(df: DataFrame, spec: SessionSpec, ranked: bool = True) -> DataFrame:
    """One row per key and timestamp: ``copies`` (events on it), ``lag`` (the
    timestamp before) and ``starts`` (sessions beginning here: 0 or 1, and every
    event where there is no timestamp)."""
    measures = [F.count(F.lit(1)).alias("copies")]
    if ranked:
        measures.append(F.min(_rank_of_row(df, spec)).alias("first_rank"))
    ticks = materialize(df.groupBy(*spec.keys, spec.ts).agg(*measures), "ticks")
    ts = F.col(spec.ts)
    lagged = blocked_running(
        ticks, spec.keys, spec.ts, ts, F.max, "lag", spec.block_ms, inclusive=False
    )
    starts = (
        F.when(ts.isNull(), F.col("copies"))
        .when(continues(ts, F.col("lag"), spec.gap_ms), F.lit(0).cast("long"))
        .otherwise(F.lit(1).cast("long"))
    )
    return lagged.withColumn("starts", starts)


def numbered_ticks(df: DataFrame, spec: SessionSpec) -> DataFrame:
    """Ticks with ``ordinal``, the session number their events carry."""
    ticks = materialize(gap_ticks(df, spec), "gap-ticks")
    owner, ts = spec.owner, spec.ts
    moments = materialize(
        ticks.groupBy(*owner, ts).agg(F.sum("starts").alias("here")), "moments"
    )
    started = blocked_running(
        moments, owner, ts, F.col("here"), F.sum, "started", spec.block_ms, True
    )
    if spec.mode == "compat":
        return join_on_keys(
            ticks, started.select(*owner, ts, F.col("started").alias("ordinal")), [*owner, ts]
        )
    # Sessions that start on one moment of one user: at most one per dimensions.
    tied = Window.partitionBy(*owner, ts).orderBy("first_rank", *spec.dims)
    own = (
        join_on_keys(ticks.where("starts > 0"), started, [*owner, ts])
        .withColumn("own", F.col("started") - F.col("here") + F.sum("starts").over(tied))
        .select(*spec.keys, ts, "own")
    )
    numbered = materialize(
        join_on_keys(ticks, own, [*spec.keys, ts], "left"), "numbered-ticks"
    )
    return blocked_running(
        numbered, spec.keys, ts, F.col("own"), F.max, "ordinal", spec.block_ms, True
    ).drop("own")


def _spread_copies(copies: DataFrame, columns: list[str]) -> DataFrame:
    """Events that equal the first event of their tick in every column, of which
    exactly one is the first. They are counted before the shuffle, and given back
    in portions that go to different tasks."""
    counted = copies.groupBy(*columns).agg(F.count(F.lit(1)).alias("__times"))
    return (
        repeated(counted, "__times", "__i")
        .withColumn("__first", F.col("__i") == 0)
        .drop("__i")
    )


def marked_by_tick(df: DataFrame, spec: SessionSpec, numbered: bool) -> DataFrame:
    """Events with ``lag``, ``is_start`` and, if asked for, ``ordinal``."""
    ticks = numbered_ticks(df, spec) if numbered else gap_ticks(df, spec)
    ticks = materialize(ticks, "marks")
    ts = F.col(spec.ts)
    if numbered and spec.mode == "strict":
        # Each event without a timestamp has a session of its own, so also a number.
        untimed, df = df.where(ts.isNull()), df.where(ts.isNotNull())
    else:
        untimed = None
    events = df.withColumn("__rank", _rank_of_row(df, spec))
    placed = join_on_keys(events, ticks, [*spec.keys, spec.ts])
    is_lead = F.col("__rank") == F.col("first_rank")
    # Where there is no timestamp every event is a start, and none is special.
    open_case = (F.col("copies") > 1) & is_lead & ts.isNotNull()
    settled = placed.where(~open_case).withColumn("__first", is_lead)
    spread = _spread_copies(placed.where(open_case), placed.columns)
    both = settled.unionByName(spread)
    first_lag = F.when(F.col("__first") | ts.isNull(), F.col("lag")).otherwise(ts)
    is_start = ts.isNull() | (F.col("__first") & (F.col("starts") > 0))
    marked = both.withColumns({"lag": first_lag, "is_start": is_start}).drop(
        "__rank", "__first", "first_rank", "copies", "starts"
    )
    return marked if untimed is None else marked.unionByName(_untimed(untimed, spec))


def _untimed(df: DataFrame, spec: SessionSpec) -> DataFrame:
    """Events without a timestamp, numbered before all others of their user, in order
    of tiebreak, other columns and dimensions, as in the user layout. Copies are
    counted, and given back with a number each."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__times"))
    counted = counted.withColumn("__print", fingerprint(df, spec))
    order = [*spec.tiebreak, "__print", *spec.dims]
    placed = numbered_in_order(counted, spec.owner, order, "__times", "__ahead")
    each = repeated(placed, "__times", "__i")
    return each.select(
        *df.columns,
        F.lit(None).cast("long").alias("lag"),
        F.lit(True).alias("is_start"),
        (F.col("__ahead") + F.col("__i") + 1).alias("ordinal"),
    )

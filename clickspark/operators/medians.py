"""Medians of gaps and durations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickspark.functions.columns import dimension_rows, seconds, slot_start
from clickspark.operators.layout import by_size, join_on_keys, repeated
from clickspark.operators.sessions import marked
from clickspark.operators.ticks import gap_ticks
from clickspark.schema import SessionSpec

VALUES_PER_BLOCK = 1_000_000


def continuation_gaps(df: DataFrame, spec: SessionSpec = SessionSpec()) -> DataFrame:
    """Gaps in front of the events that continue a session: the key columns,
    ``gap_ms`` and ``events``, the number of events with that gap. Reads only
    keys and timestamp: which of several events of a moment is taken for the
    first changes none of their gaps."""
    spec = spec.with_(tiebreak=())
    small, large = by_size(df.select(*spec.keys, spec.ts), spec)
    parts = []
    if small is not None:
        parts.append(_gaps_by_user(small, spec.with_(layout="user")))
    if large is not None:
        parts.append(_gaps_by_tick(large, spec))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _gaps_by_user(df: DataFrame, spec: SessionSpec) -> DataFrame:
    gap = F.col(spec.ts) - F.col("lag")
    return (
        marked(df, spec, numbered=False)
        .where(~F.col("is_start"))
        .select(*spec.keys, gap.alias("gap_ms"), F.lit(1).cast("long").alias("events"))
    )


def _gaps_by_tick(df: DataFrame, spec: SessionSpec) -> DataFrame:
    """On a tick of several events all but the first follow without a gap."""
    one = F.lit(1).cast("long")
    return (
        gap_ticks(df, spec, ranked=False)
        .where(F.col(spec.ts).isNotNull())
        .select(
            *spec.keys,
            F.stack(
                F.lit(2),
                F.col(spec.ts) - F.col("lag"), one - F.col("starts"),
                F.lit(0).cast("long"), F.col("copies") - one,
            ).alias("gap_ms", "events"),
        )
        .where("events > 0")
    )


def one_row_per_event(gaps: DataFrame) -> DataFrame:
    """Gaps as often as there are events with them, for sketches, which take no
    weights. Only copies of events have a number above one."""
    several = repeated(gaps.where("events > 1"), "events", "__i").drop("__i")
    return gaps.where("events = 1").drop("events").unionByName(several)


def by_dimension(rows: DataFrame, spec: SessionSpec, values: list[str], by=()) -> DataFrame:
    """One row per dimension: ``what``, ``ref`` and the ``values`` of the row."""
    return rows.select(*by, *values, dimension_rows(spec))


def _holds_low(upto: Column, weight: Column, total: Column) -> Column:
    """Whether the lower middle position lies within the last ``weight`` of ``upto``."""
    return (upto * 2 >= total) & ((upto - weight) * 2 < total)


def _holds_high(upto: Column, weight: Column, total: Column) -> Column:
    return (upto * 2 > total) & ((upto - weight) * 2 <= total)


def median_of_counts(
    rows: DataFrame, groups: list[str], value: str, weight: str, between: bool = False
) -> DataFrame:
    """Exact median per group of ``value`` taken ``weight`` times each.

    Equal values are added up before the shuffle. Positions are counted on
    blocks of values first, and on single values only in the block or two that
    hold the middle, so no task sorts more than ``VALUES_PER_BLOCK`` values,
    however many there are of one group. The result is the lower of two middle
    values, or half way ``between`` them. ``value`` is a whole number.
    """
    counted = (
        rows.groupBy(*groups, value)
        .agg(F.sum(weight).alias("__w"))
        .withColumn("__block", slot_start(F.col(value), VALUES_PER_BLOCK))
    )
    of_group = Window.partitionBy(*groups)
    until = of_group.orderBy("__block").rowsBetween(Window.unboundedPreceding, 0)
    upto, total = F.col("__upto"), F.col("__total")
    holding = (
        counted.groupBy(*groups, "__block")
        .agg(F.sum("__w").alias("__in_block"))
        .withColumn("__upto", F.sum("__in_block").over(until))
        .withColumn("__total", F.sum("__in_block").over(of_group))
        .where(
            _holds_low(upto, F.col("__in_block"), total)
            | _holds_high(upto, F.col("__in_block"), total)
        )
        .select(
            *groups, "__block", "__total", (upto - F.col("__in_block")).alias("__before")
        )
    )
    within = (
        Window.partitionBy(*groups, "__block")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = join_on_keys(counted, holding, [*groups, "__block"]).withColumn(
        "__upto", F.col("__before") + F.sum("__w").over(within)
    )
    low = F.min(F.when(_holds_low(upto, F.col("__w"), total), F.col(value)))
    high = F.min(F.when(_holds_high(upto, F.col("__w"), total), F.col(value)))
    middle = (low + high) / F.lit(2.0) if between else low
    return placed.groupBy(*groups).agg(middle.alias("median"))


def approximate_median(value: Column, accuracy: int = 10_000) -> Column:
    return F.percentile_approx(value, 0.5, accuracy)


def median_gap_by_dim(
    df: DataFrame,
    spec: SessionSpec = SessionSpec(),
    exact: bool = False,
    between: bool = False,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Rows ``(what, ref, median)``: seconds between events within a session.

    By default an approximate percentile, which is an observed gap and, up to
    10,000 gaps per value, the lower middle one. ``exact`` is that element for
    any number of gaps; ``between`` averages the two middle ones. ``by`` keeps
    further columns apart, such as the file.
    """
    gaps, groups = continuation_gaps(df, spec), [*by, "what", "ref"]
    if exact or between:
        rows = by_dimension(gaps, spec, ["gap_ms", "events"], by)
        found = median_of_counts(rows, groups, "gap_ms", "events", between)
        return found.withColumn("median", seconds(F.col("median")))
    rows = by_dimension(one_row_per_event(gaps), spec, ["gap_ms"], by)
    gap = seconds(F.col("gap_ms"))
    return rows.groupBy(*groups).agg(approximate_median(gap).alias("median"))


def approx_quantile_gap(
    df: DataFrame,
    spec: SessionSpec = SessionSpec(),
    fraction: float = 0.5,
    relative_error: float = 0.25,
) -> DataFrame:
    """One row: a ``quantile`` of all continuation gaps, and what is proven of it.

    ``rank_from`` and ``rank_to`` are the positions (from 1, of ``gaps`` in ascending
    order) that a sketch of ``relative_error`` may take the value from: those within
    the error of the exact one. ``least_rank`` and ``most_rank`` are the positions
    that the value really has, counted in a second pass over the gaps, so ``proven``
    (the two intervals meet) does not rest on the sketch. Without gaps: nulls and 0.
    """
    gaps = continuation_gaps(df, spec)
    accuracy = max(1, math.ceil(1 / relative_error))
    value = F.percentile_approx("gap_ms", fraction, accuracy)
    sketched = one_row_per_event(gaps).agg(value.alias("quantile_ms"))
    weight = lambda of: F.coalesce(F.sum(F.when(of, F.col("events"))), F.lit(0).cast("long"))
    gap, at = F.col("gap_ms"), sketched.scalar()
    counted = gaps.agg(
        F.max(at).alias("quantile_ms"),
        weight(F.lit(True)).alias("gaps"),
        (weight(gap < at) + 1).alias("least_rank"),
        weight(gap <= at).alias("most_rank"),
    )
    exact, error = F.ceil(F.col("gaps") * fraction), F.floor(F.col("gaps") / F.lit(accuracy))
    bounded = counted.withColumns(
        {
            "rank_from": F.greatest(exact - error, F.lit(1)).cast("long"),
            "rank_to": F.least(exact + error, F.col("gaps")).cast("long"),
        }
    )
    meet = (F.col("least_rank") <= F.col("rank_to")) & (F.col("most_rank") >= F.col("rank_from"))
    return bounded.select(
        seconds(F.col("quantile_ms")).alias("quantile"), "gaps", "rank_from", "rank_to", "least_rank", "most_rank",
        meet.alias("proven"),
    )


def median_gap_by_session(
    sessionized: DataFrame, spec: SessionSpec = SessionSpec()
) -> DataFrame:
    """Approximate median of ``delta_seg`` per session, start rows included. Ids
    repeat between scopes, so results carry the scope's columns too."""
    return sessionized.groupBy(*spec.scope, "session_id").agg(
        approximate_median(F.col("delta_seg")).alias("median")
    )


def median_distinct_gap_by_session(
    sessionized: DataFrame, spec: SessionSpec = SessionSpec()
) -> DataFrame:
    """Median of the different gaps of each session, to two decimals, as float.

    Worked out in whole milliseconds, with positions counted in blocks of them: no
    task holds the gaps of a session (all users without an id are one).
    """
    ms = F.round(F.col("delta_seg") * 1000).cast("long")
    groups = [*spec.scope, "session_id"]
    gaps = sessionized.select(*groups, ms.alias("gap_ms")).distinct().withColumn("one", F.lit(1))
    found = median_of_counts(gaps, groups, "gap_ms", "one", between=True)
    rounded = F.rint(seconds(F.col("median")) * 100) / F.lit(100.0)
    return found.withColumn("median", rounded.cast("float"))


def session_durations(
    sessionized: DataFrame, spec: SessionSpec = SessionSpec(), per_key: bool = False
) -> DataFrame:
    """Seconds from first to last event of each session. ``per_key`` keeps the
    dimensions, which a session of the strict mode has one of each."""
    groups = [*(spec.keys if per_key else spec.owner), "session_id"]
    span = F.max(spec.ts) - F.min(spec.ts)
    return (
        sessionized.where(F.col("session_id").isNotNull())
        .groupBy(*groups)
        .agg(span.alias("duration_ms"), seconds(span).alias("duration"))
    )


def median_session_duration_by_dim(
    sessionized: DataFrame, spec: SessionSpec = SessionSpec(), exact: bool = False
) -> DataFrame:
    """Rows ``(what, ref, median)`` over the durations of strict sessions."""
    durations = session_durations(sessionized, spec, per_key=True)
    rows = by_dimension(durations.withColumn("one", F.lit(1)), spec, ["duration_ms", "one"])
    if exact:
        found = median_of_counts(rows, ["what", "ref"], "duration_ms", "one")
        return found.withColumn("median", seconds(F.col("median")))
    return rows.groupBy("what", "ref").agg(
        approximate_median(seconds(F.col("duration_ms"))).alias("median")
    )

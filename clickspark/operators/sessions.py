"""The sessionizer: gaps between events, session starts and session ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickspark.functions.columns import (
    continues,
    event_time,
    seconds,
    session_id,
    session_tag,
)
from clickspark.operators.layout import by_size, fingerprint
from clickspark.operators.ticks import marked_by_tick
from clickspark.schema import SessionSpec


def _marked_by_user(df: DataFrame, spec: SessionSpec, numbered: bool) -> DataFrame:
    """Events with ``lag``, ``is_start`` and, if asked for, ``ordinal``.

    One shuffle by user serves every window: each partitions by the user or by
    more. Events of one key, moment and tiebreak go by a hash of their other
    columns, as they do in ticks, so only copies are alike. The running counts
    stand in for row number and forward fill: the last session a user started by
    some time is as many as were started by then.
    """
    ts = F.col(spec.ts)
    of_key = Window.partitionBy(*spec.keys).orderBy(spec.ts, *spec.tiebreak, "__print")
    # Hashed before the shuffle, which so takes no column that is only hashed.
    placed = df.withColumn("__print", fingerprint(df, spec)).repartition(*spec.owner)
    lagged = placed.withColumn("lag", F.lag(spec.ts).over(of_key))
    marked = lagged.withColumn(
        "is_start", ~continues(ts, F.col("lag"), spec.gap_ms)
    )
    if not numbered:
        return marked.drop("__print")
    started = F.col("is_start").cast("long")
    if spec.mode == "compat":
        # Ranges over the timestamp alone: events of one moment share the number.
        by_moment = Window.partitionBy(*spec.owner).orderBy(spec.ts)
        return marked.withColumn("ordinal", F.sum(started).over(by_moment)).drop("__print")
    in_order = (
        Window.partitionBy(*spec.owner)
        .orderBy(spec.ts, *spec.tiebreak, "__print", *spec.dims)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    own = marked.withColumn("__own", F.sum(started).over(in_order))
    latest = F.max(F.when(F.col("is_start"), F.col("__own"))).over(
        of_key.rowsBetween(Window.unboundedPreceding, 0)
    )
    return own.withColumn("ordinal", latest).drop("__own", "__print")


def marked(df: DataFrame, spec: SessionSpec, numbered: bool) -> DataFrame:
    small, large = by_size(df, spec)
    parts = []
    if small is not None:
        parts.append(_marked_by_user(small, spec, numbered))
    if large is not None:
        parts.append(marked_by_tick(large, spec, numbered))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def session_gaps(df: DataFrame, spec: SessionSpec = SessionSpec()) -> DataFrame:
    """Events with ``lag``, ``delta_seg`` (null on the first event of a key),
    ``same_section`` and ``event_time``."""
    ts = F.col(spec.ts)
    return (
        marked(df, spec, numbered=False)
        .withColumns(
            {
                "delta_seg": seconds(F.try_subtract(ts, F.col("lag"))),
                "same_section": ~F.col("is_start"),
                "event_time": event_time(ts),
            }
        )
        .drop("is_start")
    )


def _zero_at_start(spec: SessionSpec):
    return F.when(F.col("is_start"), F.lit(0.0)).otherwise(
        seconds(F.try_subtract(F.col(spec.ts), F.col("lag")))
    )


def session_smoke(df: DataFrame, spec: SessionSpec = SessionSpec()) -> DataFrame:
    """Events with ``partial_session``: the session tag on start rows only.

    The view to look at before ids are filled in. Numbers are those of the
    strict mode, which tells apart sessions started at the same moment.
    """
    numbered = marked(df, spec.with_(mode="strict"), numbered=True)
    tag = F.when(F.col("is_start"), session_tag(F.col("ordinal")))
    return numbered.withColumns(
        {
            "delta_seg": _zero_at_start(spec),
            "same_section": ~F.col("is_start"),
            "event_time": event_time(F.col(spec.ts)),
            "partial_session": tag,
        }
    ).drop("lag", "is_start", "ordinal")


def sessionize(df: DataFrame, spec: SessionSpec = SessionSpec()) -> DataFrame:
    """Events with ``delta_seg`` (0 on session starts), ``same_section``,
    ``event_time`` and ``session_id``. Unordered: sort where it is shown."""
    return (
        marked(df, spec, numbered=True)
        .withColumns(
            {
                "delta_seg": _zero_at_start(spec),
                "same_section": ~F.col("is_start"),
                "event_time": event_time(F.col(spec.ts)),
                "session_id": session_id(F.col("ordinal"), F.col(spec.user)),
            }
        )
        .drop("lag", "is_start", "ordinal")
    )

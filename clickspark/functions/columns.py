"""Column expressions shared by the operators. All run in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickspark.schema import NOT_IDENTIFIED, SESSION_PREFIX, SessionSpec

_MOST_MS = 9_223_372_036_854_775  # a timestamp counts microseconds


def seconds(ms: Column) -> Column:
    """Milliseconds as double seconds."""
    return ms.cast("double") / F.lit(1000.0)


def event_time(ms: Column) -> Column:
    """Epoch milliseconds as a timestamp; null where no timestamp can hold them."""
    return F.when(ms.between(-_MOST_MS, _MOST_MS), F.timestamp_millis(ms))


def label(ref: Column) -> Column:
    """A dimension value as it is reported: missing ones get a name of their
    own, and leading blanks go, so that both spellings share one line."""
    return F.ltrim(F.coalesce(ref, F.lit(NOT_IDENTIFIED)))


def session_tag(ordinal: Column) -> Column:
    return F.concat(F.lit(SESSION_PREFIX), ordinal.cast("string"))


def session_id(ordinal: Column, user: Column) -> Column:
    """Null for events without a user, which are therefore not counted."""
    return F.concat(session_tag(ordinal), F.lit("_"), user)


def continues(ts: Column, previous: Column, gap_ms: int) -> Column:
    """Whether an event carries on from the previous one. False if there is none,
    or if the two are further apart than a number can say."""
    return F.coalesce(F.try_subtract(ts, previous) < F.lit(gap_ms), F.lit(False))


def slot_start(ts: Column, width_ms: int) -> Column:
    """Start of the time slot a timestamp lies in. Whole-number arithmetic, so
    it is right for any clock value, also before 1970."""
    return F.try_subtract(ts, F.pmod(ts, F.lit(width_ms).cast("long")))


def dimension_rows(spec: SessionSpec) -> Column:
    """Turns a row into one per dimension: its name ``what`` and its labelled
    value ``ref``. Plans with it compare equal, so Spark runs a part that two
    branches share once; it does not with ``unpivot``."""
    pairs = [column for d in spec.dims for column in (F.lit(d), label(F.col(d)))]
    return F.stack(F.lit(len(spec.dims)), *pairs).alias("what", "ref")

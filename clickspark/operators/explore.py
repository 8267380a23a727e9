"""Looking at events and single sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.schema import SessionSpec


def event_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("events"))


def top_users(df: DataFrame, k: int = 10, spec: SessionSpec = SessionSpec()) -> DataFrame:
    """The ``k`` users with most events: each task sends its best ``k``."""
    counts = df.groupBy(spec.user).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(spec.user)).limit(k)


def in_display_order(df: DataFrame, spec: SessionSpec = SessionSpec()) -> DataFrame:
    """Events by user and time, for showing or writing. A range shuffle, which
    no operator needs: sort last, and only what is to be read in order."""
    return df.orderBy(spec.user, spec.ts, *spec.tiebreak)


def user_timeline(df: DataFrame, user: str, spec: SessionSpec = SessionSpec()) -> DataFrame:
    """Events of one user in order of time. The filter reaches the scan, also
    when ``df`` has been sessionized."""
    return df.where(F.col(spec.user) == F.lit(user)).orderBy(spec.ts, *spec.tiebreak)


def _of_top(df: DataFrame, column: str, scope: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the most frequent value of ``column`` within a scope."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column, *scope).count()
    top = counts.orderBy(F.desc("count"), column, *scope).limit(1).drop("count")
    same = F.lit(True)
    for c in (column, *scope):
        same = same & df[c].eqNullSafe(top[c])
    return df.join(F.broadcast(top), same, "left_semi")  # one row


def busiest_user_timeline(df: DataFrame, spec: SessionSpec = SessionSpec()) -> DataFrame:
    """Events of the known user with most of them, in order of time."""
    return _of_top(df, spec.user).orderBy(spec.ts, *spec.tiebreak)


def one_session(sessionized: DataFrame, session: str, **scope) -> DataFrame:
    """Events of a session by its id. Ids repeat between scopes: name the value of
    each of the scope's columns, ``None`` for null (``one_session(df, id, file="a")``)."""
    found = F.col("session_id") == F.lit(session)
    for column, value in scope.items():
        found = found & F.col(column).eqNullSafe(F.lit(value))
    return sessionized.where(found)


def busiest_session(sessionized: DataFrame, spec: SessionSpec = SessionSpec()) -> DataFrame:
    """Events of the session with most of them."""
    return _of_top(sessionized, "session_id", spec.scope)


def distinct_gaps(sessionized: DataFrame, spec: SessionSpec = SessionSpec()) -> DataFrame:
    return sessionized.select(*spec.scope, "session_id", "delta_seg").distinct()


def gap_list_by_session(
    sessionized: DataFrame, spec: SessionSpec = SessionSpec(), portion_ms: int | None = None
) -> DataFrame:
    """The different gaps of each session as one sorted array, ``deltas``. Its length is
    bounded by the milliseconds of the inactivity limit.

    With ``portion_ms`` a list comes in portions: portion ``k`` has the gaps from
    ``k * portion_ms`` milliseconds to the next, so that no array holds more than
    ``portion_ms`` values, whatever the session or the limit. One after the other, a
    session's portions are its list; empty ones are left out."""
    gaps, group = distinct_gaps(sessionized, spec), [*spec.scope, "session_id"]
    deltas = F.sort_array(F.collect_list("delta_seg")).alias("deltas")
    if portion_ms is None:
        return gaps.groupBy(*group).agg(deltas)
    ms = F.round(F.col("delta_seg") * 1000).cast("long")
    portion = F.floor(ms / F.lit(portion_ms)).cast("long")
    return gaps.groupBy(*group, portion.alias("portion")).agg(deltas).select(*group, "deltas", "portion")

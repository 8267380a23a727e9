"""Session counts. Inputs are session starts, from ``session_starts`` (by
aggregation, the cheaper way) or from ``starts_of`` (out of sessionized events)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickspark.functions.columns import dimension_rows, label
from clickspark.schema import FILE_COLUMN, SessionSpec


def starts_of(sessionized: DataFrame) -> DataFrame:
    """Start rows of sessionized events, one per session."""
    return sessionized.where(~F.col("same_section")).withColumn(
        "starts", F.lit(1).cast("long")
    )


def _counted(spec: SessionSpec) -> Column:
    """Sessions of events without a user have no id and are not counted, but
    the dimension values they show still get a line."""
    known = F.when(F.col(spec.user).isNotNull(), F.col("starts"))
    return F.sum(F.coalesce(known, F.lit(0).cast("long"))).alias("qtd_session")


def sessions_total(starts: DataFrame, spec: SessionSpec = SessionSpec()) -> DataFrame:
    return starts.agg(
        F.coalesce(_counted(spec), F.lit(0).cast("long")).alias("qtd_session")
    )


def sessions_per_file(
    starts: DataFrame, spec: SessionSpec = SessionSpec(), file: str = FILE_COLUMN
) -> DataFrame:
    """Rows ``(file, qtd_session)``, for files with events."""
    return starts.groupBy(file).agg(_counted(spec))


def with_empty_files(counts: DataFrame, files: DataFrame, file: str = FILE_COLUMN) -> DataFrame:
    """``counts`` per file with a line of 0 for each of ``files`` (``input_files``) that
    has none. Lines for other files stay."""
    none = files.select(file, F.lit(0).cast("long").alias("qtd_session"))
    both = counts.select(file, "qtd_session").unionByName(none)
    return both.groupBy(file).agg(F.sum("qtd_session").alias("qtd_session"))


def sessions_by(
    starts: DataFrame, dim: str, spec: SessionSpec = SessionSpec(), labelled: bool = False
) -> DataFrame:
    """Rows ``(dim, qtd_session)``, the missing value as a group of its own."""
    ref = label(F.col(dim)) if labelled else F.col(dim)
    return starts.groupBy(ref.alias(dim)).agg(_counted(spec))


def sessions_by_dim(
    starts: DataFrame, spec: SessionSpec = SessionSpec(), by: tuple[str, ...] = ()
) -> DataFrame:
    """Rows ``(what, ref, qtd_session)`` for all dimensions in one pass.

    ``by`` keeps further columns apart, such as the file: such parts add up to
    the whole with ``fold_counts``.
    """
    rows = starts.select(*by, spec.user, "starts", dimension_rows(spec))
    return rows.groupBy(*by, "what", "ref").agg(_counted(spec))


def half_event_count(sessionized: DataFrame, spec: SessionSpec = SessionSpec()) -> DataFrame:
    """Per session, half the number of its gaps: the position of the middle one."""
    return sessionized.groupBy(*spec.scope, "session_id").agg(
        (F.count("delta_seg") / F.lit(2)).alias("central")
    )

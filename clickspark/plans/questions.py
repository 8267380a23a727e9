"""The application: three questions on a folder of click files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickspark.operators.folds import fold_counts, fold_median_compat
from clickspark.operators.medians import median_gap_by_dim
from clickspark.operators.metrics import sessions_by_dim, with_empty_files
from clickspark.operators.starts import session_starts
from clickspark.schema import FILE_COLUMN, SessionSpec
from clickspark.sources.clicks import input_files, read_clicks
from clickspark.sources.shared import materialize

Answers = tuple[DataFrame, DataFrame, DataFrame]


def answer_questions(
    clicks: DataFrame,
    spec: SessionSpec = SessionSpec(),
    median: str = "all",
    file: str = FILE_COLUMN,
    files: DataFrame | None = None,
) -> Answers:
    """Sessions per file, sessions per dimension value and median gap per
    dimension value.

    Each file is sessionized by itself.
    ``median``: ``"all"`` over the gaps of all files, ``"exact"`` the same
    without approximation, ``"fold"`` the running average over the files' own.
    Sessions per file and dimension value are written once, as they hold both
    counts: every session has one value of each dimension. ``files`` (as
    ``input_files`` gives them) adds a count of 0 for files without events.
    """
    if median not in ("all", "exact", "fold"):
        raise ValueError(f"median must be all, exact or fold, not {median!r}")
    if file not in spec.scope:
        spec = spec.with_(scope=(*spec.scope, file))
    by_file = materialize(
        sessions_by_dim(session_starts(clicks, spec), spec, by=(file,)), "file-counts"
    )
    per_file = (
        by_file.where(F.col("what") == spec.dims[0])
        .groupBy(file)
        .agg(F.sum("qtd_session").alias("qtd_session"))
    )
    if files is not None:
        per_file = with_empty_files(per_file, files, file)
    if median == "fold":
        gaps = fold_median_compat(median_gap_by_dim(clicks, spec, by=(file,)), file)
    else:
        gaps = median_gap_by_dim(clicks, spec, exact=median == "exact")
    return per_file, fold_counts(by_file), gaps


def run(
    spark: SparkSession,
    path: str | list[str],
    spec: SessionSpec = SessionSpec(),
    by_file: bool = True,
    median: str = "all",
    full_path: bool = True,
) -> Answers:
    """Read JSON click files and answer the questions.

    The files are parsed once: the columns the questions need are written as
    Parquet to the shared folder, and every job reads from there. ``by_file``
    sessionizes each file by itself; otherwise sessions go on from one file to
    the next, and the count per file is that of the sessions starting in it
    taken together, under the name ``"*"``. ``full_path`` tells files by their
    path instead of their name. A file without events has 0 sessions.
    """
    clicks = read_clicks(spark, path, by_file=by_file, full_path=full_path)
    if not by_file:
        clicks = clicks.withColumn(FILE_COLUMN, F.lit("*"))
    needed = clicks.select(*dict.fromkeys([FILE_COLUMN, *spec.keys, spec.ts]))
    staged = materialize(needed, "clicks")
    files = input_files(spark, path, full_path) if by_file else None
    return answer_questions(staged, spec, median, files=files)

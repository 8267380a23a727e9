"""Putting results of single files together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.functions.columns import seconds
from clickspark.operators.medians import by_dimension, one_row_per_event
from clickspark.schema import FILE_COLUMN, SessionSpec


def fold_counts(parts: DataFrame) -> DataFrame:
    """Counts add up: ``(what, ref, qtd_session)`` over all parts."""
    return parts.groupBy("what", "ref").agg(F.sum("qtd_session").alias("qtd_session"))


def fold_median_compat(parts: DataFrame, order: str = FILE_COLUMN) -> DataFrame:
    """The running "median of medians": each new file's median is averaged with
    the result so far, which begins at 0.

    It depends on the order of the files and weighs late files more; a value
    seen in one file only comes out at half its median. For the true figure use
    ``median_gap_by_dim`` over all files, or ``merge_sketches``. A group holds
    one number per file.
    """
    entry = F.struct(F.col(order).alias("at"), F.col("median").alias("m"))
    steps = F.array_sort(F.collect_list(entry))
    folded = F.aggregate(steps, F.lit(0.0), lambda so_far, x: (so_far + x["m"]) / 2)
    return parts.groupBy("what", "ref").agg(folded.alias("median"))


def sketch_gaps(
    gaps: DataFrame,
    spec: SessionSpec = SessionSpec(),
    by: tuple[str, ...] = (FILE_COLUMN,),
    k: int = 800,
) -> DataFrame:
    """Quantile sketches of continuation gaps, ``(*by, what, ref, sketch)``.

    ``gaps`` is what ``continuation_gaps`` gives.
    """
    rows = by_dimension(one_row_per_event(gaps), spec, ["gap_ms"], by)
    return rows.groupBy(*by, "what", "ref").agg(
        F.kll_sketch_agg_double(F.col("gap_ms").cast("double"), k).alias("sketch")
    )


def merge_sketches(parts: DataFrame, fraction: float = 0.5, k: int = 800) -> DataFrame:
    """Median over all parts from their sketches, whatever their order:
    ``(what, ref, median)``. New files need only their own sketch."""
    merged = parts.groupBy("what", "ref").agg(
        F.kll_merge_agg_double("sketch", k).alias("sketch")
    )
    value = F.kll_sketch_get_quantile_double("sketch", F.lit(fraction))
    return merged.select("what", "ref", seconds(value).alias("median"))

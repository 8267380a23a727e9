"""Writing events and results as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save_events_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Events as JSON lines, one file per partition."""
    df.write.mode(mode).json(path)


def _nested(rows: DataFrame, outer: str | None, inner: str, value: str) -> DataFrame:
    entry = F.struct(F.col(inner).alias("key"), F.col(value).alias("value"))
    as_map = F.map_from_entries(F.sort_array(F.collect_list(entry)))
    if outer is None:
        return rows.agg(as_map.alias("doc"))
    per_outer = rows.groupBy(F.col(outer).alias("key")).agg(as_map.alias("value"))
    return per_outer.agg(
        F.map_from_entries(
            F.sort_array(
                F.collect_list(F.struct("key", F.map_entries("value").alias("value")))
            )
        ).alias("doc")
    ).select(
        F.transform_values("doc", lambda _, v: F.map_from_entries(v)).alias("doc")
    )


def nested_json(
    rows: DataFrame, value: str, outer: str | None = "what", inner: str = "ref"
) -> DataFrame:
    """Result rows as one JSON document, ``{outer: {inner: value}}``.

    One document is what the report is, so this is for result rows (one per
    dimension value), not for events.
    """
    return _nested(rows, outer, inner, value).select(F.to_json("doc").alias("json"))


def nested_json_by(
    rows: DataFrame, value: str, outer: str = "what", inner: str = "ref"
) -> DataFrame:
    """One JSON object ``{inner: value}`` per ``outer``."""
    entry = F.struct(F.col(inner).alias("key"), F.col(value).alias("value"))
    as_map = F.map_from_entries(F.sort_array(F.collect_list(entry)))
    return rows.groupBy(outer).agg(F.to_json(as_map).alias("json"))


def write_result_json(
    rows: DataFrame,
    path: str,
    value: str,
    outer: str | None = "what",
    inner: str = "ref",
    mode: str = "overwrite",
) -> None:
    """Write the document of ``nested_json`` with Spark's own writer, so that it
    reaches whatever file system ``path`` names."""
    nested_json(rows, value, outer, inner).coalesce(1).write.mode(mode).text(path)


def write_question_files(answers, path: str) -> None:
    """The three answers, each as one document under ``path``. Counts per
    dimension are written as decimals, like every number of that document."""
    q1, q2, q3 = answers
    counts = q2.withColumn("qtd_session", F.col("qtd_session").cast("double"))
    write_result_json(q1, f"{path}/question1.json", "qtd_session", None, "file")
    write_result_json(counts, f"{path}/question2.json", "qtd_session")
    write_result_json(q3, f"{path}/question3.json", "median")

"""Bounded samples of labelled rows, for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1_000_000_000


def remainder(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts))


def bounded_sample(
    rows: DataFrame, label: str, doc_id: str, per_label: int, most_labels: int
) -> DataFrame:
    """At most ``per_label`` rows of each label, of the ``most_labels`` labels
    with the most rows, by a hash of the id; with a column ``order``.

    A first pass counts rows by label; in the second a row's hash decides, so
    that only a few times the sample is ever sorted.
    """
    counts = rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(most_labels)
    counts = {r[label]: r["count"] for r in counts.collect()}
    order = F.xxhash64(F.col(doc_id), F.lit("sample"))
    share = F.lit(0)
    for name, n in counts.items():
        most = min(SCALE, round(SCALE * (4 * per_label + 100) / n))
        share = F.when(F.col(label) == F.lit(name), most).otherwise(share)
    drawn = rows.withColumn("order", order).where(F.pmod("order", F.lit(SCALE)) < share)
    ranked = Window.partitionBy(label).orderBy("order", doc_id)
    return drawn.withColumn("rank", F.row_number().over(ranked)).where(
        F.col("rank") <= per_label
    ).drop("rank")

"""Keeping window groups bounded: the size check and the blocked running total."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickspark.functions.columns import slot_start
from clickspark.schema import SessionSpec
from clickspark.sources.shared import materialize

ROWS_PER_PORTION = 1_000_000


def by_size(
    df: DataFrame, spec: SessionSpec
) -> tuple[DataFrame | None, DataFrame | None]:
    """``df`` in two parts: users for the user layout and users for ticks.

    In the ``auto`` layout, users of more than ``spec.max_group_rows`` events are
    listed first, by one aggregate over the user column. Their number is at most
    the events divided by that limit; if the list is short enough to broadcast,
    it divides the events in passing, and if not, all events go the way that
    works for any user. ``None`` stands for a part that is empty.
    """
    if spec.layout != "auto":
        return (df, None) if spec.layout == "user" else (None, df)
    owner = spec.owner
    sizes = df.groupBy(*owner).agg(F.count(F.lit(1)).alias("__rows"))
    large = sizes.where(F.col("__rows") > spec.max_group_rows).select(*owner)
    listed = large.count()
    if listed == 0:
        return df, None
    if listed > spec.max_listed_users:
        return None, df
    large = materialize(large, "large-users")
    chosen = F.broadcast(large.select(*[F.col(c).alias(f"__l_{c}") for c in owner]))
    same = F.lit(True)
    for c in owner:
        same = same & F.col(c).eqNullSafe(F.col(f"__l_{c}"))
    return df.join(chosen, same, "left_anti"), df.join(chosen, same, "left_semi")


def fingerprint(df: DataFrame, spec: SessionSpec) -> Column:
    """A hash of the columns that neither place nor order an event. Maps cannot
    be hashed as they are, and go in as JSON, their entries in order."""
    inherent = {*spec.keys, spec.ts, *spec.tiebreak}
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rest = [
        _in_order(c) if kinds[c].startswith("map<") else
        F.to_json(F.struct(c)) if "map<" in kinds[c] else F.col(c)
        for c in df.columns
        if c not in inherent
    ]
    return F.xxhash64(*rest) if rest else F.lit(0).cast("long")


def _in_order(column: str) -> Column:
    entries = F.transform(
        F.map_entries(column), lambda e: F.to_json(F.struct(e["key"].alias("k"), e["value"].alias("v")))
    )
    return F.to_json(F.struct(F.array_sort(entries).alias(column)))


def repeated(df: DataFrame, times: str, index: str) -> DataFrame:
    """Each row ``times`` over, numbered from 0 in ``index``. Rows are first cut
    into portions which go to different tasks, so a large number is no burden."""
    portion = F.lit(ROWS_PER_PORTION).cast("long")
    begins = F.sequence(F.lit(0).cast("long"), F.col(times) - 1, portion)
    spread = df.withColumn("__from", F.explode(begins))
    plain = [f.name for f in spread.schema if "map<" not in f.dataType.simpleString()]
    spread = spread.repartition(F.xxhash64(*plain))
    last = F.least(F.col("__from") + portion, F.col(times)) - 1
    numbers = F.sequence(F.col("__from"), last)
    return spread.withColumn(index, F.explode(numbers)).drop("__from", times)


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner"):
    """Join in which null keys match each other; right-hand keys are dropped.

    Where nothing above needs the placement by key, adaptive execution may split
    a skewed partition of the left side.
    """
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") if k in keys else F.col(k) for k in right.columns]
    )
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"__r_{k}"])
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def numbered_in_order(
    df: DataFrame, keys: list[str], order: list[str], weight: str, out: str
) -> DataFrame:
    """``out``: the total ``weight`` of the rows of the same keys that come before in
    ``order``, for keys of any number of rows.

    Rows are sorted over ranges, which cut up a large key. A group holds what one key
    has in one range; what it has in the ranges before is one number for each.
    """
    sort = [*keys, *order]
    ranged = df.repartitionByRange(*sort).withColumn("__range", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*keys, "__range").agg(F.sum(weight).alias("__sum"))
    none = F.lit(0).cast("long")
    offsets = sums.select(
        *keys, "__range", F.coalesce(F.sum("__sum").over(before), none).alias("__before")
    )
    within = Window.partitionBy(*keys, "__range").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = ranged.withColumn("__within", F.coalesce(F.sum(weight).over(within), none))
    joined = join_on_keys(placed, offsets, [*keys, "__range"])
    return joined.withColumn(out, F.col("__before") + F.col("__within")).drop(
        "__before", "__within", "__range"
    )


def blocked_running(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: Column,
    fold: Callable[[Column], Column],
    out: str,
    block_ms: int,
    inclusive: bool,
) -> DataFrame:
    """Running ``fold`` (``F.max`` or ``F.sum``) of ``value`` per key in ``order``.

    The plain window would bring all rows of a key to one task. Here a group is
    one key and one block of time. What went before a block is one number, found
    on a table of one row per key and block, and enters the block's group as
    its first row. ``order`` must be unique per key, which bounds a group by
    ``block_ms`` rows.
    """
    rows = df.withColumns(
        {
            "__block": slot_start(F.col(order), block_ms),
            "__value": value,
            "__is_row": F.lit(1),
        }
    )
    before = Window.partitionBy(*keys).orderBy("__block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        rows.groupBy(*keys, "__block")
        .agg(fold(F.col("__value")).alias("__value"))
        .select(
            *keys,
            "__block",
            fold(F.col("__value")).over(before).alias("__value"),
            F.lit(0).alias("__is_row"),
        )
    )
    within = (
        Window.partitionBy(*keys, "__block")
        .orderBy("__is_row", order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn(out, fold(F.col("__value")).over(within))
        .where(F.col("__is_row") == 1)
        .drop("__block", "__value", "__is_row")
    )

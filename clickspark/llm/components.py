"""Connected groups of a graph too large for one machine."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickspark.sources.shared import materialize

MAX_ROUNDS = 64
#: Nodes of a bucket per side of a tile in which the second round compares them.
TILE = 512
#: Rounds in which every node of a bucket is compared with one node of another group.
PIVOTS = 3


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The group of every node that has a link: columns ``node`` and ``root``.

    ``links`` has one row per link (columns ``a`` and ``b``, long; repeats,
    both directions, loops and nulls are harmless). ``root`` is some node of
    the group, the same for all of its nodes; a node without a link is absent.

    Links are contracted. In each round every node moves to the neighbour that
    comes first in a random order drawn anew for the round, and links between
    the places moved to are the next round's. A group loses a constant share of
    its nodes per round whatever its shape, so rounds grow with the logarithm
    of the largest group. Minima combine before the shuffle, so a node with
    very many links is no burden. Each round is written to the shared folder.
    """
    u, v = F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")
    edges = links.select(u, v).where("u is not null and v is not null and u <> v")
    edges = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    edges = materialize(edges.distinct(), "links")
    ends = F.explode(F.array("u", "v")).alias("node")
    places = edges.select(ends).distinct().select("node", F.col("node").alias("root"))
    for turn in range(MAX_ROUNDS):
        if edges.isEmpty():
            return places

        def rank(name, seed=turn):
            return F.struct(F.xxhash64(name, F.lit(seed)).alias("h"), F.col(name).alias("to"))

        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        moves = both.groupBy("u").agg(F.min(rank("v")).alias("near"))
        moves = materialize(
            moves.select("u", F.least("near", rank("u"))["to"].alias("to")).where("u <> to"),
            "moves",
        )
        edges = materialize(_moved(_moved(edges, moves, "u"), moves, "v")
                            .where("u <> v")
                            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                            .distinct(), "links")
        places = materialize(_moved(places, moves, "root"), "places")
    raise RuntimeError(f"links left after {MAX_ROUNDS} rounds")


def _moved(rows: DataFrame, moves: DataFrame, column: str) -> DataFrame:
    step = moves.select(F.col("u").alias(column), F.col("to"))
    rest = [c for c in rows.columns if c != column]
    return rows.join(step, column, "left").select(
        F.coalesce("to", column).alias(column), *rest
    )


def linked_places(
    postings: DataFrame,
    near: Callable[[Column, Column], Column],
    verified: Callable[[DataFrame], DataFrame] | None = None,
    lookback: int = 0,
) -> DataFrame:
    """The groups (``node``, ``root``) of nodes that share a bucket and link.

    ``postings`` places each node (column ``node``, long) in buckets (column
    ``key``, long); a column ``mark`` says what is compared, if it is not the
    node itself. A pair links if ``near`` holds of its marks and ``verified``
    keeps its row (``a``, ``b``). Nodes without a link may be absent from the
    result.

    First each node is compared with one node of its bucket, the centre. Groups
    that arise are put together; then, for up to ``PIVOTS`` rounds, with a node
    of a bucket outside its largest group, the pivot. Last, nodes that are not
    in the largest group of their bucket are compared with the nodes of the
    bucket in other groups. Pairs within a group are left out, as they join
    nothing new, and no pair that could is. Buckets of one group are settled, as
    groups only grow; a pair that ``verified`` has seen is not shown to it again.

    A pair meets in each bucket that it shares. With ``lookback`` a node brings to
    a bucket the keys of the last so many of its buckets before it, in the order of
    keys, and a pair that shares one of those is not made again: it was made in the
    first bucket that it shares, where there is none before.
    """
    mark = "mark" if "mark" in postings.columns else "node"
    parts = list(dict.fromkeys(["node", mark]))
    bucket = Window.partitionBy("key")
    ranked = F.struct(F.xxhash64("node").alias("h"), *parts)
    members = materialize(
        postings.select("key", *parts)
        .withColumns({"n": F.count(F.lit(1)).over(bucket), "centre": F.min(ranked).over(bucket)})
        .where("n > 1")
        .select("key", F.struct(*parts).alias("x"), "centre", F.ceil(F.col("n") / TILE).cast("int").alias("tiles")),
        "members",
    )

    seen: list[DataFrame] = []

    def links(pairs: DataFrame) -> DataFrame:
        close = pairs.where("x.node <> y.node").where(near(F.col(f"x.{mark}"), F.col(f"y.{mark}")))
        close = close.select(
            F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
        ).distinct()
        if not verified:
            return materialize(close, "pairs")
        if seen:  # those that linked are in one group by now, the others do not link
            close = close.join(reduce(DataFrame.unionByName, seen), ["a", "b"], "left_anti")
        seen.append(materialize(close, "close"))
        return materialize(verified(seen[-1]), "pairs")

    first = links(members.select("x", F.col("centre").alias("y")))
    places = components(first)

    def rooted() -> DataFrame:
        return members.join(places, members["x.node"] == places["node"], "left").select(
            "key", "x", "tiles", F.coalesce("root", "x.node").alias("root")
        )

    def main_roots(rows: DataFrame) -> DataFrame:
        """Of each bucket, the root of its largest group (``main_root``), and whether it
        has another (``mixed``)."""
        sizes = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
        largest = F.max(F.struct("size", F.negative("root").alias("root")))
        return sizes.groupBy("key").agg(
            F.negative(largest["root"]).alias("main_root"), (F.count(F.lit(1)) > 1).alias("mixed")
        )

    # A node of a bucket outside its largest group is the pivot, with which every node
    # of the bucket outside the pivot's group is compared: so near copies that the
    # centre did not join come together in a few rounds, and the last round meets few.
    for turn in range(1, PIVOTS + 1):
        rows = rooted()
        rows = materialize(rows.join(main_roots(rows).where("mixed").drop("mixed"), "key"), "rooted")
        members = rows.select("key", "x", "tiles")
        ranked = F.struct(F.xxhash64("x.node", F.lit(turn)).alias("h"), "x", "root")
        pivots = (
            rows.where("root <> main_root")
            .groupBy("key")
            .agg(F.min(ranked).alias("pivot"))
        )
        faced = rows.join(pivots, "key").where(F.col("root") != F.col("pivot.root"))
        more = links(faced.select("x", F.col("pivot.x").alias("y")))
        if more.isEmpty():
            break
        joined = places.select(F.col("node").alias("a"), F.col("root").alias("b"))
        places = components(joined.unionByName(more))

    # Pairs of the largest group of a bucket are not made; all others across groups are.
    rows = rooted()
    placed = materialize(
        rows.join(main_roots(rows).where("mixed").drop("mixed"), "key").withColumnRenamed("main_root", "centre_root"),
        "placed",
    )
    new = F.lit(True)
    if lookback:
        # Two nodes of different groups share only buckets that are left here.
        mixed = placed.where("root <> centre_root").select("key").distinct()
        in_order = Window.partitionBy("x.node").orderBy("key")
        before = F.array_compact(F.array(*(F.lag("key", k).over(in_order) for k in range(1, lookback + 1))))
        placed = materialize(placed.join(mixed, "key", "left_semi").distinct().withColumn("before", before), "placed")
        new = ~F.arrays_overlap("before", "other_before")
    apart = placed.where("root <> centre_root").drop("centre_root")
    others = placed.drop("centre_root").withColumnsRenamed(
        {"x": "y", "root": "other_root", "before": "other_before"}
    )
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    apart = apart.select("*", F.pmod(F.xxhash64("x.node"), "tiles").alias("row"), every.alias("column"))
    others = others.select("*", every.alias("row"), F.pmod(F.xxhash64("y.node"), "tiles").alias("column"))
    met = apart.join(others, ["key", "tiles", "row", "column"]).where("root <> other_root").where(new)
    more = links(met.select("x", "y"))
    joined = places.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return places if more.isEmpty() else components(joined.unionByName(more))

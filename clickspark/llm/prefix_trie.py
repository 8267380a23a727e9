"""The trie of conversations that begin alike, found from sorted neighbours."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickspark.sources.shared import materialize

#: Bytes that stand for a turn.
WIDTH = 16
_TURNS_A_PART = 1 << 20
_IDS_A_CHUNK = 1 << 14
_NODES_A_BATCH = 1 << 14
_NO_ENDS = hashlib.sha256(b"").hexdigest()

_FOREST = """
    kind string, conv_id long, depth int, parent_conv_id long, n_convs long, n_children long,
    n_leaves long, saved long, ends_sha256 string, key binary, parent_key binary, before long,
    part int, ids string, first binary, last binary, words array<int>
"""


def conversations(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """A row per conversation: ``conv_id`` and its ``turns`` in order (``turn``
    ascending, null first, then by digest), each a ``key`` of 32 hex digits that
    stands for role and text, and the number of ``words`` in the text.

    A null role or text counts as empty; a row without a ``conv_id`` belongs to
    no conversation and is left out. Texts stay where they are: only digests are
    shuffled. The turns of one conversation come to one task, as a value.
    """
    said = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    whole = F.concat(F.length(said(role)).cast("string"), F.lit(":"), said(role), said(text))
    each = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn).cast("long").alias("turn"),
            F.substring(F.sha2(whole, 256), 1, 2 * WIDTH).alias("key"),
            F.regexp_count(said(text), F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
        ).alias("turn"),
    )
    ordered = F.sort_array(F.collect_list("turn"))
    told = F.transform(ordered, lambda t: F.struct(t["key"].alias("key"), t["words"].alias("words")))
    return each.groupBy("conv_id").agg(told.alias("turns"))


def trie(convs: DataFrame) -> DataFrame:
    """A row for each node of the trie of ``convs`` (``conv_id`` and ``turns`` as in
    ``conversations``; ids are different, other columns ignored).

    A node of depth ``d`` is a different sequence of first ``d`` turns; its members
    are the conversations that start with it. Columns: ``conv_id`` (its smallest
    member), ``depth``, ``parent_conv_id`` (of the node one turn shorter; the root:
    null), ``n_convs`` (members), ``n_children``, ``n_leaves`` (nodes without
    children in its subtree, itself included), ``saved_tokens`` (over its subtree,
    the words of each node's last text times its members but one) and
    ``ends_sha256`` (of the decimal ids, ascending, joined by commas, of members
    without further turns). A conversation without turns is a member of the root;
    without conversations there is no node.

    Conversations are sorted by their turns' digests, ties by id, over ranges, so
    that copies spread over tasks. Each task joins neighbours along the edges
    between them, longest common prefix first: a join of components is a branching
    node. Members, leaves and saved words of a node are sums over its members and
    the edges among them, so the forests of tasks meet by sums as well: a task
    settles every node but the prefixes of its first and last conversation. Those
    it hands on, and they are added up with the edges between tasks.

    Members' ids of one node that span tasks are hashed in one task, from chunks of
    them as a stream: a digest is made one byte after the other.
    """
    keys = F.unhex(F.array_join(F.col("turns.key"), ""))
    paths = convs.select("conv_id", keys.alias("path"), F.col("turns.words").alias("words"))
    paths = materialize(paths, "paths")
    turns = paths.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    least = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-turns // _TURNS_A_PART))
    ranges = paths.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    forest = materialize(ranges.mapInArrow(_forest, _FOREST), "forest")
    return _merged(forest)


def _merged(forest: DataFrame) -> DataFrame:
    """Nodes of all tasks, those that several have a part of added up."""
    node = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves"]
    of = lambda kind: forest.where(F.col("kind") == kind)
    sums = ["n_convs", "n_children", "n_leaves", "saved", "before"]
    ends_of_parts = of("part").select("part", "first", "last", "words")
    # One row for each task of the stage before.
    before = F.lag("last").over(Window.orderBy("part"))
    gaps = ends_of_parts.select(before.alias("left"), F.col("first").alias("right"), "words")
    edges = gaps.where(F.col("left").isNotNull()).mapInArrow(
        _edges, "key binary, parent_key binary, depth int, n_children long, n_leaves long, saved long"
    )
    shared = of("open").select("key", "parent_key", "depth", "conv_id", *sums)
    parts_of = shared.unionByName(edges, allowMissingColumns=True)
    total = [F.sum(c).alias(c) for c in sums if c != "before"]
    nodes = parts_of.groupBy("key", "depth", "parent_key").agg(
        F.min("conv_id").alias("conv_id"), F.max("before").alias("before"), *total
    )
    nodes = nodes.withColumn("saved", F.col("saved") - (F.col("n_convs") - 1) * F.col("before"))
    nodes = materialize(nodes, "nodes")
    chunks = of("ids").select("key", F.col("conv_id").alias("at"), "ids")
    chunks = chunks.repartition("key").sortWithinPartitions("key", "at")
    digests = chunks.mapInArrow(_digests, "key binary, ends_sha256 string")
    named = nodes.join(digests, "key", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS))
    )
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    columns = [*node, F.col("saved").alias("saved_tokens"), "ends_sha256"]
    below = of("node").where(F.col("parent_key").isNotNull()).unionByName(
        named.drop("key", "before"), allowMissingColumns=True
    )
    below = below.join(parents, "parent_key", "left").withColumn("parent_conv_id", F.col("above"))
    inner = of("node").where(F.col("parent_key").isNull())
    long = [F.col(c).cast("long").alias(c) if isinstance(c, str) and c != "ends_sha256" else c for c in columns]
    return inner.select(long).unionByName(below.select(long))


# In tasks


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the conversations of one range; see ``_FOREST``."""
    from pyspark import TaskContext

    table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if table is None or table.num_rows == 0:
        return
    ids, paths, words = (table.column(i).combine_chunks() for i in range(3))
    ids = ids.to_numpy()
    sizes = np.diff(_offsets(paths)) // WIDTH
    turns = np.frombuffer(paths.buffers()[2] or b"", np.uint8)
    turns = turns[_offsets(paths)[0] : _offsets(paths)[-1]].view(np.uint64).reshape(-1, 2)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    spoken = words.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    # Words of the first 0, 1, 2 ... turns, one after the other for each conversation.
    sums = np.concatenate([[0], np.cumsum(spoken)])
    places = starts[:-1] + np.arange(len(ids))
    above = np.concatenate([sums[a : b + 1] - sums[a] for a, b in zip(starts[:-1], starts[1:])])
    lcp = _neighbours(turns, starts, sizes)
    v = _joined(ids, sizes, lcp, above, places)

    first, last = (turns[starts[i] : starts[i + 1]].tobytes() for i in (0, len(ids) - 1))
    spines = [_keys(first), _keys(last)]
    is_open, spine = np.zeros(len(v["depth"]), bool), np.zeros(len(v["depth"]), int)
    for k, at in enumerate((0, len(ids) - 1)):
        at = v["same"][at]
        while at >= 0 and not is_open[at]:
            is_open[at], spine[at] = True, k
            at = v["up"][at]

    part = TaskContext.get().partitionId()
    yield _batch(1, {
        "kind": ["part"], "part": [part], "first": [first], "last": [last],
        "words": [spoken[: sizes[0]]],
    })
    alive = np.flatnonzero(v["same"] == np.arange(len(v["same"])))
    for node in alive[is_open[alive]].tolist():
        keys, up = spines[spine[node]], v["up"][node]
        at, deepest = (v["depth"][up] if up >= 0 else -1) + 1, v["depth"][node]
        words_before = above[places[v["rep"][node]] :]
        for lo in range(at, deepest + 1, _NODES_A_BATCH):
            d = np.arange(lo, min(deepest + 1, lo + _NODES_A_BATCH))
            n = len(d)
            yield _batch(n, {
                "kind": ["open"] * n, "conv_id": np.full(n, v["least"][node]), "depth": d,
                "n_convs": np.full(n, v["n"][node]), "n_leaves": np.full(n, v["leaves"][node]),
                "n_children": np.where(d < deepest, 1, v["kids"][node]),
                "saved": np.full(n, v["shared"][node]), "before": words_before[np.maximum(d - 1, 0)],
                "key": [keys[i] for i in d], "parent_key": [keys[i - 1] if i else None for i in d],
            })
        lo, n = v["ends_at"][node], v["ends"][node]
        for k in range(lo, lo + n, _IDS_A_CHUNK):
            some = ids[k : min(lo + n, k + _IDS_A_CHUNK)]
            yield _batch(1, {
                "kind": ["ids"], "key": [keys[deepest]], "conv_id": some[:1],
                "ids": [",".join(map(str, some.tolist()))],
            })
    closed = alive[~is_open[alive]]
    for some in _portions(closed, v):
        yield _closed(some, v, ids, above, places, is_open, spines, spine)


def _offsets(array: pa.Array) -> np.ndarray:
    return np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)


def _neighbours(turns: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Turns that each conversation and the next have in common at their beginning."""
    lcp = np.zeros(max(0, len(sizes) - 1), np.int64)
    left, most = np.arange(len(lcp)), np.minimum(sizes[:-1], sizes[1:])
    d = 0
    while len(left := left[most[left] > d]):
        same = (turns[starts[left] + d] == turns[starts[left + 1] + d]).all(axis=1)
        left = left[same]
        d += 1
        lcp[left] = d
    return lcp


def _joined(ids, sizes, lcp, above, places) -> dict[str, np.ndarray]:
    """Branching nodes and conversations' ends, from edges in descending depth.

    Of each: ``up`` (parent, -1: none), ``depth``, ``n`` members, the ``least`` id,
    ``leaves``, ``kids``, ``shared`` (words above each edge among its members),
    ``rep`` (a member), and the members that end here (``ends`` from ``ends_at``).
    ``same`` is the node that a node became part of, or itself.
    """
    n = len(ids)
    group, top = list(range(n)), list(range(n))
    depth, members, least = sizes.tolist(), [1] * n, ids.tolist()
    leaves = [*(lcp < sizes[:-1]).astype(int).tolist(), 1]
    kids, shared, rep, ends = [0] * n, [0] * n, list(range(n)), [1] * n
    ends_at, up, same = list(range(n)), [-1] * n, list(range(n))
    above_edge = above[places[:-1] + lcp].tolist() if n > 1 else []
    lengths = lcp.tolist()

    def find(i: int) -> int:
        while group[i] != i:
            group[i] = i = group[group[i]]
        return i

    for edge in np.argsort(-lcp, kind="stable").tolist():
        d, i, j = lengths[edge], find(edge), find(edge + 1)
        a, b = top[i], top[j]
        total = (members[a] + members[b], min(least[a], least[b]), leaves[a] + leaves[b])
        words = shared[a] + shared[b] + above_edge[edge]
        if depth[a] == d:
            node = a
            if depth[b] == d:
                same[b] = a
                kids[a] += kids[b]
                ends_at[a] = ends_at[a] if ends[a] else ends_at[b]
                ends[a] += ends[b]
            else:
                up[b] = a
                kids[a] += 1
        elif depth[b] == d:
            node = b
            up[a] = b
            kids[b] += 1
        else:
            node = len(depth)
            up[a] = up[b] = node
            for column, value in (
                (depth, d), (members, 0), (least, 0), (leaves, 0), (kids, 2), (shared, 0),
                (rep, rep[a]), (ends, 0), (ends_at, 0), (up, -1), (same, node),
            ):
                column.append(value)
        members[node], least[node], leaves[node] = total
        shared[node] = words
        group[j] = i
        top[i] = node
    same = np.array(same)
    while (same != same[same]).any():
        same = same[same]
    up = np.array(up)
    up = np.where(up >= 0, same[up], -1)
    lists = {"depth": depth, "n": members, "least": least, "leaves": leaves, "kids": kids, "shared": shared}
    lists |= {"rep": rep, "ends": ends, "ends_at": ends_at}
    return {"up": up, "same": same} | {k: np.array(x, np.int64) for k, x in lists.items()}


def _portions(nodes: np.ndarray, v: dict[str, np.ndarray]) -> Iterator[np.ndarray]:
    """``nodes`` in portions, by how many depths they stand for."""
    rows = np.cumsum(v["depth"][nodes] - v["depth"][v["up"][nodes]])
    at = 0
    while at < len(nodes):
        done = rows[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(rows, done + _NODES_A_BATCH, "right")))
        yield nodes[at:to]
        at = to


def _closed(some, v, ids, above, places, is_open, spines, spine) -> pa.RecordBatch:
    """Nodes that no other task has a part of, each with the ones above it that have
    the same members. Their parents may be open: then the parent's key is given."""
    up = v["up"][some]
    lengths = v["depth"][some] - v["depth"][up]
    node, over = np.repeat(some, lengths), np.repeat(up, lengths)
    n = len(node)
    step = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    d = v["depth"][over] + 1 + step
    deepest, topmost = d == v["depth"][node], step == 0
    before = above[places[v["rep"][node]] + d - 1]
    digests = {
        i: hashlib.sha256(
            ",".join(map(str, ids[v["ends_at"][i] : v["ends_at"][i] + v["ends"][i]].tolist())).encode()
        ).hexdigest()
        for i in some[v["ends"][some] > 0].tolist()
    }
    listed, at_top = node.tolist(), (topmost & is_open[over]).tolist()
    parent = np.where(topmost, v["least"][over], v["least"][node])
    return _batch(n, {
        "kind": ["node"] * n, "conv_id": v["least"][node], "depth": d, "parent_conv_id": parent,
        "n_convs": v["n"][node], "n_children": np.where(deepest, v["kids"][node], 1),
        "n_leaves": v["leaves"][node], "saved": v["shared"][node] - (v["n"][node] - 1) * before,
        "ends_sha256": [digests.get(i, _NO_ENDS) if e else _NO_ENDS for i, e in zip(listed, deepest)],
        "parent_key": [
            spines[spine[o]][v["depth"][o]] if t else None for o, t in zip(over.tolist(), at_top)
        ],
    })


_SCHEMA = pa.schema([
    ("kind", pa.string()), ("conv_id", pa.int64()), ("depth", pa.int32()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends_sha256", pa.string()),
    ("key", pa.binary()), ("parent_key", pa.binary()), ("before", pa.int64()),
    ("part", pa.int32()), ("ids", pa.string()), ("first", pa.binary()), ("last", pa.binary()),
    ("words", pa.list_(pa.int32())),
])


def _batch(n: int, columns: dict) -> pa.RecordBatch:
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _SCHEMA
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


def _keys(path: bytes) -> list[bytes]:
    """What names the prefixes of a path: a digest of the one before and the turn."""
    keys = [b""]
    for at in range(0, len(path), WIDTH):
        keys.append(hashlib.sha256(keys[-1] + path[at : at + WIDTH]).digest()[:WIDTH])
    return keys


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the edge between two tasks adds to the prefixes it has above it."""
    kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        for left, right, words in zip(*(c.to_pylist() for c in batch.columns)):
            n = min(len(left), len(right)) // WIDTH
            a, b = (np.frombuffer(x, np.uint64, 2 * n).reshape(n, 2) for x in (left, right))
            differ = (a != b).any(axis=1)
            n = int(differ.argmax()) if differ.any() else n
            keys = _keys(right[: n * WIDTH])
            columns = (
                keys,
                [None, *keys[:-1]],
                range(n + 1),
                [-1] * n + [0],
                [-(n * WIDTH == len(left))] * (n + 1),
                [sum(words[:n])] * (n + 1),
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                ["key", "parent_key", "depth", "n_children", "n_leaves", "saved"],
            )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the ids of each key, whose chunks come in order."""
    key = digest = None
    done: list[tuple[bytes, str]] = []
    for batch in batches:
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if name == key:
                digest.update(b",")
            else:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = name, hashlib.sha256()
            digest.update(ids.encode())
    if key is not None:
        done.append((key, digest.hexdigest()))
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())],
        ["key", "ends_sha256"],
    )

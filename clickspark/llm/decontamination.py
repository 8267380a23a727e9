"""Benchmark items inside documents.

An item is found in a document that has a share ``least`` of the item's word
shingles or more, wherever in it they are. Items are short and documents long,
so the Jaccard similarity of the two can be a ten-thousandth and no fixed number
of minima of a document would meet the item's. The sketch is therefore taken of
the short side: an item's sketch is the smallest hash values of its shingles
(bottom-k MinHash), and all of a document's hash values are looked up among
sketches. Items are partitioned by size, as the number of minima that makes the
search complete depends on it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.llm.storage import Sent
from clickspark.llm.words import BARE, Words, blocks, hash_spans, split_words

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 22
#: Minima in a sketch beyond those that can be missing.
SPARE = 3
#: Characters of items searched for in one pass.
BLOCK_CHARS = 1 << 26


@dataclass(frozen=True)
class Items:
    """Items of one pass. ``values`` are the different values of all sketches,
    in order; value i is in the sketches of items ``owners[first[i]:first[i + 1]]``.
    Per item: ``ids``, ``sizes`` (different shingles), ``missing`` (how many of
    them a document may lack) and ``minima`` (its sketch's length)."""

    ids: list
    sizes: np.ndarray
    missing: np.ndarray
    minima: np.ndarray
    values: np.ndarray
    first: np.ndarray
    owners: np.ndarray
    shingles: list[frozenset]
    size: int

    def table(self) -> np.ndarray:
        """Which leading bits some value has: most others are put aside by it."""
        seen = np.zeros(1 << _TABLE_BITS, bool)
        seen[self.values >> np.uint64(64 - _TABLE_BITS)] = True
        return seen


def lowered(texts: list[str | None]) -> list[bytes]:
    return [t.lower().encode() if t else b"" for t in texts]


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every run of ``size`` words, and each text's first run."""
    hashes = hash_spans(words.data, words.starts, words.ends)
    counts = np.maximum(np.diff(words.first) - size + 1, 0)
    first = np.concatenate(([0], np.cumsum(counts)))
    at = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], counts)
    found = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            found = (found ^ hashes[at + k]) * _MULTIPLY
            found ^= found >> np.uint64(29)
    return found, first


def word_runs(words: Words, text: int, size: int) -> frozenset:
    """The different runs of ``size`` words of one text, as bytes."""
    lo, hi = int(words.first[text]), int(words.first[text + 1])
    starts, ends = words.starts[lo:hi].tolist(), words.ends[lo:hi].tolist()
    data = words.data[starts[0] : ends[-1]].tobytes() if hi > lo else b""
    base = starts[0] if hi > lo else 0
    return frozenset(
        data[a - base : b - base] for a, b in zip(starts[: hi - lo - size + 1], ends[size - 1 :])
    )


def index(ids: list, texts: list[str | None], size: int, least: float) -> Items:
    """Sketches of items. Those of fewer than ``size`` words have no shingle and
    are found nowhere.

    Partitions hold items of 1, 2 to 3, 4 to 7 ... shingles. A document with a
    share ``least`` of an item's shingles lacks at most ``n - ceil(least * n)``.
    A partition's sketches have ``SPARE + 1`` minima more than its largest item
    may lack (all shingles, if there are fewer), so such a document has at
    least ``minima - missing`` of the sketch, and one with fewer is no candidate.
    """
    words = split_words(lowered(texts), BARE)
    hashes, first = shingle_hashes(words, size)
    shingles = [word_runs(words, i, size) for i in range(len(texts))]
    distinct = [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:])]
    sizes = np.array([len(d) for d in distinct], np.int64)
    missing = sizes - np.ceil(least * sizes - 1e-9).astype(np.int64)
    largest = 2 ** np.ceil(np.log2(sizes + 1)).astype(np.int64) - 1
    lack = largest - np.ceil(least * largest - 1e-9).astype(np.int64)
    minima = np.minimum(sizes, lack + 1 + SPARE)
    sketches = [d[:m] for d, m in zip(distinct, minima)]
    every = np.concatenate([*sketches, np.zeros(0, np.uint64)])
    owners = np.repeat(np.arange(len(texts)), minima)
    order = np.lexsort((owners, every))
    every, owners = every[order], owners[order]
    values, at = np.unique(every, return_index=True)
    return Items(
        ids, sizes, missing, minima, values, np.append(at, len(every)), owners, shingles, size
    )


def find(items: Items, table: np.ndarray, texts: list[bytes]) -> list[list[tuple[int, int]]]:
    """For each text the items it contains, and how many of their shingles."""
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    words = split_words(texts, BARE)
    hashes, first = shingle_hashes(words, items.size)
    at = np.flatnonzero(table[hashes >> np.uint64(64 - _TABLE_BITS)])
    place = np.searchsorted(items.values, hashes[at])
    place[place == len(items.values)] = 0
    hit = items.values[place] == hashes[at] if len(at) else np.zeros(0, bool)
    at, place = at[hit], place[hit]
    if not len(at):
        return out
    text = np.searchsorted(first, at, "right") - 1
    met = np.unique(np.stack((text, place), axis=1), axis=0)
    text, place = met[:, 0], met[:, 1]
    counts = items.first[place + 1] - items.first[place]
    ends = np.cumsum(counts)
    owner = items.owners[np.arange(ends[-1]) + np.repeat(items.first[place] - ends + counts, counts)]
    pairs, tally = np.unique(
        np.stack((np.repeat(text, counts), owner), axis=1), axis=0, return_counts=True
    )
    enough = tally >= items.minima[pairs[:, 1]] - items.missing[pairs[:, 1]]
    runs: tuple[int, frozenset] = (-1, frozenset())
    for i, item in pairs[enough].tolist():
        if runs[0] != i:
            runs = (i, word_runs(words, i, items.size))
        wanted = items.shingles[item]
        shared = len(wanted & runs[1])
        if shared >= len(wanted) - items.missing[item]:
            out[i].append((item, shared))
    return out


def item_blocks(
    items: DataFrame, item_id: str, text: str, size: int, least: float, chars: int = BLOCK_CHARS
) -> Iterator[Items]:
    """Items in blocks of about ``chars`` characters, so that what is broadcast
    is bounded however large the benchmark is; documents are read once per block.
    Rows come to the driver one by one."""
    ids, texts, held = [], [], 0
    for row in items.select(item_id, F.col(text).cast("string")).toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        held += len(row[1] or "")
        if held >= chars:
            yield index(ids, texts, size, least)
            ids, texts, held = [], [], 0
    if ids:
        yield index(ids, texts, size, least)


def contained(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = 5,
    least: float = 0.8,
    chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Documents' ids with the items in them: ``doc_id``, ``item_id``,
    ``shingles`` (the item's different shingles of ``size`` words), ``shared``
    (those in the document) and ``containment``.

    Words are lower-cased and stand between white space and ASCII punctuation.
    Every match is verified on words, not hashes. Null and empty texts contain
    nothing and are contained nowhere; nor are items of fewer than ``size``
    words. Repeated rows of either table give repeated rows. Null ids are
    carried like others. Other columns are ignored.
    """
    kind = items.schema[item_id].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("item_id", kind),
            T.StructField("shingles", T.LongType()),
            T.StructField("shared", T.LongType()),
            T.StructField("containment", T.DoubleType()),
        ]
    )
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = docs.sparkSession.createDataFrame([], schema)
    for block in item_blocks(items, item_id, item_text, size, least, chars):
        sent = Sent(docs.sparkSession, block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known = sent.value
            table = known.table()
            for batch in batches:
                for at, to, _ in blocks(batch.column(1)):
                    texts = lowered(batch.column(1).slice(at, to - at).to_pylist())
                    hits = [
                        (i, item, shared)
                        for i, matches in enumerate(find(known, table, texts))
                        for item, shared in matches
                    ]
                    ids = batch.column(0).slice(at, to - at).take(pa.array([h[0] for h in hits], pa.int64()))
                    sizes = [int(known.sizes[h[1]]) for h in hits]
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids,
                            pa.array([known.ids[h[1]] for h in hits], item_type),
                            pa.array(sizes, pa.int64()),
                            pa.array([h[2] for h in hits], pa.int64()),
                            pa.array([h[2] / n for h, n in zip(hits, sizes)], pa.float64()),
                        ],
                        schema.names,
                    )

        item_type = _arrow(kind)
        found = found.unionByName(rows.mapInArrow(run, schema))
    return found


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def clean(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = 5,
    least: float = 0.8,
    chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` without the rows whose text contains an item; what counts as
    contained is said in ``contained``. Rows pass through the search, so nothing
    is shuffled."""
    names = docs.columns
    at_text = names.index(text)
    kept = docs
    for block in item_blocks(items, item_id, item_text, size, least, chars):
        sent = Sent(docs.sparkSession, block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            table = sent.value.table()
            for batch in batches:
                for at, to, _ in blocks(batch.column(at_text)):
                    part = batch.slice(at, to - at)
                    hits = find(sent.value, table, lowered(part.column(at_text).to_pylist()))
                    yield part.filter(pa.array([not h for h in hits], pa.bool_()))

        kept = kept.mapInArrow(run, docs.schema)
    return kept

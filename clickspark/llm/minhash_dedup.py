"""Near-duplicate documents by the Jaccard similarity of their word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickspark.llm.components import linked_places
from clickspark.llm.keepers import keep_first, row_hashes, turn
from clickspark.llm.words import LOWER, blocks, hash_spans, split_words
from clickspark.sources.shared import materialize

BANDS, ROWS = 14, 4
#: Of the marks' 56 bits, a tenth differs at a similarity of 0.8.
MARK_BITS = 16
_draw = np.random.default_rng(5)
_FLIP = _draw.integers(0, 1 << 64, BANDS * ROWS, np.uint64)
_TIMES = _draw.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)
_MIX = np.uint64(11400714785074694791)


def sketches(texts: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each UTF-8 text: a hash of its words (0 if it has none), a mark of one
    bit per minimum, and a key per band of minima. A-Z are lower-cased."""
    words = split_words(texts, LOWER)
    starts, ends, first = words.shingles(size)
    hashes = hash_spans(words.data, starts, ends)
    some = np.flatnonzero(np.diff(first))
    nodes, marks = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)
    keys = np.zeros((len(texts), BANDS), np.uint64)
    if not len(some):
        return nodes, marks, keys
    for i in some.tolist():
        a, b = words.starts[words.first[i]], words.ends[words.first[i + 1] - 1]
        nodes[i] = xxhash.xxh64_intdigest(words.data[a:b].tobytes(), 42)
    with np.errstate(over="ignore"):
        for k in range(BANDS * ROWS):
            least = np.minimum.reduceat((hashes ^ _FLIP[k]) * _TIMES[k], first[some])
            marks[some] |= (least >> np.uint64(32) & np.uint64(1)) << np.uint64(k)
            keys[some, k // ROWS] = (keys[some, k // ROWS] ^ least) * _MIX + np.uint64(k)
    return nodes, marks, keys


def similarities(a: list[bytes], b: list[bytes], size: int = 5) -> np.ndarray:
    """The Jaccard similarity of the sets of shingles of ``a[i]`` and ``b[i]``."""
    words = split_words([*a, *b], LOWER)
    starts, ends, first = words.shingles(size)
    hashes = hash_spans(words.data, starts, ends)
    sets = [np.unique(hashes[p:q]) for p, q in zip(first[:-1].tolist(), first[1:].tolist())]
    found = np.ones(len(a))
    for i in range(len(a)):
        x, y = sets[i], sets[i + len(a)]
        both = len(np.intersect1d(x, y, assume_unique=True))
        if len(x) + len(y):
            found[i] = both / (len(x) + len(y) - both)
    return found


def keep_one(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    similarity: float = 0.8,
) -> DataFrame:
    """``docs`` with one row of each group of near duplicates (see
    ``keepers.keep_first``).

    Two texts link if the sets of their runs of ``size`` words have a Jaccard
    similarity of ``similarity`` at least; a text of fewer words is one run, and
    texts without words are alike. Groups are joined by chains of links.
    Candidates share one of 14 bands of four MinHash values: a pair of
    similarity s is met with probability 1 - (1 - s^4)^14, 0.999 at 0.8. Every
    candidate is verified on its whole texts, so that no other is linked.
    """

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, texts in blocks(batch.column(1)):
                nodes, marks, keys = sketches(texts, size)
                ends = pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(keys.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, to - at),
                        pa.array(nodes.view(np.int64)),
                        pa.array(marks.view(np.int64)),
                        lists,
                    ],
                    ["at", "node", "mark", "keys"],
                )

    rows = docs.select(turn(doc_id, text).alias("at"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["at"].dataType.simpleString()
    found = rows.mapInArrow(sketched, f"at {kind}, node long, mark long, keys array<long>")
    found = materialize(found, "sketches")
    distinct = materialize(
        found.groupBy("node").agg(
            F.min("at").alias("at"), F.min("mark").alias("mark"), F.min("keys").alias("keys")
        ),
        "distinct",
    )
    postings = distinct.where("node <> 0").select("node", "mark", F.posexplode("keys"))
    postings = postings.select("node", "mark", F.xxhash64("pos", "col").alias("key"))

    def near(a: Column, b: Column) -> Column:
        return F.bit_count(a.bitwiseXOR(b)) <= MARK_BITS

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, texts in blocks(batch.column(2)):
                part = batch.slice(at, to - at)
                others = part.column(3).cast(pa.large_binary()).to_pylist()
                good = similarities(texts, others, size) >= similarity
                yield part.select([0, 1]).filter(pa.array(good))

    def verified(pairs: DataFrame) -> DataFrame:
        if pairs.isEmpty():
            return pairs
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = distinct.join(nodes, "node").select("node", "at.h1", "at.h2")
        h1, h2 = row_hashes(doc_id, text)
        sources = docs.select(h1.alias("h1"), h2.alias("h2"), F.col(text).cast("string").alias("text"))
        texts = materialize(sources.join(wanted, ["h1", "h2"]).select("node", "text"), "texts")
        texts = texts.dropDuplicates(["node"])
        both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
        both = both.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
        both = both.select("a", "b", "a_text", "b_text")
        return both.mapInArrow(compared, "a long, b long")

    places = linked_places(postings, near, verified)
    return keep_first(docs, found.select("at", "node"), places, doc_id, text)

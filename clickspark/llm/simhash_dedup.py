"""Near-duplicate documents by SimHash fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickspark.llm.components import linked_places
from clickspark.llm.keepers import keep_first, turn
from clickspark.llm.words import LOWER, blocks, hash_spans, split_words
from clickspark.sources.shared import materialize

BYTES = 8
_ROWS = 1 << 15


def fingerprints(texts: list[bytes], size: int = 4) -> np.ndarray:
    """The 64-bit SimHash of each UTF-8 text, as ``uint64``.

    A-Z are lower-cased; features are the XXH64 hashes (seed 42) of runs of
    ``size`` words, repeats included. A bit is set if more than half of the
    hashes have it. A text without words has fingerprint 0.
    """
    words = split_words(texts, LOWER)
    starts, ends, first = words.shingles(size)
    hashes = hash_spans(words.data, starts, ends)
    found = np.zeros(len(texts), np.uint64)
    for i, (at, to) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if to > at:
            counts = sum(_ones(hashes[k : min(to, k + _ROWS)]) for k in range(at, to, _ROWS))
            found[i] = np.packbits(2 * counts > to - at).view(">u8")[0]
    return found


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, highest bit first."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64)
    return (np.ones(len(bits), np.float32) @ bits.astype(np.float32)).astype(np.int64)


def with_fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 4
) -> DataFrame:
    """``doc_id`` and its fingerprint ``fp`` (the 64 bits as a signed long)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string"))
    return _printed(rows, size)


def _printed(rows: DataFrame, size: int) -> DataFrame:
    """The first column of ``rows``, and ``fp`` of the text in the second."""
    name, kind = rows.columns[0], rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, texts in blocks(batch.column(1)):
                found = pa.array(fingerprints(texts, size).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), found], [name, "fp"]
                )

    return rows.mapInArrow(run, f"{name} {kind}, fp long")


def close_fingerprints(prints: DataFrame, bits: int = 4) -> DataFrame:
    """Which fingerprints are joined by chains of links: ``node`` and ``root``.

    ``prints`` has a column ``node`` of different fingerprints; two link if at
    most ``bits`` (under 8) of their bits differ. The index is over bytes and
    their positions: as each differing bit spoils one byte, linked fingerprints
    share at least ``8 - bits`` positional bytes. The lists of single bytes are
    a 256th of the corpus long, so the index keeps lists for ``8 - bits``
    positional bytes at a time. A pair met in one of them is tallied, kept if
    it shares enough bytes, and verified on its bits. Pairs that other links
    join anyway are not made (see ``linked_places``), so that a large group of
    near copies costs rows in proportion to its size.
    """
    if not 0 <= bits < BYTES:
        raise ValueError(f"bits must be 0 to 7: {bits}")
    least = BYTES - bits
    kinds = list(combinations(range(BYTES), least))
    keys = [
        F.col("node").bitwiseAND(F.lit(_signed(sum(0xFF << 8 * k for k in kind))))
        for kind in kinds
    ]
    key = F.explode(F.array(*(F.xxhash64(F.lit(k), key) for k, key in enumerate(keys))))
    postings = prints.select("node", key.alias("key"))

    def near(a: Column, b: Column) -> Column:
        differing = a.bitwiseXOR(b)
        shared = sum(
            F.when(differing.bitwiseAND(F.lit(_signed(0xFF << 8 * k))) == 0, 1).otherwise(0)
            for k in range(BYTES)
        )
        return (shared >= least) & (F.bit_count(differing) <= bits)

    return linked_places(postings, near)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 4, bits: int = 4
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` and ``component_id``, the
    smallest id of the documents it is linked to by chains, itself included.

    Null and empty texts, and those of white space only, have fingerprint 0 and
    are linked like others. Rows that repeat an id each keep their row. A null
    id keeps its row too, and gives its group no name: a group of only such
    rows has a null ``component_id``. Other columns are ignored.
    """
    prints = materialize(with_fingerprints(docs, doc_id, text, size), "prints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    places = close_fingerprints(distinct.select(F.col("fp").alias("node")), bits)
    placed = distinct.join(places.withColumnRenamed("node", "fp"), "fp", "left")
    placed = placed.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(placed.join(names, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id"
    )


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 4, bits: int = 4
) -> DataFrame:
    """``docs`` with one row of each group of linked texts.

    Groups are of texts: rows without an id, and rows that repeat one, belong
    to the groups of their own texts. Of a group the row of the smallest id
    stays (nulls last); of several, the one whose text begins lowest (its first
    characters, then a hash). Rows alike in id and text are one.
    """
    rows = docs.select(turn(doc_id, text).alias("at"), F.col(text).cast("string"))
    turns = materialize(_printed(rows, size), "prints").withColumnRenamed("fp", "node")
    distinct = materialize(turns.select("node").distinct(), "distinct")
    return keep_first(docs, turns, close_fingerprints(distinct, bits), doc_id, text)


def hex_digits(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value

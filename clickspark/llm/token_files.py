"""Token ids of documents in files of fixed-width numbers.

A file holds ids in blocks of 65,536, each id in as few bits as the vocabulary
needs (little-endian, the first id in the lowest bits), then an index: ids of
documents, where each starts, and where each block starts. Its last 16 bytes
are the index's position and the magic text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickspark.llm.storage import created, kept, opened
from clickspark.llm.word_cache import WordCache
from clickspark.llm.words import blocks
from clickspark.sources.shared import materialize

MAGIC = b"IDBITS01"
BLOCK = 1 << 16
SUFFIX = ".ids"
_SEPARATOR = "\x01"

_KIND = np.zeros(256, np.uint8)
_KIND[97:123] = 1
_KIND[48:58] = 2
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'|"]] = 3
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    spread = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of packed ones."""
    if bits == 16:
        return np.frombuffer(data, "<u2", n).astype(np.uint32)
    spread = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little")
    places = np.left_shift(np.uint32(1), np.arange(bits, dtype=np.uint32))
    return (spread.reshape(n, bits) * places).sum(axis=1, dtype=np.uint32)


class Writer:
    """Writes documents' ids to an open file; ``close`` adds the index."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.doc_ids: list[int | None] = []
        self.starts, self.offsets = [0], [0]
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_ids: list[int | None], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.starts += (self.starts[-1] + np.cumsum(sizes)).tolist()
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK:
            self._flush(self.held - self.held % BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for at in range(0, n, BLOCK):
            data = pack(ids[at : min(n, at + BLOCK)], self.bits)
            self.out.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
        self.waiting, self.held = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._flush(self.held)
        known = np.array([x is not None for x in self.doc_ids], bool)
        names = np.array([x or 0 for x in self.doc_ids], "<i8")
        head = {"bits": self.bits, "docs": len(names), "blocks": len(self.offsets) - 1}
        head = json.dumps(head).encode()
        self.out.write(len(head).to_bytes(4, "little") + head)
        for part in (names, known, np.array(self.starts, "<i8"), np.array(self.offsets, "<i8")):
            self.out.write(part.tobytes())
        self.out.write(self.offsets[-1].to_bytes(8, "little") + MAGIC)


class Reader:
    """Random access to a file of ids: ``doc_ids`` (with ``known``), ``starts``
    and ``ids(start, stop)``, which reads only the blocks it needs."""

    def __init__(self, source):
        self.source = source
        end = source.seek(0, 2)
        source.seek(end - 16)
        tail = source.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a file of token ids")
        at = int.from_bytes(tail[:8], "little")
        source.seek(at)
        index = source.read(end - 16 - at)
        size = int.from_bytes(index[:4], "little")
        head = json.loads(index[4 : 4 + size])
        self.bits, docs, n = head["bits"], head["docs"], head["blocks"]
        at = 4 + size
        self.doc_ids = np.frombuffer(index, "<i8", docs, at)
        self.known = np.frombuffer(index, np.bool_, docs, at + 8 * docs)
        self.starts = np.frombuffer(index, "<i8", docs + 1, at + 9 * docs)
        self.offsets = np.frombuffer(index, "<i8", n + 1, at + 9 * docs + 8 * (docs + 1))

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (stop - 1) // BLOCK
        self.source.seek(int(self.offsets[first]))
        data = self.source.read(int(self.offsets[last + 1] - self.offsets[first]))
        base = int(self.offsets[first])
        total = int(self.starts[-1])
        parts = [
            unpack(
                data[int(self.offsets[k]) - base : int(self.offsets[k + 1]) - base],
                min(BLOCK, total - k * BLOCK),
                self.bits,
            )
            for k in range(first, last + 1)
        ]
        return np.concatenate(parts)[start - first * BLOCK : stop - first * BLOCK]


class Encoder:
    """Encodes texts word by word, each different word once.

    The tokenizer drops white space and never joins a letter, a digit and a
    punctuation mark, so ids of a text are those of its pieces at white space
    and between such ASCII characters ("'" and "|" apart, as contractions and
    special tokens are found across them). New words are encoded many in a
    string, a control character between them. Words are lower-cased, so that
    fewer differ, but not those with a "|": special tokens are matched on the
    text as it is written.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        (self.mark,) = self._encode([_SEPARATOR])[0]
        self.cache = WordCache(self._learn)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [x.ids for x in found]

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        mark, between = _SEPARATOR.encode(), f" {_SEPARATOR} "
        ids, sizes = [], []
        for k in range(0, len(words), 500):
            part = words[k : k + 500]
            if any(mark in w for w in part):
                found = [np.array(x, np.uint32) for x in self._encode([w.decode() for w in part])]
                ids += found
                sizes.append(np.array([len(x) for x in found]))
                continue
            found = np.array(self._encode([between.join(w.decode() for w in part)])[0], np.uint32)
            marks = np.flatnonzero(found == self.mark)
            starts = np.concatenate(([0], marks + 1))
            ids.append(np.delete(found, marks))
            sizes.append(np.append(marks, len(found)) - starts)
        return np.concatenate(ids), np.concatenate(sizes)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each text has."""
        raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        raw = np.where(_barred(raw), raw, _LOWER[raw])
        kind = _KIND[raw]
        cut = (kind[:-1] != kind[1:]) & (kind[:-1] > 0) & (kind[1:] > 0)
        cuts = np.flatnonzero(cut) + 1
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        offsets += np.searchsorted(cuts, offsets)
        spaced = np.insert(raw, cuts, 32).tobytes()
        return self.cache.encode(
            [spaced[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        )


def _barred(raw: np.ndarray) -> np.ndarray:
    """Which bytes belong to a run without white space that has a "|"."""
    bars = np.flatnonzero(raw == ord("|"))
    if not len(bars):
        return np.zeros(len(raw), bool)
    run = np.cumsum(_SPACE[raw], dtype=np.int64)
    has = np.zeros(int(run[-1]) + 1, bool)
    has[run[bars]] = True
    return has[run]


def with_end(ids: np.ndarray, sizes: np.ndarray, end: int | None) -> tuple[np.ndarray, np.ndarray]:
    if end is None:
        return ids, sizes
    return np.insert(ids, np.cumsum(sizes), end), sizes + 1


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_json: str,
    vocabulary: int,
    end: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Writes ids of whole texts, ``end`` after each, to files under ``path``.

    ``tokenizer_json`` is the text of a tokenizer's file, which must drop white
    space and split letters, digits and punctuation (see ``Encoder``). Documents
    are in ascending order of id over all files (nulls first, ties by text).
    Null texts are empty. Returns one row per file: ``file``, ``part`` (its
    order) and ``n_ids``. A task that runs again replaces its file.
    """
    bits = max(1, int(vocabulary - 1).bit_length())
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        first = next(batches, None)
        if first is None:
            return
        encoder = kept(("encoder", hash(sent.value)), lambda: Encoder(sent.value))
        name = f"{path}/part-{part:06d}{SUFFIX}"
        total = 0
        with created(name) as out:
            writer = Writer(out, bits)
            for batch in _chain(first, batches):
                for at, to, texts in blocks(batch.column(1)):
                    ids, sizes = with_end(*encoder.encode(texts), end)
                    writer.add(batch.column(0).slice(at, to - at).to_pylist(), ids, sizes)
                    total += len(ids)
            writer.close()
        yield pa.RecordBatch.from_pydict({"file": [name], "part": [part], "n_ids": [total]})

    return materialize(ranged.mapInArrow(run, "file string, part long, n_ids long"), "token-files")


def _chain(first, rest):
    yield first
    yield from rest


def read_tokens(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Documents of the files that ``write_tokens`` returned: ``doc_id``,
    ``start`` (how many ids all documents before it have) and ``ids``, unsigned
    32-bit little-endian numbers as binary.

    A file's own start is a running sum over files, of which there are few; each
    is read by the task that has its row, a few blocks at a time.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select(
        "file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")
    )
    spread = placed.repartition(max(1, files.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(*(c.to_pylist() for c in batch.columns)):
                with opened(name) as source:
                    yield from _documents(Reader(source), base)

    return spread.mapInArrow(run, "doc_id long, start long, ids binary")


def _documents(reader: Reader, base: int) -> Iterator[pa.RecordBatch]:
    starts = reader.starts
    at = 0
    while at < len(reader.doc_ids):
        to = int(np.searchsorted(starts, starts[at] + 16 * BLOCK, "right")) - 1
        to = min(max(to, at + 1), len(reader.doc_ids))
        ids = reader.ids(int(starts[at]), int(starts[to])).astype("<u4")
        cuts = ((starts[at : to + 1] - starts[at]) * 4).astype(np.int64)
        values = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), to - at, [None, pa.py_buffer(cuts), pa.py_buffer(ids)]
        )
        names = pa.array(reader.doc_ids[at:to], mask=~reader.known[at:to])
        yield pa.RecordBatch.from_arrays(
            [names, pa.array(starts[at:to] + base), values.cast(pa.binary())],
            ["doc_id", "start", "ids"],
        )
        at = to

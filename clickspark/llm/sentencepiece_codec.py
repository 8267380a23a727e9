"""SentencePiece encoding by Viterbi search, and decoding."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.llm.storage import Sent, kept
from clickspark.llm.word_cache import WordCache
from clickspark.llm.words import blocks

MARK = "▁"
_MARK = MARK.encode()
#: Words up to this many bytes go through the trie together, if there are enough.
_LONG = 4096
_CLASSES = (0, 8, 12, 16, 24, 40, 96, 192, 384, 768, 1536, _LONG)
_ENOUGH = 24
_ROWS = 256
_UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Pieces:
    """A vocabulary as a double-array trie over UTF-8 bytes.

    From state s, byte b leads to state ``base[s] + b`` if ``check`` of that is
    s. ``piece[s]`` is the id of the piece that ends in s (-1: none) and
    ``score[s]`` its log score. ``surface[id]`` is what a piece decodes to.
    ``byte_id`` has the ids of byte pieces (None without byte fallback).
    """

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    score: np.ndarray
    surface: list[bytes]
    byte_id: np.ndarray | None
    unknown_id: int
    unknown_score: float
    prefix: bool
    by_words: bool
    newline: bool
    key: str


def _double_array(words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base, check and value arrays of a trie. A state's successors take the first
    free places from a little before those of the state placed last, so that the
    search is short; the arrays are a few times as long as there are states."""
    children: list[dict[int, int]] = [{}]
    value = [-1]
    for word, number in words.items():
        node = 0
        for byte in word:
            nxt = children[node].get(byte)
            if nxt is None:
                nxt = children[node][byte] = len(children)
                children.append({})
                value.append(-1)
            node = nxt
        value[node] = number
    taken = bytearray(1 << 12)
    taken[0] = 1
    places, bases, last = [(0, 0, 0)], {}, 1
    for node, place, _ in places:
        codes = list(children[node])
        if not codes:
            continue
        at = max(1, last - 128)
        taken.extend(bytes(max(0, at + 2048 - len(taken))))
        while any(taken[at + c] for c in codes):
            at += 1
            if at + 512 > len(taken):
                taken.extend(bytes(4096))
        bases[place] = last = at
        for c in codes:
            taken[at + c] = 1
            places.append((children[node][c], at + c, place))
    size = max(p for _, p, _ in places) + 513
    base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    found = np.full(size, -1, np.int32)
    for node, place, parent in places:
        found[place] = value[node]
        if place:
            check[place] = parent
    base[list(bases)] = list(bases.values())
    return base, check, found


def _exact(score: float) -> float:
    """Scores are multiples of 2**-20, so that sums, and ties, are exact."""
    return round(score * (1 << 20)) / (1 << 20)


def load(model_path: str) -> Pieces:
    """The pieces of a SentencePiece model file, read where this is called.

    A unigram model's scores are log probabilities and are used as they are. A
    BPE model has ranks in their place; they become log scores by Zipf's law
    (the k-th piece has a share in proportion to 1 / k). An unknown character
    scores ten less than the worst piece. Only models that do not normalise
    their text are supported.
    """
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(model_path, "rb") as source:
        data = source.read()
    model.ParseFromString(data)
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces:
        raise ValueError("the model normalises its text; that is not supported")
    kind = model.SentencePiece
    normal = [
        (i, p.piece, p.score)
        for i, p in enumerate(model.pieces)
        if p.type in (kind.NORMAL, kind.USER_DEFINED)
    ]
    if model.trainer_spec.model_type != model.trainer_spec.UNIGRAM:
        ranked = sorted(normal, key=lambda x: (-x[2], x[0]))
        total = math.log(sum(1 / k for k in range(1, len(ranked) + 1)))
        normal = [(i, p, -math.log(k) - total) for k, (i, p, _) in enumerate(ranked, 1)]
    surface = [p.piece.replace(MARK, " ").encode() for p in model.pieces]
    byte_id = np.full(256, -1, np.int64)
    unknown = 0
    for i, p in enumerate(model.pieces):
        if p.type == kind.BYTE:
            byte_id[int(p.piece[3:5], 16)] = i
            surface[i] = bytes([int(p.piece[3:5], 16)])
        elif p.type == kind.UNKNOWN:
            unknown = i
            surface[i] = "⁇".encode()
        elif p.type == kind.CONTROL:
            surface[i] = b""
    base, check, piece = _double_array({p.encode(): i for i, p, _ in normal})
    scores = np.zeros(len(model.pieces), np.float64)
    for i, _, s in normal:
        scores[i] = _exact(s)
    inner = any(MARK in p.lstrip(MARK) for _, p, _ in normal)
    return Pieces(
        base, check, piece, np.where(piece >= 0, scores[np.maximum(piece, 0)], 0.0), surface,
        byte_id if (byte_id >= 0).all() else None, unknown,
        _exact(min(s for _, _, s in normal) - _UNKNOWN_PENALTY), spec.add_dummy_prefix, not inner,
        any("\n" in p for _, p, _ in normal), hashlib.sha256(data).hexdigest(),
    )


def viterbi(pieces: Pieces, word: bytes) -> list[int]:
    """The best ids of one text, by the same rules as ``viterbi_many``."""
    base, check = pieces.base, pieces.check
    n = len(word)
    best, back = [-math.inf] * (n + 1), [(0, -1)] * (n + 1)
    best[0] = 0.0
    i = 0
    while i < n:
        width = _width(word[i])
        state, j, single = 0, i, False
        while j < n:
            to = int(base[state]) + word[j]
            if check[to] != state or to == 0:
                break
            state, j = to, j + 1
            if pieces.piece[state] >= 0:
                single |= j == i + width
                score = best[i] + float(pieces.score[state])
                if score > best[j]:
                    best[j], back[j] = score, (i, int(pieces.piece[state]))
        if not single and best[i] + pieces.unknown_score > best[i + width]:
            best[i + width], back[i + width] = best[i] + pieces.unknown_score, (i, -1)
        i += width
    out, at = [], n
    while at > 0:
        start, number = back[at]
        out.append((start, at, number))
        at = start
    ids: list[int] = []
    for start, end, number in reversed(out):
        ids += [number] if number >= 0 else _unknown(pieces, word[start:end])
    return ids


def _width(byte: int) -> int:
    return 1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4


def _unknown(pieces: Pieces, char: bytes) -> list[int]:
    if pieces.byte_id is None:
        return [pieces.unknown_id]
    return [int(pieces.byte_id[b]) for b in char]


def viterbi_many(pieces: Pieces, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The best segmentation of each word: all ids, and how many each has.

    The sum of log scores is largest; of equal ones the one whose last piece is
    longest is taken, and so on towards the front. A character that is not a
    piece itself may stand as unknown and becomes its bytes' pieces. All words
    go through the trie together, a byte at a time, in classes of like length and
    portions of a million bytes; very long ones, and long ones that are few, by
    themselves.
    """
    found: list = [None] * len(words)
    sizes = np.array([len(w) for w in words])
    alone = [np.flatnonzero(sizes > _LONG)]
    for lo, hi in zip(_CLASSES, _CLASSES[1:]):
        some = np.flatnonzero((sizes > lo) & (sizes <= hi))
        if hi > 96 and len(some) < _ENOUGH:
            alone.append(some)
            continue
        each = min(1 << 14, (1 << 20) // hi)
        for at in range(0, len(some), each):
            part = some[at : at + each]
            for i, ids in zip(part, _together(pieces, [words[i] for i in part])):
                found[i] = ids
    for i in np.concatenate(alone):
        found[i] = viterbi(pieces, words[i])
    found = [x or [] for x in found]
    counts = np.array([len(x) for x in found], np.int64)
    return np.fromiter((i for x in found for i in x), np.uint32, int(counts.sum())), counts


def _together(pieces: Pieces, words: list[bytes]) -> list[list[int]]:
    n, sizes = len(words), np.array([len(w) for w in words])
    most = int(sizes.max())
    data = np.frombuffer(b"".join(w.ljust(most, b"\0") for w in words), np.uint8)
    data = data.reshape(n, most).T.astype(np.int32)
    best = np.full((most + 1, n), -np.inf)
    back = np.zeros((most + 1, n), np.int32)
    number = np.full((most + 1, n), -1, np.int32)
    best[0] = 0
    widths = np.array([_width(b) for b in range(256)])
    for i in range(most):
        on = np.flatnonzero((sizes > i) & (best[i] > -np.inf) & (data[i] & 0xC0 != 0x80))
        if not len(on):
            continue
        width = widths[data[i, on]]
        single = np.zeros(len(on), bool)
        rows, state, which = on, np.zeros(len(on), np.int32), np.arange(len(on))
        for j in range(i, most):
            to = pieces.base[state] + data[j, rows]
            alive = (pieces.check[to] == state) & (to > 0) & (sizes[rows] > j)
            rows, state, which = rows[alive], to[alive], which[alive]
            if not len(rows):
                break
            ends = np.flatnonzero(pieces.piece[state] >= 0)
            if not len(ends):
                continue
            single[which[ends]] |= width[which[ends]] == j + 1 - i
            score = best[i, rows[ends]] + pieces.score[state[ends]]
            better = score > best[j + 1, rows[ends]]
            ends, score = ends[better], score[better]
            best[j + 1, rows[ends]] = score
            back[j + 1, rows[ends]] = i
            number[j + 1, rows[ends]] = pieces.piece[state[ends]]
        alone = np.flatnonzero(~single)
        ends, rows = i + width[alone], on[alone]
        score = best[i, rows] + pieces.unknown_score
        better = score > best[ends, rows]
        ends, rows = ends[better], rows[better]
        best[ends, rows] = score[better]
        back[ends, rows] = i
        number[ends, rows] = -1
    back, number = back.T.tolist(), number.T.tolist()
    out = []
    for word, size, starts, ids in zip(words, sizes.tolist(), back, number):
        path = []
        while size > 0:
            path.append((starts[size], size, ids[size]))
            size = starts[size]
        flat: list[int] = []
        for start, end, piece in reversed(path):
            if piece >= 0:
                flat.append(piece)
            else:
                flat += _unknown(pieces, word[start:end])
        out.append(flat)
    return out


class Codec:
    """Encodes and decodes with given pieces; words met before are cached.

    No piece goes from a character to a whitespace mark, so the best path of a
    text is those of its stretches, each from a mark to the next; a line feed
    that no piece has stands for itself.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.cache = WordCache(lambda words: viterbi_many(pieces, [w.replace(b" ", _MARK) for w in words]))
        line = b"" if pieces.newline else b"\n"
        self.stretch = re.compile(b" +[^ %b]*|[^ %b]+" % (line, line) + (b"|\n" if line else b""))
        self.size = np.array([len(s) for s in pieces.surface])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of UTF-8 texts, and how many each text has."""
        words = []
        for text in texts:
            text = text.replace(_MARK, b" ")
            if self.pieces.prefix and text:
                text = b" " + text
            if self.pieces.by_words:
                words.append(self.stretch.findall(text))
            else:
                words.append([text] if text else [])
        return self.cache.encode(words)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: marks become spaces, byte pieces bytes (those that
        are no UTF-8 become U+FFFD), and the space put before a text goes."""
        data = b"".join(map(self.pieces.surface.__getitem__, ids))
        if self.pieces.prefix and data[:1] == b" ":
            data = data[1:]
        return data.decode("utf-8", "replace")


def encode(docs: DataFrame, pieces: Pieces, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids`` (array of int) of whole texts. Null and empty texts
    have no ids; repeated rows each get theirs. A column of that name is
    replaced. A literal U+2581 counts as a space. The broadcast is as large as
    the vocabulary."""
    sent, key = Sent(docs.sparkSession, pieces), pieces.key
    others = [c for c in docs.columns if c != ids]
    at_text = others.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(("codec", key), lambda: Codec(sent.value))
        for batch in batches:
            for at, to, texts in blocks(batch.column(at_text)):
                found, sizes = codec.encode(texts)
                cuts = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                lists = pa.ListArray.from_arrays(cuts, pa.array(found.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(at, to - at).columns, lists], [*others, ids]
                )

    kept_columns = docs.select(*(F.col(f"`{c}`") for c in others))
    schema = T.StructType([*kept_columns.schema.fields]).add(ids, T.ArrayType(T.IntegerType()))
    return kept_columns.mapInArrow(run, schema)


def decode(rows: DataFrame, pieces: Pieces, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text that ``ids`` stand for (null ids: null). A column
    of that name is replaced. An id outside the vocabulary is an error."""
    sent, key = Sent(rows.sparkSession, pieces), pieces.key
    others = [c for c in rows.columns if c != text]
    at_ids = others.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(("codec", key), lambda: Codec(sent.value))
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                part = batch.slice(at, _ROWS)
                lists = part.column(at_ids)
                found = [codec.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in lists]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.string())], [*others, text]
                )

    kept_columns = rows.select(*(F.col(f"`{c}`") for c in others))
    schema = T.StructType([*kept_columns.schema.fields]).add(text, T.StringType())
    return kept_columns.mapInArrow(run, schema)


def round_trip(
    docs: DataFrame, pieces: Pieces, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``docs`` with both columns, worked out a
    few rows at a time in one worker, with one vocabulary and one cache."""
    sent, key = Sent(docs.sparkSession, pieces), pieces.key
    others = [c for c in docs.columns if c not in (ids, decoded)]
    at_text = others.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(("codec", key), lambda: Codec(sent.value))
        for batch in batches:
            for at, to, texts in blocks(batch.column(at_text), 1 << 20):
                found, sizes = codec.encode(texts)
                cuts = np.concatenate(([0], np.cumsum(sizes)))
                back = [codec.decode(found[a:b].tolist()) for a, b in zip(cuts[:-1], cuts[1:])]
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(found.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(at, to - at).columns, lists, pa.array(back, pa.string())],
                    [*others, ids, decoded],
                )

    rows = docs.select(*(F.col(f"`{c}`") for c in others))
    schema = T.StructType([*rows.schema.fields]).add(ids, T.ArrayType(T.IntegerType()))
    return rows.mapInArrow(run, schema.add(decoded, T.StringType()))

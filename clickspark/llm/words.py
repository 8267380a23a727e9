"""Words of many texts at once, as numpy arrays.

Words are the longest runs of bytes other than space and tab to carriage
return. Everything works on blocks, so that memory follows the batch and not
the number of shingles in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SPACE = 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SAME = np.arange(256, dtype=np.uint8)
#: Byte tables for ``split_words``: A-Z in lower case; also ASCII punctuation as space.
LOWER = np.where((_SAME >= 65) & (_SAME <= 90), _SAME + 32, _SAME).astype(np.uint8)
BARE = LOWER.copy()
BARE[[c for c in range(33, 127) if not chr(c).isalnum()]] = SPACE

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (
        11400714785074694791,
        14029467366897019727,
        1609587929392839161,
        9650029242287828579,
        2870177450012600261,
    )
)
_BLOCK = 1 << 16
_LONG = 512


@dataclass
class Words:
    """The words of some texts: joined by single spaces in ``data``, each at
    ``starts``:``ends``; text i has words ``first[i]``:``first[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all runs of ``size`` words, and the index of each
        text's first run (and the end). A text of fewer words has one run of
        all of them, a text without words none."""
        counts = np.diff(self.first)
        runs = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
        at = np.concatenate(([0], np.cumsum(runs)))
        word = np.arange(at[-1]) + np.repeat(self.first[:-1] - at[:-1], runs)
        last = word + np.repeat(np.minimum(counts, size) - 1, runs)
        return self.starts[word], self.ends[last], at


def split_words(texts: list[bytes], table: np.ndarray | None = None) -> Words:
    """The words of UTF-8 texts, whose bytes are first replaced by ``table``."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    if table is not None:
        raw = table[raw]
    space = _IS_SPACE[raw]
    opens = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    keep = ~space
    keep[1:] |= ~space[:-1]
    data = np.where(space, np.uint8(SPACE), raw)[keep]
    ends = np.flatnonzero(data == SPACE)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    return Words(data, starts, ends, np.searchsorted(opens, offsets))


def blocks(batch: pa.Array, most: int = 1 << 22) -> Iterator[tuple[int, int, list[bytes]]]:
    """Texts of a string column as UTF-8 (null: empty), in slices of about
    ``most`` bytes: from, to, texts. A text is never divided."""
    sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch), 0).to_numpy(False))
    at = 0
    while at < len(batch):
        base = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, base + most, "right")))
        part = batch.slice(at, to - at).cast(pa.large_binary())
        yield at, to, [t or b"" for t in part.to_pylist()]
        at = to


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of each ``data[start:end]``, as ``uint64``."""
    out = np.empty(len(starts), np.uint64)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    for at in range(0, len(starts), _BLOCK):
        s, e = starts[at : at + _BLOCK], ends[at : at + _BLOCK]
        out[at : at + _BLOCK] = _hash_block(padded, s, e - s, seed)
        for i in np.flatnonzero(e - s > _LONG):
            out[at + i] = xxhash.xxh64_intdigest(data[s[i] : e[i]].tobytes(), seed)
    return out


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(acc + lane * _P2, 31) * _P1


def _hash_block(padded: np.ndarray, at: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    eight = np.ndarray((len(padded) - 7,), "<u8", padded.data, strides=(1,))
    four = np.ndarray((len(padded) - 7,), "<u4", padded.data, strides=(1,))
    with np.errstate(over="ignore"):
        seed64 = np.uint64(seed)
        total = np.full(len(at), seed64 + _P5)
        pos, rest = at.copy(), size.copy()
        wide = np.flatnonzero((size >= 32) & (size <= _LONG))
        if len(wide):
            v = [
                np.full(len(wide), s)
                for s in (seed64 + _P1 + _P2, seed64 + _P2, seed64, seed64 - _P1)
            ]
            todo = np.arange(len(wide))
            while len(todo):
                here = pos[wide[todo]]
                for k in range(4):
                    v[k][todo] = _round(v[k][todo], eight[here + 8 * k])
                pos[wide[todo]] += 32
                rest[wide[todo]] -= 32
                todo = todo[rest[wide[todo]] >= 32]
            acc = _turn(v[0], 1) + _turn(v[1], 7) + _turn(v[2], 12) + _turn(v[3], 18)
            for k in range(4):
                acc = (acc ^ _round(np.zeros(len(wide), np.uint64), v[k])) * _P1 + _P4
            total[wide] = acc
        total += size.astype(np.uint64)
        rest[size > _LONG] = 0
        while len(on := np.flatnonzero(rest >= 8)):
            lane = _round(np.zeros(len(on), np.uint64), eight[pos[on]])
            total[on] = _turn(total[on] ^ lane, 27) * _P1 + _P4
            pos[on] += 8
            rest[on] -= 8
        on = np.flatnonzero(rest >= 4)
        total[on] = _turn(total[on] ^ (four[pos[on]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        pos[on] += 4
        rest[on] -= 4
        while len(on := np.flatnonzero(rest > 0)):
            total[on] = _turn(total[on] ^ (padded[pos[on]].astype(np.uint64) * _P5), 11) * _P1
            pos[on] += 1
            rest[on] -= 1
        total ^= total >> np.uint64(33)
        total *= _P2
        total ^= total >> np.uint64(29)
        total *= _P3
        return total ^ (total >> np.uint64(32))

"""Ids of words that were encoded before."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

MOST_BYTES = 64 << 20
#: What a word takes beside its bytes and ids: the object, its place, where its ids are.
_EACH = 150


class WordCache:
    """Encodes texts given as words; ``learn`` encodes words not met before (all
    their ids, and how many each has). Starts anew when the words held take
    ``most`` bytes, so that memory is bounded whatever their length; words that take
    as much by themselves are encoded and not held."""

    def __init__(
        self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = MOST_BYTES
    ):
        self.learn, self.most = learn, most
        self._clear()

    def _clear(self) -> None:
        self.bytes = 0
        self.place: dict[bytes, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _keep(self, words: list[bytes]) -> None:
        ids, sizes = self.learn(words)
        at, n = len(self.place), len(words)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        while at + n > len(self.starts):
            self.starts = np.resize(self.starts, 2 * len(self.starts))
            self.sizes = np.resize(self.sizes, 2 * len(self.sizes))
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[at : at + n] = self.used + np.cumsum(sizes) - sizes
        self.sizes[at : at + n] = sizes
        self.place.update(zip(words, range(at, at + n)))
        self.used += len(ids)
        self.bytes += sum(map(len, words)) + _EACH * n + 4 * len(ids)

    def encode(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each text has."""
        every = [w for words in texts for w in words]
        new = {*every} - self.place.keys()
        # A word has no more ids than bytes.
        if self.place and self.bytes + sum(5 * len(w) + _EACH for w in new) > self.most:
            self._clear()
            new = {*every}
        if new:
            self._keep(list(new))
        found = self._found(texts, every)
        if self.bytes > self.most:
            self._clear()
        return found

    def _found(self, texts: list[list[bytes]], every: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        at = np.fromiter(map(self.place.__getitem__, every), np.int64, len(every))
        sizes = self.sizes[at]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        shift = np.repeat(self.starts[at] - ends[:-1], sizes)
        ids = self.ids[shift + np.arange(ends[-1])]
        words = np.cumsum([0, *map(len, texts)])
        return ids, np.diff(ends[words])

"""What tasks do with events that wait for the watermark. Sent to the tasks by
value, so that they need pandas but not this package."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The block of events without a time.
UNTIMED = -(1 << 63)
#: Groups in which users are numbered, and rows that pass by in one group at most.
LANES = 256
PASSING = 20_000
#: Events in one value of the state: each value is pickled by itself.
PACK = 256
HELD = "owner array<string>, key array<string>, ts array<bigint>, rank array<string>, row array<string>"
RELEASED = (
    "lane string, kind string, owner string, key string, ref string, ts long, rank string, last long,"
    " delta_ms long, is_start boolean, row string"
)
NUMBERED = "kind string, key string, ref string, ts long, delta_ms long, is_start boolean, row string, number long"
_HELD = ["owner", "key", "ts", "rank", "row"]
_COLUMNS = ["lane", "kind", "owner", "key", "ref", "ts", "rank", "last", "delta_ms", "is_start", "row"]


class Reorder(StatefulProcessor):
    """Holds the events of one part of the keys and one block of time until the
    watermark has passed the block; then marks and releases them in order.

    A row without ``row`` is a report: an event near the end of the block before,
    which only tells how long ago its key was last active.
    """

    def __init__(self, gap_ms: int, block_ms: int):
        self.gap_ms, self.block_ms = gap_ms, block_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", HELD)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        part, block = key
        watermark = timerValues.getCurrentWatermarkInMs()
        waits = False
        for events in rows:
            if block == UNTIMED:
                aside, kind = events, "untimed"
            else:
                late = (events["ts"] < watermark).to_numpy()
                aside, kind = events[late & events["row"].notna().to_numpy()], "late"
                kept = events[~late]
                if len(kept):
                    waits = True
                    told = kept[_HELD].astype(object)
                    told = told.where(told.notna(), None)
                    columns = [told[c].tolist() for c in _HELD]
                    packs = range(0, len(told), PACK)
                    self.held.appendList([tuple(c[k : k + PACK] for c in columns) for k in packs])
            if len(aside):
                yield _rows(aside.assign(owner=None), _passing(part, block, len(aside)), kind)
        if waits:
            self.handle.registerTimer(int(block) + self.block_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        part, block = key
        packs = list(self.held.get())
        held = pd.DataFrame({c: list(chain.from_iterable(p[k] for p in packs)) for k, c in enumerate(_HELD)})
        self.held.clear()
        events = held.sort_values(["key", "ts", "rank"], kind="stable", ignore_index=True)
        events["ts"] = events["ts"].astype("int64")
        at = events["ts"].to_numpy()
        code = events["key"].ne(events["key"].shift()).cumsum().to_numpy()
        first = np.concatenate([[True], code[1:] != code[:-1]])
        delta = np.concatenate([[0], at[1:] - at[:-1]])
        starts = first | (delta >= self.gap_ms)
        events["delta_ms"], events["is_start"] = np.where(starts, 0, delta), starts
        # The session an event is in: by its start, or the one that the key brings along.
        own = events["row"].notna().to_numpy()
        begins = np.maximum.accumulate(np.where(starts & own, np.arange(len(events)), -1))
        inside = (begins >= 0) & (code[begins] == code)
        refs = [f"{block}:{at[b]}" if i else f"{block}:" for b, i in zip(begins.tolist(), inside.tolist())]
        events["ref"] = refs
        events["last"] = events.groupby(code)["ts"].transform("max")
        events = events[own]
        if not len(events):
            return
        yield _rows(events.assign(owner=None), _passing(part, block, len(events)), "event")
        # What is numbered: starts, and once for each key the session brought along.
        carried = ~events["is_start"] & events["ref"].str.endswith(":")
        carried &= ~(events["key"].where(carried).duplicated())
        numbered = events[(events["is_start"] | carried) & events["owner"].notna()]
        if len(numbered):
            yield _rows(numbered.assign(row=None), numbered["owner"].map(_lane), "number")

    def close(self) -> None:
        pass


def _passing(part: int, block: int, n: int) -> list[str]:
    """Lanes of rows that only pass by, few enough in each for any one task."""
    return [f"p{part}:{block}:{k // PASSING}" for k in range(n)]


def _lane(owner: str) -> str:
    return f"o{zlib.crc32(owner.encode('utf-8', 'surrogatepass')) % LANES}"


def _rows(events: pd.DataFrame, lane, kind: str) -> pd.DataFrame:
    told = events.assign(lane=lane, kind=kind)
    for column in _COLUMNS:
        if column not in told:
            told[column] = pd.NA
    whole = {"ts": "Int64", "last": "Int64", "delta_ms": "Int64", "is_start": "boolean"}
    return told[_COLUMNS].astype(whole)


class Number(StatefulProcessor):
    """Numbers the sessions of each user of a lane in order of time. Other rows pass by.
    For each user and block there is also a row (``base``) with the number before it.

    The state is, for each user, the number of sessions so far, and the number and last
    moment of each key that may still go on.
    """

    def __init__(self, gap_ms: int, block_ms: int):
        self.gap_ms, self.block_ms = gap_ms, block_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("sessions", "owner string", "started long, active string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        columns = ["kind", "key", "ref", "ts", "delta_ms", "is_start", "row", "number"]
        whole = {"ts": "Int64", "delta_ms": "Int64", "is_start": "boolean", "number": "Int64"}
        if key[0].startswith("p"):
            for events in rows:
                yield events.assign(number=pd.NA)[columns].astype(whole)
            return
        marks = pd.concat(list(rows), ignore_index=True)
        marks["block"] = marks["ref"].map(lambda r: int(r.split(":")[0]))
        # A session brought along is known before any of its block begins.
        marks = marks.sort_values(["owner", "block", "is_start", "ts", "rank"], kind="stable")
        every = zip(*(marks[c].tolist() for c in ("owner", "key", "is_start", "last", "block")))
        numbers, bases = [], []
        for owner, own in groupby(every, itemgetter(0)):
            self._number(owner, own, numbers, bases)
        yield marks.assign(number=numbers)[columns].astype(whole)
        before = pd.DataFrame(bases, columns=["key", "ref", "number"])
        before = before.assign(kind="base", row=None, ts=pd.NA, delta_ms=pd.NA, is_start=pd.NA)
        yield before[columns].astype(whole)

    def _number(self, owner: str, marks: Iterator[tuple], numbers: list, bases: list) -> None:
        """Adds to ``numbers`` those of one user's marks, to ``bases`` those before its blocks."""
        started, text = self.state.getValue((owner,)) or (0, "{}")
        active, block = json.loads(text), None
        for _, name, begins, last, at in marks:
            if at != block:
                bases.append((owner, str(at), started))
                block = at
            if begins:
                started += 1
                active[name] = [started, int(last)]
            else:
                active[name] = [active[name][0], int(last)]
            numbers.append(active[name][0])
        since = block + self.block_ms - self.gap_ms
        active = {k: v for k, v in active.items() if v[1] > since}
        self.state.updateValue((owner,), (started, json.dumps(active)))

    def close(self) -> None:
        pass

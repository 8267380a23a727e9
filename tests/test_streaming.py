"""Streams against the batch operators, with files arriving one by one."""

import json
import os
import random
import time

import pytest
from conftest import MINUTE, SPEC, T0, click, clicks
from pyspark.sql import functions as F

import clickspark as cs
from clickspark.schema import CLICK_SCHEMA
from clickspark.sources.clicks import stream_clicks
from clickspark.streaming.event_time import (
    held_events,
    read_aside,
    read_released,
    start_event_time,
)
from clickspark.streaming.incremental import BY_FILE, counts_of_batch, sketches_of_batch
from clickspark.streaming.ledger import SessionLedger, read_sessions, start_sessionizing
from clickspark.streaming.sinks import (
    compact,
    read_batches,
    read_quarantine,
    read_results,
    run_available,
    start_batches,
    start_quarantined,
)
from clickspark.streaming.windows import (
    DroppedRows,
    all_windows,
    open_windows,
    stream_session_windows,
)

STRICT = SPEC.with_(mode="strict")


def ordered_rows():
    """Two users, several devices, gaps on both sides of the limit, ties."""
    rows, at = [], T0
    steps = [0, 1, 5, 30, 2, 45, 29, 0, 31, 1, 1, 90, 3, 30, 4, 10, 0, 60, 5, 5]
    for n, step in enumerate(steps * 2):
        at += step * MINUTE
        user = ["u1", "u2", "u1", None][n % 4]
        rows.append(click(user, ["a", None, "b"][n % 3], "o", "b", at, n))
    return rows


def arrive(folder, rows, parts):
    """Rows as JSON files, the older the earlier, whose times of writing differ."""
    folder.mkdir(exist_ok=True)
    size = -(-len(rows) // parts)
    names = CLICK_SCHEMA.fieldNames()
    for part in range(parts):
        path = folder / f"part-{part:05d}.json"
        lines = [json.dumps(dict(zip(names, r))) for r in rows[part * size : (part + 1) * size]]
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + part * 60, 1_700_000_000 + part * 60))


def in_order(df):
    columns = sorted(df.columns)
    return sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))


def disordered(seed):
    """Events of a user who has a third of them and of others, in order of arrival:
    copies, ties, missing users, dimensions and tiebreaks."""
    draw, rows = random.Random(seed), []
    for n in range(300):
        at = draw.choice([draw.randrange(3000), draw.randrange(100) * 30])
        user = "hot" if n % 3 == 0 else draw.choice(["u1", "u2", None])
        tie = None if n % 17 == 0 else n % 50
        rows.append((at, click(user, draw.choice(["a", "b", None]), "o", "b", T0 + at * MINUTE, tie)))
    rows += rows[:20]
    rows.sort(key=lambda r: r[0] + draw.choice([0, 0, 0, 100, 250]))
    return [r for _, r in rows]


LAST = click("z", "a", "o", "b", T0 + 100_000 * MINUTE, 1)


def run_in_event_time(spark, tmp_path, rows, parts, spec, **more):
    arrive(tmp_path / "in", rows, parts)
    stream = stream_clicks(spark, str(tmp_path / "in"), by_file=False)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    start_event_time(stream, out, checkpoint, spec, "6 hours", parts=3, **more).awaitTermination()
    return out, checkpoint, stream.schema


@pytest.mark.parametrize("mode, block_ms", [("strict", None), ("strict", 90 * MINUTE), ("compat", None)])
def test_ids_of_events_out_of_order_equal_the_batch(spark, tmp_path, mode, block_ms):
    rows, spec = disordered(1), SPEC.with_(mode=mode)
    untimed = [click("u1", "a", "o", "b", at, 7) for at in (None, 2**62)]
    late = click("u1", "a", "o", "b", T0 + 5 * MINUTE, 999)
    arriving = [*rows[:50], *untimed, *rows[50:], late, LAST]
    out, checkpoint, schema = run_in_event_time(spark, tmp_path, arriving, 8, spec, block_ms=block_ms)
    batch = cs.sessionize(clicks(spark, rows), spec)
    assert in_order(read_released(spark, out)) == in_order(batch)
    aside = read_aside(spark, out).select(*schema.fieldNames(), "reason").collect()
    want = [(*late, "late"), *((*u, "untimed") for u in untimed)]
    assert sorted(map(repr, map(tuple, aside))) == sorted(map(repr, want))
    held = held_events(spark, checkpoint, schema).collect()
    assert [tuple(r) for r in held] == [LAST]


def test_event_time_goes_on_after_a_restart_and_a_batch_run_again(spark, tmp_path):
    rows = [*disordered(2)[:319], LAST]
    for until in (160, 320):
        out, _, _ = run_in_event_time(spark, tmp_path, rows[:until], until // 40, STRICT)
        if until == 160:  # as if the query had ended before the last batch was committed
            last = max(int(p.name) for p in (tmp_path / "cp" / "commits").iterdir() if p.name.isdigit())
            (tmp_path / "cp" / "commits" / str(last)).unlink()
            (tmp_path / "cp" / "commits" / f".{last}.crc").unlink(missing_ok=True)
    assert in_order(read_released(spark, out)) == in_order(
        cs.sessionize(clicks(spark, rows[:-1]), STRICT)
    )


def test_columns_come_through_event_time_unchanged(spark, tmp_path):
    schema = (
        "anonymous_id string, device_family string, os_family string, browser_family string,"
        " device_sent_timestamp long, n long, t timestamp, l timestamp_ntz, x double, d decimal(30,9),"
        " m map<string,long>, a array<struct<b binary>>, z date, f boolean"
    )
    more = [
        ("u", None, "", "\u0000é\n", T0, 2**62 + 1, 1, 2, 0.1, 7, None, None, None, True),
        (None, "a", "b", "c", T0, None, 1, 2, float("nan"), None, None, None, None, None),
        ("u", "a", "b", "c", T0 + 5000 * 60_000, -(2**62), 1, 2, -0.0, 7, None, None, None, False),
    ]
    rows = spark.createDataFrame(
        [r[:6] + (r[8], r[13]) for r in more],
        "anonymous_id string, device_family string, os_family string, browser_family string,"
        " device_sent_timestamp long, n long, x double, f boolean",
    )
    rows = rows.selectExpr(
        "anonymous_id", "device_family", "os_family", "browser_family", "device_sent_timestamp", "n",
        "timestamp_micros(device_sent_timestamp * 1000 + 123) as t",
        "timestamp_ntz '1960-01-01 00:00:00.000001' as l", "x",
        "cast('123456789012345678901.000000001' as decimal(30,9)) as d", "map('k', n) as m",
        "array(named_struct('b', x'00ff')) as a", "date '0001-01-01' as z", "f",
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    start_event_time(stream, out, cp, STRICT, "0 seconds").awaitTermination()
    seen = read_released(spark, out).select(*rows.columns).unionByName(held_events(spark, cp, rows.schema))
    assert len(schema.split(", ")) == len(rows.columns)
    assert in_order(seen) == in_order(rows) and seen.count() == 3


def test_windows_equal_the_batch(spark, tmp_path):
    rows = ordered_rows()
    arrive(tmp_path / "in", rows, 4)
    stream = stream_clicks(spark, str(tmp_path / "in"), by_file=False)
    windows = stream_session_windows(stream, SPEC, "1 hour")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    start_batches(windows, out, checkpoint).awaitTermination()
    got = all_windows(spark, out, checkpoint, SPEC)
    still = open_windows(spark, checkpoint, SPEC).count()
    assert 0 < still < got.count()
    starts = cs.session_starts(clicks(spark, rows)).select(*SPEC.keys, "start_ts")
    assert in_order(got.select(*SPEC.keys, "start_ts")) == in_order(starts)
    assert got.agg(F.sum("events")).first()[0] == len(rows)


def test_windows_in_append_mode_wait_for_the_watermark(spark, tmp_path):
    rows = [click("u", "d", "o", "b", T0 + m * MINUTE, n) for n, m in enumerate([0, 10, 100, 300])]
    arrive(tmp_path / "in", rows, 4)
    stream = stream_clicks(spark, str(tmp_path / "in"), by_file=False)
    windows = stream_session_windows(stream, SPEC, lateness="1 minute")
    got = run_available(spark, windows, "append")
    assert sorted(r.duration for r in got.collect()) == [0.0, 600.0]


def test_dropped_rows_are_counted_over_all_batches(spark, tmp_path):
    rows = [click("u", "d", "o", "b", T0 + m * MINUTE, n) for n, m in enumerate([0, 300, 301, 5, 302, 6])]
    arrive(tmp_path / "in", rows, 6)
    stream = stream_clicks(spark, str(tmp_path / "in"), by_file=False)
    windows = stream_session_windows(stream, SPEC, lateness="1 minute")
    dropped = DroppedRows()
    spark.streams.addListener(dropped)
    try:
        query = start_batches(windows, str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        for _ in range(50):
            if dropped.rows[str(query.id)] == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(dropped)
    assert dropped.rows[str(query.id)] == 2


def test_counts_and_medians_as_files_arrive(spark, tmp_path):
    rows = ordered_rows()
    arrive(tmp_path / "in", rows, 4)
    source = str(tmp_path / "in")
    batch = cs.read_clicks(spark, source)
    parts = run_available(spark, stream_clicks(spark, source), "counts", counts_of_batch())
    assert parts.select("file").distinct().count() == 4
    expected = cs.sessions_by_dim(cs.session_starts(batch, BY_FILE), BY_FILE)
    assert in_order(cs.fold_counts(parts)) == in_order(expected)
    sketches = run_available(spark, stream_clicks(spark, source), "med", sketches_of_batch())
    medians = cs.median_gap_by_dim(batch, BY_FILE, exact=True)
    assert in_order(cs.merge_sketches(sketches)) == in_order(medians)


def test_broken_lines_of_a_stream_are_kept_aside(spark, tmp_path):
    rows, (source, out) = ordered_rows(), (tmp_path / "in", str(tmp_path / "out"))
    arrive(source, rows, 4)
    for part in (1, 3):
        with open(source / f"part-{part:05d}.json", "a") as more:
            more.write("{broken %d\n[1]\n" % part)
        os.utime(source / f"part-{part:05d}.json", (1_700_000_000 + part * 60,) * 2)
    for _ in range(2):  # the second time the last batch runs again
        stream = stream_clicks(spark, str(source), by_file=False, corrupt="line")
        start_quarantined(stream, out, str(tmp_path / "cp"), "line").awaitTermination()
        commits = tmp_path / "cp" / "commits"
        (commits / "3").unlink(), (commits / ".3.crc").unlink()
    assert in_order(read_results(spark, out)) == in_order(clicks(spark, rows))
    broken = sorted(tuple(r) for r in read_quarantine(spark, out, ["line"]).collect())
    assert broken == [("[1]", 1), ("[1]", 3), ("{broken 1", 1), ("{broken 3", 3)]


def test_old_batches_are_merged(spark, tmp_path):
    rows, out = ordered_rows(), str(tmp_path / "out")
    arrive(tmp_path / "in", rows, 8)
    source = str(tmp_path / "in")
    run = lambda: start_batches(
        stream_clicks(spark, source), out, str(tmp_path / "cp"), counts_of_batch()
    ).awaitTermination()
    run()
    whole = cs.sessions_by_dim(cs.session_starts(cs.read_clicks(spark, source), BY_FILE), BY_FILE)
    want = in_order(whole)
    now = lambda: in_order(cs.fold_counts(read_batches(spark, out)))
    assert now() == want
    folders = lambda: sorted(p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("batch"))
    assert compact(spark, out, keep=5) == 2 and now() == want
    assert folders() == [f"batch={b}" for b in range(3, 8)]
    fold = lambda df: cs.fold_counts(df)
    assert compact(spark, out, keep=2, of_parts=fold) == 5 and now() == want
    assert folders() == ["batch=6", "batch=7"]
    assert [p.name for p in (tmp_path / "out" / "_merged").iterdir()] == ["upto=5"]
    # Broken off before the old ones went, and before the new one was whole.
    (tmp_path / "out" / "batch=4").mkdir()
    (tmp_path / "out" / "batch=4" / "_SUCCESS").touch()
    (tmp_path / "out" / "_merged" / "upto=6").mkdir()
    assert now() == want
    # The last batch runs again.
    (tmp_path / "cp" / "commits" / "7").unlink(), (tmp_path / "cp" / "commits" / ".7.crc").unlink()
    run()
    assert now() == want
    assert compact(spark, out, keep=1, of_parts=fold) == 6 and now() == want
    assert folders() == ["batch=7"]


def test_new_files_add_to_earlier_results(spark, tmp_path):
    rows = ordered_rows()
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for until in (20, 40):
        arrive(tmp_path / "in", rows[:until], until // 10)
        query = start_batches(stream_clicks(spark, source), out, checkpoint, counts_of_batch())
        query.awaitTermination()
        whole = cs.session_starts(cs.read_clicks(spark, source), BY_FILE)
        expected = cs.sessions_by_dim(whole, BY_FILE)
        assert in_order(cs.fold_counts(read_batches(spark, out))) == in_order(expected)


@pytest.mark.parametrize(
    "spec",
    [STRICT, SPEC, STRICT.with_(max_group_rows=6)],
    ids=["strict", "compat", "divided"],
)
def test_ledger_equals_the_batch(spark, tmp_path, spec):
    rows = ordered_rows()
    arrive(tmp_path / "in", rows, 4)
    stream = stream_clicks(spark, str(tmp_path / "in"), by_file=False)
    out = str(tmp_path / "out")
    query = start_sessionizing(stream, out, str(tmp_path / "cp"), spec, whole_every=2)
    query.awaitTermination()
    assert in_order(read_sessions(spark, out)) == in_order(cs.sessionize(clicks(spark, rows), spec))


def test_ledger_batch_may_be_run_again(spark, tmp_path):
    rows = ordered_rows()
    ledger = SessionLedger(str(tmp_path), STRICT)
    for batch, part in [(0, rows[:20]), (1, rows[20:]), (1, rows[20:])]:
        ledger.add(clicks(spark, part), batch)
    assert in_order(read_sessions(spark, str(tmp_path))) == in_order(
        cs.sessionize(clicks(spark, rows), STRICT)
    )


def test_event_time_runs_on_a_session_without_rocksdb(spark, tmp_path):
    """The check builds its own session; the buffer's state needs RocksDB anyway."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.unset(key)
    try:
        rows = [click("u1", "a", "o", "b", T0 + m * MINUTE, m) for m in (0, 5, 50)] + [LAST]
        out, _, _ = run_in_event_time(spark, tmp_path, rows, 2, STRICT)
        assert read_released(spark, out).count() == 3
        assert spark.conf.get(key, None) is None
    finally:
        if before is not None:
            spark.conf.set(key, before)


def test_a_replayed_part_is_one_file_read_by_its_row_groups(spark, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    from clickspark.sources import events

    monkeypatch.setattr(events, "ROW_GROUP_BYTES", 64 << 10)
    rows = spark.range(40_000).select(
        F.col("id").alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("text"), (F.col("id") % 2).alias("at")
    )
    path = events.written_in_order(rows, F.col("at"), 2)
    files = sorted(glob.glob(f"{path.removeprefix('file:')}/*.parquet"))
    assert len(files) == 2
    assert all(pq.ParquetFile(f).metadata.num_row_groups > 1 for f in files)
    assert spark.read.parquet(path).count() == 40_000


class _State:
    """What a task sees of one state variable."""

    def __init__(self):
        self.values, self.users, self.calls = [], {}, 0

    def getListState(self, *_):
        return self

    getMapState = getListState

    def registerTimer(self, at):
        pass

    def getCurrentWatermarkInMs(self):
        return 0

    def appendList(self, values):
        self.values += values

    def get(self):
        return iter(self.values)

    def clear(self):
        self.values = []

    def getValue(self, user):
        self.calls += 1
        return self.users.get(user)

    def updateValue(self, user, value):
        self.users[user] = value


def test_events_are_held_in_packs_and_users_share_lanes():
    """The work of the buffer goes with events, not with a value of the state for each
    event and a group for each user."""
    import pandas as pd

    from clickspark.streaming import reorder

    day = 86_400_000
    users = [f"u{k}" for k in range(3_000)]
    seen = [(u, f'["{u}"]', at, "r", f"{u} {at}") for at in (1_000, 9_000) for u in users]
    events = pd.DataFrame(seen, columns=["owner", "key", "ts", "rank", "row"])
    state, held = _State(), reorder.Reorder(5_000, day)
    held.init(state)
    assert list(held.handleInputRows((0, 0), iter([events]), state)) == []
    assert len(state.values) <= len(events) / 100
    out = pd.concat(held.handleExpiredTimer((0, 0), state, None))
    assert sorted(out["row"].dropna()) == sorted(events["row"]) and state.values == []
    passing, numbered = out[out["kind"] == "event"], out[out["kind"] == "number"]
    assert len(numbered) == len(events) and numbered["lane"].nunique() <= reorder.LANES
    assert passing.groupby("lane").size().max() <= reorder.PASSING
    told = []
    for lane, marks in numbered.groupby("lane"):
        state = _State()
        number = reorder.Number(5_000, day)
        number.init(state)
        first, second = marks[marks["ts"] < 5_000], marks[marks["ts"] > 5_000].assign(ref=f"{day}:9000")
        for part in (first, second):  # a later block goes on where the one before ended
            told += number.handleInputRows((lane,), iter([part]), None)
        assert state.calls == marks["owner"].nunique() * 2
    told = pd.concat(told)
    numbers = told[told["kind"] == "number"].groupby("key")["number"].apply(sorted)
    assert len(numbers) == 3_000 and all(n == [1, 2] for n in numbers)
    bases = told[told["kind"] == "base"]
    assert {(k, r): n for k, r, n in zip(bases["key"], bases["ref"], bases["number"])} == {
        (u, str(b)): n for u in users for b, n in ((0, 0), (day, 1))
    }

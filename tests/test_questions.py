"""The three questions, folds and exploration."""

import datetime as dt
import gzip
import json
import pathlib
import random
import statistics
from collections import Counter

import pytest
from conftest import MINUTE, SPEC, T0, click, clicks, hand_rows
from pyspark.sql import functions as F
from test_sessions import random_rows

import clickspark as cs
from clickspark.operators.folds import sketch_gaps
from clickspark.operators.medians import continuation_gaps, median_of_counts
from clickspark.sources.events import EVENTS_SCHEMA

COUNTS = {
    "device_family": {"Not Identified": 1, "": 1, "Spider": 1, "iPhone": 2, "iPhone10,6": 1},
    "os_family": {"Android": 2, "Other": 1, "iOS": 3},
    "browser_family": {"Bot": 1, "Chrome": 2, "Safari": 3},
}
MEDIANS = {
    "device_family": {"Not Identified": 60.0, "iPhone": 300.0, "iPhone10,6": 120.0},
    "os_family": {"Android": 60.0, "iOS": 300.0},
    "browser_family": {"Chrome": 60.0, "Safari": 300.0},
}


def nested(df, value):
    out = {}
    for row in df.collect():
        out.setdefault(row.what, {})[row.ref] = row[value]
    return out


@pytest.mark.parametrize("way", ["aggregation", "compat", "strict"])
def test_counts(hand, way):
    if way == "aggregation":
        starts = cs.session_starts(hand)
    else:
        starts = cs.starts_of(cs.sessionize(hand, SPEC.with_(mode=way)))
    assert cs.sessions_total(starts).first().qtd_session == 6
    assert nested(cs.sessions_by_dim(starts), "qtd_session") == COUNTS
    by_device = {r[0]: r[1] for r in cs.sessions_by(starts, "device_family").collect()}
    assert by_device == {None: 1, "": 1, "Spider": 1, "iPhone": 2, "iPhone10,6": 1}


def test_value_seen_only_without_a_user_is_reported_with_zero(spark):
    starts = cs.session_starts(clicks(spark, [click(None, "d", "o", "b", T0, 1)]))
    assert nested(cs.sessions_by_dim(starts), "qtd_session")["os_family"] == {"o": 0}
    assert cs.sessions_total(starts).first().qtd_session == 0


def test_no_events_no_sessions(spark):
    starts = cs.session_starts(clicks(spark, []))
    assert cs.sessions_total(starts).first().qtd_session == 0
    assert cs.sessionize(clicks(spark, [])).count() == 0


def test_labels_join_spellings(spark):
    rows = [click("u", d, "o", "b", T0 + n, n) for n, d in enumerate([" x", "x", None])]
    counts = nested(cs.sessions_by_dim(cs.session_starts(clicks(spark, rows))), "qtd_session")
    assert counts["device_family"] == {"x": 2, "Not Identified": 1}


@pytest.mark.parametrize("layout", ["user", "ticks"])
@pytest.mark.parametrize("exact", [False, True])
def test_median_gaps(hand, layout, exact):
    spec = SPEC.with_(layout=layout)
    assert nested(cs.median_gap_by_dim(hand, spec, exact=exact), "median") == MEDIANS


def test_median_between_two_gaps(hand):
    found = nested(cs.median_gap_by_dim(hand, between=True), "median")
    # Continuations on iOS: 120, 120, 300, 600, 1799.999; with Safari the same.
    assert found["os_family"]["iOS"] == 300.0
    assert found["device_family"]["iPhone"] == 450.0


@pytest.mark.parametrize("seed", [11, 12])
def test_copies_count_in_medians(spark, seed):
    df = clicks(spark, random_rows(seed)).cache()
    ways = [
        cs.median_gap_by_dim(df, SPEC.with_(layout="user")),
        cs.median_gap_by_dim(df, SPEC.with_(layout="user"), exact=True),
        cs.median_gap_by_dim(df, SPEC.with_(layout="ticks")),
        cs.median_gap_by_dim(df, SPEC.with_(layout="ticks"), exact=True),
        cs.median_gap_by_dim(df, SPEC.with_(max_group_rows=300)),
    ]
    first, *others = (nested(w, "median") for w in ways)
    assert others == [first] * 4


@pytest.mark.parametrize("weights, low, middle", [
    ([(1, 1), (2, 1), (3, 1), (4, 1)], 2, 2.5),
    ([(1, 3), (9, 2)], 1, 1.0),
    ([(1, 2), (9, 2)], 1, 5.0),
    ([(5, 1)], 5, 5.0),
    ([(1, 1), (2, 5), (3, 1)], 2, 2.0),
])
def test_weighted_median(spark, weights, low, middle):
    df = spark.createDataFrame([("g", v, w) for v, w in weights], "g string, v long, w long")
    assert median_of_counts(df, ["g"], "v", "w").first().median == low
    assert median_of_counts(df, ["g"], "v", "w", between=True).first().median == middle


@pytest.mark.parametrize("block", [1, 10, 1000])
def test_median_over_blocks(spark, monkeypatch, block):
    monkeypatch.setattr("clickspark.operators.medians.VALUES_PER_BLOCK", block)
    rng = random.Random(block)
    values = {
        f"g{g}": [rng.choice([0, 1, 9, 10, 11, 50, rng.randrange(200)]) for _ in range(g + 1)]
        for g in range(25)
    }
    rows = [(g, v, 1) for g, vs in values.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v long, w long")
    low = {r.g: r.median for r in median_of_counts(df, ["g"], "v", "w").collect()}
    mid = {r.g: r.median for r in median_of_counts(df, ["g"], "v", "w", between=True).collect()}
    assert low == {g: statistics.median_low(vs) for g, vs in values.items()}
    assert mid == {g: statistics.median(vs) for g, vs in values.items()}


def test_medians_per_session(hand):
    sess = cs.sessionize(hand)
    found = {r.session_id: r.median for r in cs.median_gap_by_session(sess).collect()}
    assert found["session_1_u1"] == 0.0 and found["session_3_u1"] == 0.0
    rounded = {r[0]: r[1] for r in cs.median_distinct_gap_by_session(sess).collect()}
    assert rounded["session_1_u1"] == 150.0 and rounded["session_3_u1"] == 900.0
    middle = {r[0]: r[1] for r in cs.half_event_count(sess).collect()}
    assert middle["session_1_u1"] == 1.0
    lists = {r[0]: r[1] for r in cs.gap_list_by_session(sess).collect()}
    assert lists["session_3_u1"] == [0.0, 1799.999]


def test_durations(hand):
    found = {r.session_id: r.duration for r in cs.session_durations(cs.sessionize(hand)).collect()}
    assert found == {
        "session_1_u1": 300.0, "session_2_u1": 60.0, "session_3_u1": 1799.999,
        "session_1_u2": 60.0, "session_2_u2": 120.0, "session_1_u3": 0.0,
    }
    strict = cs.sessionize(hand, SPEC.with_(mode="strict"))
    for exact in (False, True):
        medians = nested(cs.median_session_duration_by_dim(strict, exact=exact), "median")
        assert medians["device_family"]["iPhone"] == 420.0
        assert medians["os_family"] == {"iOS": 420.0, "Other": 0.0, "Android": 0.0}


def test_approximate_quantile_is_within_its_error(spark):
    df = clicks(spark, random_rows(13, unique_ts=True, size=900))
    for layout in ("user", "ticks"):
        spec = SPEC.with_(layout=layout)
        found = cs.approx_quantile_gap(df, spec).first()
        value = found.quantile
        gaps = sorted(
            r.gap_ms / 1000 for r in continuation_gaps(df, spec).collect() for _ in range(r.events)
        )
        below = sum(g < value for g in gaps) / len(gaps)
        upto = sum(g <= value for g in gaps) / len(gaps)
        assert below <= 0.75 and upto >= 0.25
        assert (found.gaps, found.rank_from, found.proven) == (len(gaps), -(-len(gaps) // 2) - len(gaps) // 4, True)
        assert (found.least_rank, found.most_rank) == (gaps.index(value) + 1, round(upto * len(gaps)))
    none = cs.approx_quantile_gap(df.limit(0), SPEC).first()
    assert (none.quantile, none.gaps) == (None, 0)


def test_dimension_totals_equal_the_number_of_sessions(spark):
    starts = cs.session_starts(clicks(spark, random_rows(14))).cache()
    total = cs.sessions_total(starts).first().qtd_session
    counts = nested(cs.sessions_by_dim(starts), "qtd_session")
    assert {sum(c.values()) for c in counts.values()} == {total}


def test_fold_of_medians_depends_on_order(spark):
    parts = [("f1", "w", "r", 10.0), ("f2", "w", "r", 20.0), ("f1", "w", "once", 8.0)]
    schema = "file string, what string, ref string, median double"
    fold = lambda rows: nested(cs.fold_median_compat(spark.createDataFrame(rows, schema)), "median")
    assert fold(parts) == {"w": {"r": 12.5, "once": 4.0}}
    assert fold([("f1", "w", "r", 20.0), ("f2", "w", "r", 10.0)]) == {"w": {"r": 10.0}}


def test_merged_sketches_give_the_median(spark):
    df = clicks(spark, random_rows(15, copies=False)).withColumn(
        "file", (F.col("n") % 3).cast("string")
    )
    spec = SPEC.with_(scope=("file",), layout="user")
    merged = cs.merge_sketches(sketch_gaps(continuation_gaps(df, spec), spec))
    assert nested(merged, "median") == nested(cs.median_gap_by_dim(df, spec, exact=True), "median")


def write_files(folder: pathlib.Path):
    names = SPEC.keys and [
        "anonymous_id", "browser_family", "device_family", "device_sent_timestamp",
        "event", "n", "os_family", "platform", "version",
    ]
    rows = hand_rows()
    for part, chosen in enumerate([rows[:6], rows[6:]]):
        with gzip.open(folder / f"part-0000{part}.json.gz", "wt") as out:
            for row in chosen:
                known = {k: v for k, v in zip(names, row) if v is not None}
                out.write(json.dumps(known) + "\n")
    with gzip.open(folder / "part-00002.json.gz", "wt") as out:
        out.write("{not json\n")


def test_application(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    write_files(source)
    read = cs.read_clicks(spark, str(source))
    assert read.count() == 14
    assert read.where("device_sent_timestamp is null").count() == 1
    q1, q2, q3 = cs.run(spark, str(source))
    # The line that is no JSON is an event of nobody: reported, not counted.
    counted = {"part-00000.json.gz": 3, "part-00001.json.gz": 3, "part-00002.json.gz": 0}
    by_path = {r.file: r.qtd_session for r in q1.collect()}
    assert all(path.startswith("file:/") for path in by_path)
    assert {path.rsplit("/", 1)[1]: n for path, n in by_path.items()} == counted
    short = cs.run(spark, str(source), full_path=False)[0]
    assert {r.file: r.qtd_session for r in short.collect()} == counted
    expected = {what: dict(refs) for what, refs in COUNTS.items()}
    expected["os_family"]["Not Identified"] = expected["browser_family"]["Not Identified"] = 0
    assert nested(q2, "qtd_session") == expected
    assert nested(q3, "median") == MEDIANS
    cs.write_question_files((short, q2, q3), str(out))
    docs = []
    for number in (1, 2, 3):
        (part,) = (out / f"question{number}.json").glob("part-*")
        docs.append(json.loads(part.read_text()))
    assert docs[0]["part-00000.json.gz"] == 3
    assert docs[1]["os_family"]["iOS"] == 3.0
    assert docs[2] == MEDIANS


def test_application_across_files_and_folds(spark, tmp_path):
    write_files(tmp_path)
    q1, q2, _ = cs.run(spark, str(tmp_path), by_file=False)
    assert [tuple(r) for r in q1.collect()] == [("*", 6)]
    assert nested(q2, "qtd_session")["os_family"]["iOS"] == 3
    _, _, fold = cs.run(spark, str(tmp_path), median="fold")
    # iOS: 300 in the first file, then 120; the running value starts at 0.
    assert nested(fold, "median")["os_family"] == {"iOS": (150.0 + 120.0) / 2, "Android": 30.0}
    with pytest.raises(ValueError):
        cs.run(spark, str(tmp_path), median="mean")


def test_saved_events_come_back_with_inferred_types(spark, hand, tmp_path):
    path = str(tmp_path / "saved")
    cs.save_events_json(cs.session_gaps(hand), path)
    back = cs.read_saved(spark, path)
    assert back.columns == sorted(back.columns)
    assert dict(back.dtypes)["event_time"] == "string"
    assert back.count() == 13
    typed = cs.read_saved(spark, path, cs.CLICK_SCHEMA)
    assert typed.schema == cs.CLICK_SCHEMA


def test_exploration(hand):
    assert cs.event_count(hand).first().events == 13
    assert [tuple(r) for r in cs.top_users(hand, 2).collect()] == [("u1", 6), ("u2", 4)]
    assert [r.n for r in cs.user_timeline(hand, "u2").collect()] == [7, 8, 9, 10]
    assert [r.n for r in cs.busiest_user_timeline(hand).collect()] == [1, 2, 3, 4, 5, 6]
    sess = cs.sessionize(hand)
    assert {r.n for r in cs.one_session(sess, "session_2_u1").collect()} == {3, 4}
    assert {r.session_id for r in cs.busiest_session(sess).collect()} == {"session_1_u1"}
    gaps = Counter(tuple(r) for r in cs.distinct_gaps(sess).collect())
    assert gaps[("session_1_u1", 0.0)] == 1 and gaps[("session_1_u1", 300.0)] == 1


def test_numbers_in_other_forms_and_broken_lines(spark, tmp_path):
    lines = [
        '{"anonymous_id":"u","device_sent_timestamp":1577836800000}',
        '{"anonymous_id":"u","device_sent_timestamp":1577836860000.0}',
        '{"anonymous_id":"u","device_sent_timestamp":"1577836920000"}',
        "{broken",
    ]
    (tmp_path / "in.json").write_text("\n".join(lines))
    read = cs.read_clicks(spark, str(tmp_path), corrupt="bad").cache()
    assert [r.bad for r in read.where("bad is not null").collect()] == ["{broken"]
    good = read.where("bad is null")
    assert cs.sessions_total(cs.session_starts(good)).first()[0] == 1


def test_clock_values_out_of_range(spark):
    top = 2**63 - 1
    times = [1577836800000000000, top, -top, 1577836800000]
    df = clicks(spark, [click("u", "d", "o", "b", t, n) for n, t in enumerate(times)])
    got = {r.n: r for r in cs.sessionize(df).collect()}
    assert [got[n].event_time is None for n in range(4)] == [True, True, True, False]
    assert not any(r.same_section for r in got.values())
    assert cs.sessions_total(cs.session_starts(df)).first()[0] == 4


def test_measures_per_session_keep_files_apart(spark):
    spec = cs.SessionSpec(mode="strict", scope=("file",))
    rows = [click("u", "d", "o", "b", T0 + k * MINUTE, k) for k in range(3)]
    df = clicks(spark, rows[:2]).withColumn("file", F.lit("a"))
    df = df.unionByName(clicks(spark, rows).withColumn("file", F.lit("b")))
    found = cs.sessionize(df, spec)
    half = {r.file: r.central for r in cs.half_event_count(found, spec).collect()}
    assert half == {"a": 1.0, "b": 1.5}
    assert cs.busiest_session(found, spec).count() == 3
    assert cs.gap_list_by_session(found, spec).count() == 2


def test_ties_get_the_same_ids_in_every_layout(spark):
    rows = [
        click("u", d, "o", "b", T0, 1, event=e)
        for d, e in (("d1", "y"), ("d2", "x"), ("d1", "z"), ("d3", "y"), ("d3", "y"))
    ]
    df = clicks(spark, rows).withColumn("map", F.create_map(F.lit("k"), F.col("event")))
    shown = []
    for layout in ("user", "ticks", "auto"):
        for frame in (df, df.orderBy(F.desc("device_family"), F.desc("event"))):
            spec = cs.SessionSpec(mode="strict", layout=layout, max_group_rows=1)
            got = cs.sessionize(frame, spec).collect()
            shown.append(sorted((r.device_family, r.event, r.session_id, r.same_section) for r in got))
    assert all(s == shown[0] for s in shown)


def test_one_session_of_a_scope(spark):
    spec = cs.SessionSpec(mode="strict", scope=("file",))
    df = clicks(spark, [click("u", "d", "o", "b", T0 + k * MINUTE, k) for k in range(3)])
    df = df.withColumn("file", F.when(F.col("n") < 2, "a"))
    found = cs.sessionize(df, spec)
    assert cs.one_session(found, "session_1_u").count() == 3
    assert {r.n for r in cs.one_session(found, "session_1_u", file="a").collect()} == {0, 1}
    assert {r.n for r in cs.one_session(found, "session_1_u", file=None).collect()} == {2}


def test_lists_of_gaps_come_in_portions(spark):
    at = [T0 + ms for ms in (0, 5, 105, 400, 401, 1_400)]
    df = clicks(spark, [click(None, "d", "o", "b", t, n) for n, t in enumerate(at)])
    lists = cs.gap_list_by_session(cs.sessionize(df), portion_ms=100).collect()
    got = {r.portion: r.deltas for r in lists}
    assert got == {0: [0.0, 0.001, 0.005], 1: [0.1], 2: [0.295], 9: [0.999]}
    assert [tuple(r) for r in cs.median_distinct_gap_by_session(cs.sessionize(df)).collect()] == [
        (None, pytest.approx(0.05))
    ]


def test_a_list_of_gaps_is_whole(spark, tmp_path):
    """One row and one list per session, however far apart its gaps are."""
    from clickspark.plans.catalog import catalog

    hours = (0, 1, 3, 6, 6)
    rows = [(k, dt.datetime(2024, 1, 1, h), 1, "e", 1.0, None) for k, h in enumerate(hours)]
    rows += [(5, dt.datetime(2024, 1, 1), None, "e", 1.0, None), (6, dt.datetime(2024, 1, 1, 2), None, "e", 1.0, None)]
    spark.createDataFrame(rows, EVENTS_SCHEMA).write.parquet(str(tmp_path / "events.parquet"))
    got = catalog()["gap_list_by_session"](spark, str(tmp_path))
    assert got.columns == ["session_id", "deltas_ms"]
    assert sorted(map(tuple, got.collect()), key=str) == [
        ("session_1_1", "0,3600000,7200000,10800000"), (None, "0,7200000"),
    ]


def test_files_without_events_have_no_sessions(spark, tmp_path):
    line = '{"anonymous_id":"u","device_sent_timestamp":1577836800000}\n'
    names = {"a/x.gz": line, "b/x.gz": "", "b/blank line.json": "\n", "b/ä%20.json": line, "b/none": ""}
    for name, text in names.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        write = gzip.open if name.endswith("gz") else open
        with write(tmp_path / name, "wt") as out:
            out.write(text)
    source = [str(tmp_path / "a"), str(tmp_path / "b")]
    by_path = {r.file: r.qtd_session for r in cs.run(spark, source)[0].collect()}
    assert len(by_path) == 5 and sum(by_path.values()) == 2
    assert [n for f, n in sorted(by_path.items()) if f.endswith("x.gz")] == [1, 0]
    short = {r.file: r.qtd_session for r in cs.run(spark, source, full_path=False)[0].collect()}
    assert sorted(short.values()) == [0, 0, 1, 1] and short["x.gz"] == 1

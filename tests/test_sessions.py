"""The sessionizer on the hand fixture, and its two layouts against each other
and against a plain loop."""

import random
from collections import Counter

import pytest
from conftest import HAND, MINUTE, SPEC, T0, click, clicks
from pyspark.sql import functions as F

from clickspark import session_gaps, session_smoke, session_starts, sessionize
from clickspark.operators.layout import by_size, fingerprint

LAYOUTS = [
    SPEC.with_(layout="user"),
    SPEC.with_(layout="ticks"),
    SPEC.with_(layout="ticks", block_ms=7 * MINUTE),
]


@pytest.mark.parametrize("spec", LAYOUTS, ids=["user", "ticks", "wide"])
@pytest.mark.parametrize("mode", ["compat", "strict"])
def test_hand_fixture(hand, spec, mode):
    found = sessionize(hand, spec.with_(mode=mode)).orderBy("n").collect()
    ids = [row[-2] if mode == "compat" else row[-1] for row in HAND]
    assert [r.same_section for r in found] == [row[5] for row in HAND]
    assert [r.delta_seg for r in found] == [row[6] for row in HAND]
    assert [r.session_id for r in found] == ids
    assert {*hand.columns} < {*found[0].asDict()}
    assert found[0].event_time.year == 2020


@pytest.mark.parametrize("spec", LAYOUTS[:2], ids=["user", "ticks"])
def test_raw_gaps(hand, spec):
    found = {r.n: r for r in session_gaps(hand, spec).collect()}
    assert found[1].lag is None and found[1].delta_seg is None
    assert found[5].delta_seg == 1800.0 and not found[5].same_section
    assert found[4].lag == T0 + 5 * MINUTE


def test_smoke_shows_tags_on_start_rows_only(hand):
    found = {r.n: r.partial_session for r in session_smoke(hand).collect()}
    assert [found[n] for n in (1, 2, 3, 5)] == ["session_1", None, "session_2", "session_3"]
    assert found[11] == "session_1"


def random_rows(seed, copies=True, unique_ts=False, nulls=True, size=400):
    """Clicks with close and far gaps, ties, exact copies and one heavy user."""
    rng = random.Random(seed)
    users = ["u1", "u2", None] if nulls else ["u1", "u2", "u3"]
    rows, at = [], T0
    for n in range(size):
        if unique_ts or rng.random() < 0.7:
            at += rng.choice([1, 500, MINUTE, 5 * MINUTE, 11 * MINUTE, 30 * MINUTE])
        user = "u1" if rng.random() < 0.5 else rng.choice(users)
        device = rng.choice(["a", "b", None, ""])
        row = click(user, device, rng.choice(["x", None]), "c", at, n, rng.choice("ef"))
        rows += [row] * (rng.choice([1, 1, 1, 5]) if copies else 1)
    rng.shuffle(rows)
    return rows


def by_loop(rows, mode, gap):
    """Session of every event, by walking through them one user after another.
    Meant for rows without exact copies."""
    out, per_user = {}, {}
    for row in rows:
        per_user.setdefault(row[0], []).append(row)
    for user, events in per_user.items():
        events.sort(key=lambda r: (r[3], r[5]))
        last, own, number = {}, {}, 0
        marks = []
        for r in events:
            key = (r[2], r[6], r[1])
            same = key in last and r[3] - last[key] < gap
            delta = (r[3] - last[key]) / 1000 if same else 0.0
            if not same:
                number += 1
                own[key] = number
            last[key] = r[3]
            marks.append((r, same, delta, own[key], number))
        at_moment = {}
        for r, _, _, _, count in marks:
            at_moment[r[3]] = count
        for r, same, delta, mine, _ in marks:
            number = mine if mode == "strict" else at_moment[r[3]]
            out[r[5]] = (same, delta, None if user is None else f"session_{number}_{user}")
    return out


@pytest.mark.parametrize("mode", ["compat", "strict"])
@pytest.mark.parametrize("layout", ["user", "ticks"])
@pytest.mark.parametrize("seed", [1, 2])
def test_layouts_match_a_plain_loop(spark, mode, layout, seed):
    rows = random_rows(seed, copies=False)
    spec = SPEC.with_(mode=mode, layout=layout)
    found = sessionize(clicks(spark, rows), spec).collect()
    got = {r.n: (r.same_section, r.delta_seg, r.session_id) for r in found}
    assert len(found) == len(rows)
    assert got == by_loop(rows, mode, spec.gap_ms)


@pytest.mark.parametrize("mode", ["compat", "strict"])
def test_exact_copies_are_kept_and_only_one_starts(spark, mode):
    df = clicks(spark, random_rows(3)).cache()
    spec = SPEC.with_(mode=mode)
    found = [
        Counter(map(tuple, sessionize(df, spec.with_(layout=layout)).select(*cols).collect()))
        for layout in ("user", "ticks")
        for cols in [[*df.columns, "same_section", "delta_seg", "session_id"]]
    ]
    assert found[0] == found[1]
    assert sum(found[0].values()) == df.count()


def test_copies_spread_over_portions(spark, monkeypatch):
    """One event copied many times: given back whole, in more than one portion."""
    monkeypatch.setattr("clickspark.operators.layout.ROWS_PER_PORTION", 7)
    df = clicks(spark, [click("u", "d", "o", "b", T0, 1)] * 100)
    found = sessionize(df, SPEC.with_(layout="ticks"))
    assert found.count() == 100
    assert found.where(~F.col("same_section")).count() == 1
    assert {r.session_id for r in found.collect()} == {"session_1_u"}


def test_input_order_does_not_matter(spark):
    rows = random_rows(4)
    again = list(reversed(rows))
    for layout in ("user", "ticks"):
        spec = SPEC.with_(layout=layout)
        one, two = (
            Counter(map(tuple, sessionize(clicks(spark, r), spec).collect())) for r in (rows, again)
        )
        assert one == two


def test_scope_keeps_files_apart(spark):
    rows = [click("u", "d", "o", "b", T0 + i * MINUTE, i) for i in range(4)]
    df = clicks(spark, rows).withColumn(
        "file", F.when(F.col("n") < 2, "f1").otherwise("f2")
    )
    for layout in ("user", "ticks"):
        spec = SPEC.with_(scope=("file",), layout=layout)
        found = {r.n: r for r in sessionize(df, spec).collect()}
        assert [found[n].same_section for n in range(4)] == [False, True, False, True]
        assert {r.session_id for r in found.values()} == {"session_1_u"}
        assert session_starts(df, spec).agg(F.sum("starts")).first()[0] == 2
    assert session_starts(df, SPEC).agg(F.sum("starts")).first()[0] == 1


@pytest.mark.parametrize("layout", ["user", "ticks"])
def test_every_event_without_a_time_is_a_start(spark, layout):
    rows = [click("u", "d", "o", "b", None, n) for n in range(3)]
    rows += [click("u", "d", "o", "b", T0 + n, n) for n in range(3, 6)]
    df = clicks(spark, rows)
    found = {r.n: r for r in sessionize(df, SPEC.with_(layout=layout)).collect()}
    assert [found[n].same_section for n in range(6)] == [False] * 4 + [True] * 2
    assert [found[n].session_id for n in range(6)] == ["session_3_u"] * 3 + ["session_4_u"] * 3
    assert session_starts(df).agg(F.sum("starts")).first()[0] == 4


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_starts_by_aggregation_equal_start_rows(spark, seed):
    df = clicks(spark, random_rows(seed))
    columns = [*SPEC.keys, "ts"]
    by_rows = sessionize(df, SPEC.with_(layout="user")).where("not same_section")
    expected = Counter(
        map(tuple, by_rows.withColumnRenamed(SPEC.ts, "ts").select(*columns).collect())
    )
    got = session_starts(df).withColumnRenamed("start_ts", "ts").select(*columns, "starts")
    assert {r[:-1]: r[-1] for r in map(tuple, got.collect())} == dict(expected)


def test_clock_before_1970(spark):
    at = [-3_600_001, -1_800_001, -1_800_000, -2, 1]
    df = clicks(spark, [click("u", "d", "o", "b", t, n) for n, t in enumerate(at)])
    starts = sorted(r.start_ts for r in session_starts(df).collect())
    assert starts == [-3_600_001, -1_800_001]
    for layout in ("user", "ticks"):
        found = {r.n: r.same_section for r in sessionize(df, SPEC.with_(layout=layout)).collect()}
        assert found == {0: False, 1: False, 2: True, 3: True, 4: True}


def test_large_users_are_told_apart(hand):
    parts = lambda **changes: by_size(hand, SPEC.with_(**changes))
    users = lambda df: {r.anonymous_id for r in df.collect()}
    small, large = parts(max_group_rows=6)
    assert large is None and small.count() == 13
    small, large = parts(max_group_rows=5)
    assert users(large) == {"u1"} and small.count() == 7
    small, large = parts(max_group_rows=1)  # also events without a user
    assert users(large) == {"u1", "u2", None} and users(small) == {"u3"}
    small, large = parts(max_group_rows=1, max_listed_users=2)
    assert small is None and large.count() == 13


@pytest.mark.parametrize("mode", ["compat", "strict"])
def test_large_and_small_users_together(spark, mode):
    df = clicks(spark, random_rows(8)).cache()
    spec = SPEC.with_(mode=mode)
    whole, divided = (
        Counter(map(tuple, sessionize(df, s).select(*df.columns, "session_id").collect()))
        for s in (spec, spec.with_(max_group_rows=300))
    )
    assert whole == divided


def untimed_rows(seed):
    """Timed events, and a third without a time: copies, missing tiebreaks, a heavy user."""
    rng, rows = random.Random(seed), random_rows(seed, size=120)
    for n in range(60):
        user = "u1" if n % 2 else rng.choice(["u2", None])
        tie = rng.choice([None, 1, 2, 3, n])
        row = click(user, rng.choice("ab"), "x", "c", None, tie, rng.choice("ef"))
        rows += [row] * rng.choice([1, 1, 4])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("mode", ["compat", "strict"])
@pytest.mark.parametrize("seed", [31, 32])
def test_layouts_agree_on_events_without_a_time(spark, mode, seed, monkeypatch):
    monkeypatch.setattr("clickspark.operators.layout.ROWS_PER_PORTION", 2)
    df = clicks(spark, untimed_rows(seed)).withColumn("M", F.create_map(F.lit("k"), "event"))
    df = df.drop("event").cache()
    shown = [*[c for c in df.columns if c != "M"], F.col("M")["k"], "same_section", "delta_seg", "session_id"]
    first, *others = (
        Counter(map(tuple, sessionize(df, SPEC.with_(mode=mode, **layout)).select(*shown).collect()))
        for layout in ({"layout": "user"}, {"layout": "ticks"}, {"max_group_rows": 1}, {"max_group_rows": 60})
    )
    assert sum(first.values()) == df.count()
    assert all(first == other for other in others)
    if mode == "strict":
        at = df.columns.index(SPEC.ts)
        ids = [k[-1] for k in first.elements() if k[at] is None and k[0] is not None]
        assert len(ids) == len(set(ids))


def test_maps_in_another_order_are_the_same(spark):
    both = spark.sql("select map('a', 1, 'b', 2) as m, 1 as x union all select map('b', 2, 'a', 1), 1")
    assert both.select(fingerprint(both, SPEC)).distinct().count() == 1


def test_settings_are_checked():
    for wrong in ({"mode": "x"}, {"layout": "x"}, {"gap_ms": 0}, {"block_ms": 0}):
        with pytest.raises(ValueError):
            SPEC.with_(**wrong)

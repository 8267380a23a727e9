"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import SPEC, clicks
from pyspark.sql import functions as F
from test_sessions import random_rows

import clickspark as cs

USER = SPEC.with_(layout="user")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "clicks")
    clicks(spark, random_rows(21)).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """Shuffles of a plan, without the one into a single partition of a total."""
    return re.findall(r"Exchange (\w+partitioning)", plan(df))


@pytest.mark.parametrize("mode", ["compat", "strict"])
def test_one_shuffle_serves_all_windows(stored, mode):
    found = cs.sessionize(stored, USER.with_(mode=mode))
    assert exchanges(found) == ["hashpartitioning"]


def test_smoke_and_gaps_take_one_shuffle(stored):
    assert exchanges(cs.session_gaps(stored, USER)) == ["hashpartitioning"]
    assert exchanges(cs.session_smoke(stored, USER)) == ["hashpartitioning"]


def test_counts_need_no_window_and_combine_first(stored):
    found = plan(cs.sessions_by_dim(cs.session_starts(stored)))
    assert "Window" not in found and "Sort " not in found
    assert found.count("Exchange hashpartitioning") == 2
    assert "partial_min" in found and "partial_max" in found


def test_questions_do_not_sort_globally(stored):
    for df in (
        cs.sessions_by_dim(cs.starts_of(cs.sessionize(stored, USER))),
        cs.median_gap_by_dim(stored, USER),
        cs.median_gap_by_dim(stored, USER, exact=True),
        cs.session_durations(cs.sessionize(stored, USER)),
    ):
        assert "rangepartitioning" not in plan(df)


def test_dimensions_are_sessionized_once(stored):
    found = plan(cs.sessions_by_dim(cs.starts_of(cs.sessionize(stored, USER))))
    assert found.count("FileScan") == 1 and found.count("Window [") == 1


def test_exact_median_measures_gaps_once(stored):
    df = cs.median_gap_by_dim(stored, USER, exact=True)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
    assert final.count("Window [lag(") == 1


def test_only_needed_columns_are_read(stored):
    scan = r"FileScan parquet \[([^\]]*)\]"
    read = lambda df: set(re.findall(r"(\w+)#", re.search(scan, plan(df))[1]))
    keys = {"anonymous_id", "browser_family", "device_family", "os_family"}
    assert read(cs.sessions_by_dim(cs.session_starts(stored))) == {*keys, SPEC.ts}
    assert read(cs.median_gap_by_dim(stored, USER)) == {*keys, SPEC.ts}
    assert read(cs.top_users(stored)) == {"anonymous_id"}


def test_only_keys_time_and_a_hash_are_shuffled(stored):
    """What is not asked for is hashed to settle ties, and does not travel."""
    for df in (
        cs.sessionize(stored, USER).select("session_id"),
        cs.sessionize(stored, USER.with_(mode="strict")).select("session_id"),
        cs.session_gaps(stored, USER).select("delta_seg"),
    ):
        below = re.search(r"Exchange hashpartitioning.*?\n[^\n]*Project \[(.*?)\]\n", plan(df), re.S)[1]
        travels = set(re.findall(r"(\w+)#", re.sub(r"xxhash64\(.*\) AS ", "", below)))
        assert travels <= {*SPEC.keys, SPEC.ts, "n", "__print"}


def test_user_filter_reaches_the_scan_through_the_windows(stored):
    for df in (stored, cs.sessionize(stored, USER), cs.session_starts(stored)):
        if "start_ts" in df.columns:
            found = plan(df.where(F.col("anonymous_id") == "u1"))
        else:
            found = plan(cs.user_timeline(df, "u1"))
        assert "EqualTo(anonymous_id,u1)" in found


def test_top_users_keeps_the_best_of_each_task(stored):
    assert "TakeOrderedAndProject" in plan(cs.top_users(stored))


def test_ticks_join_on_keys_so_skew_can_be_split(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = plan(cs.sessionize(stored, SPEC.with_(layout="ticks")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in found
    assert "NestedLoop" not in found and "Cartesian" not in found
    assert "Window" not in found  # windows ran on ticks, before this plan


def test_only_listed_users_are_broadcast(stored):
    found = plan(cs.sessionize(stored, SPEC.with_(max_group_rows=300)))
    assert "LeftAnti" in found and "LeftSemi" in found

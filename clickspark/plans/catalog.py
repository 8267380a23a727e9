"""The operators as named queries over the sample tables.

Every query reads the whole ``events`` table. The half-hour limit leaves few
events that continue a session there, so most queries use six hours.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickspark.functions.columns import label, slot_start
from clickspark.operators import explore, folds, medians, metrics, sessions
from clickspark.operators.starts import session_starts
from clickspark.plans.questions import answer_questions, run
from clickspark.schema import CLICK_SCHEMA, FILE_COLUMN, SessionSpec
from clickspark.sources.clicks import read_clicks, read_saved, stream_clicks
from clickspark.sources.events import (
    event_clicks,
    replayed,
    stream_event_clicks,
    written_in_order,
)
from clickspark.sources.results import (
    nested_json,
    nested_json_by,
    save_events_json,
    write_question_files,
)
from clickspark.sources.shared import materialize, shared_path
from clickspark.streaming.event_time import read_aside, read_released, start_event_time
from clickspark.streaming.incremental import counts_of_batch, sketches_of_batch
from clickspark.streaming.ledger import read_sessions, start_sessionizing
from clickspark.streaming.sinks import (
    compact,
    read_batches,
    read_quarantine,
    read_results,
    run_available,
    start_batches,
    start_quarantined,
)
from clickspark.streaming.windows import all_windows, stream_session_windows

Query = Callable[[SparkSession, str], DataFrame]

HALF_HOUR = SessionSpec()
SIX_HOURS = SessionSpec(gap_ms=6 * 60 * 60 * 1000)
STRICT = SIX_HOURS.with_(mode="strict")
PER_FILE = SIX_HOURS.with_(scope=(FILE_COLUMN,))
# The layout for data in which a user is too large for one task.
IN_TICKS = SIX_HOURS.with_(layout="ticks", block_ms=24 * 60 * 60 * 1000)

_CATALOG: dict[str, Query] = {}


def _query(function: Callable[[SparkSession, DataFrame, str], DataFrame], name: str = ""):
    """Register ``function(spark, clicks, sf_dir)`` under its own name."""

    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, event_clicks(spark, sf_dir), sf_dir)

    _CATALOG[name or function.__name__] = call
    return function


def catalog() -> dict[str, Query]:
    return dict(_CATALOG)


def _shown(df: DataFrame) -> DataFrame:
    """Times as text, so that results compare the same on every engine."""
    return df.withColumn(
        "event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSS")
    )


def _click_files(spark: SparkSession, clicks: DataFrame) -> str:
    """Clicks as gzipped JSON, several files a day, a user's day in one of them."""
    path = shared_path(spark, "click-files")
    names = [f for f in CLICK_SCHEMA.fieldNames() if f in clicks.columns]
    (
        clicks.select(*names, F.col(FILE_COLUMN).alias("day"))
        .repartition("day", "anonymous_id")
        .write.partitionBy("day")
        .option("compression", "gzip")
        .json(path)
    )
    return path


def _starts(clicks: DataFrame, spec: SessionSpec = SIX_HOURS) -> DataFrame:
    return session_starts(clicks, spec)


# Scans and sinks


@_query
def event_count(spark, clicks, sf_dir):
    return explore.event_count(clicks)


@_query
def json_round_trip(spark, clicks, sf_dir):
    """Gaps saved as JSON and read back with inferred types, then sessions
    counted on what was read."""
    path = shared_path(spark, "gaps-json")
    save_events_json(sessions.session_gaps(clicks, SIX_HOURS), path)
    back = read_saved(spark, path)
    return back.groupBy("same_section").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.round(F.col("delta_seg") * 1000).cast("long")).alias("gap_ms"),
    )


@_query
def application_run(spark, clicks, sf_dir):
    """The application on gzipped JSON files, read as one stretch of time: sessions in
    all, sessions per dimension value and median gaps."""
    path = _click_files(spark, clicks)
    whole, by_dim, gaps = run(spark, path, SIX_HOURS, by_file=False, median="exact")
    whole = whole.select(F.lit("all").alias("what"), F.col(FILE_COLUMN).alias("ref"), "qtd_session")
    return whole.unionByName(by_dim).join(gaps, ["what", "ref"], "left")


@_query
def application_run_per_file(spark, clicks, sf_dir):
    """The application with each file by itself: sessions per day of files, of a day
    without events too."""
    path = _click_files(spark, clicks)
    # A file with a line but no event in it.
    spark.createDataFrame([("",)], "value string").write.text(f"{path}/day=2000-01-01")
    per_file, _, _ = run(spark, path, SIX_HOURS, full_path=True)
    day = F.regexp_extract(FILE_COLUMN, "day=([0-9-]+)/", 1)
    return per_file.groupBy(day.alias("day")).agg(
        F.sum("qtd_session").alias("qtd_session")
    )


@_query
def result_json(spark, clicks, sf_dir):
    """The answer on dimensions, one JSON object each."""
    counts = metrics.sessions_by_dim(_starts(clicks), SIX_HOURS)
    return nested_json_by(counts, "qtd_session")


@_query
def result_json_document(spark, clicks, sf_dir):
    counts = metrics.sessions_by_dim(_starts(clicks), SIX_HOURS)
    return nested_json(counts, "qtd_session")


@_query
def sessions_per_file_json(spark, clicks, sf_dir):
    counts = metrics.sessions_per_file(_starts(clicks, PER_FILE), PER_FILE)
    return nested_json(counts, "qtd_session", None, FILE_COLUMN)


@_query
def question_files(spark, clicks, sf_dir):
    """The application's three documents, written and read back."""
    path = shared_path(spark, "question-files")
    write_question_files(answer_questions(clicks, PER_FILE, "exact"), path)
    docs = [
        spark.read.text(f"{path}/question{number}.json").select(
            F.lit(number).alias("question"), F.col("value").alias("json")
        )
        for number in (1, 2, 3)
    ]
    return docs[0].unionByName(docs[1]).unionByName(docs[2])


@_query
def clickstream_in_order(spark, clicks, sf_dir):
    return _shown(explore.in_display_order(sessions.sessionize(clicks, SIX_HOURS)))


# Sessionizing


def _register_gaps(name: str, spec: SessionSpec) -> None:
    # Whole numbers with nulls are shown as doubles, for the same reason as times.
    _query(
        lambda spark, clicks, sf_dir: _shown(sessions.session_gaps(clicks, spec)).withColumn(
            "lag", F.col("lag").cast("double")
        ),
        name,
    )


_register_gaps("session_gaps", HALF_HOUR)
_register_gaps("session_gaps_6h", SIX_HOURS)
_register_gaps("session_gaps_ticks", IN_TICKS)


def _register_sessionize(name: str, spec: SessionSpec) -> None:
    _query(lambda spark, clicks, sf_dir: _shown(sessions.sessionize(clicks, spec)), name)


_register_sessionize("sessionize_compat", HALF_HOUR)
_register_sessionize("sessionize_compat_6h", SIX_HOURS)
_register_sessionize("sessionize_compat_ticks", IN_TICKS)
_register_sessionize("sessionize_compat_per_file", PER_FILE)
_register_sessionize("sessionize_strict", STRICT)
_register_sessionize("sessionize_strict_ticks", IN_TICKS.with_(mode="strict"))


@_query
def session_smoke(spark, clicks, sf_dir):
    return _shown(sessions.session_smoke(clicks, SIX_HOURS))


def _register_starts(name: str, spec: SessionSpec) -> None:
    _query(lambda spark, clicks, sf_dir: session_starts(clicks, spec), name)


_register_starts("session_starts", HALF_HOUR)
_register_starts("session_starts_6h", SIX_HOURS)


@_query
def session_start_rows(spark, clicks, sf_dir):
    started = metrics.starts_of(sessions.sessionize(clicks, SIX_HOURS))
    return started.select("anonymous_id", "device_sent_timestamp", "session_id")


# Questions 1 and 2


@_query
def sessions_total(spark, clicks, sf_dir):
    return metrics.sessions_total(_starts(clicks), SIX_HOURS)


@_query
def sessions_per_file(spark, clicks, sf_dir):
    return metrics.sessions_per_file(_starts(clicks, PER_FILE), PER_FILE)


def _register_by(name: str, dim: str) -> None:
    _query(
        lambda spark, clicks, sf_dir: metrics.sessions_by(_starts(clicks), dim, SIX_HOURS),
        name,
    )


_register_by("sessions_by_browser", "browser_family")
_register_by("sessions_by_os", "os_family")
_register_by("sessions_by_device", "device_family")


@_query
def sessions_by_dim(spark, clicks, sf_dir):
    return metrics.sessions_by_dim(_starts(clicks, HALF_HOUR), HALF_HOUR)


@_query
def sessions_by_dim_6h(spark, clicks, sf_dir):
    return metrics.sessions_by_dim(_starts(clicks), SIX_HOURS)


@_query
def sessions_by_dim_from_events(spark, clicks, sf_dir):
    """The same on sessionized events."""
    started = metrics.starts_of(sessions.sessionize(clicks, SIX_HOURS))
    return metrics.sessions_by_dim(started, SIX_HOURS)


@_query
def fold_counts(spark, clicks, sf_dir):
    parts = metrics.sessions_by_dim(_starts(clicks, PER_FILE), PER_FILE, by=(FILE_COLUMN,))
    return folds.fold_counts(parts)


# Question 3 and other medians


@_query
def median_gap_by_dim(spark, clicks, sf_dir):
    return medians.median_gap_by_dim(clicks, SIX_HOURS)


@_query
def median_gap_by_dim_30m(spark, clicks, sf_dir):
    return medians.median_gap_by_dim(clicks, HALF_HOUR)


@_query
def median_gap_exact(spark, clicks, sf_dir):
    return medians.median_gap_by_dim(clicks, SIX_HOURS, exact=True)


@_query
def median_gap_between(spark, clicks, sf_dir):
    return medians.median_gap_by_dim(clicks, SIX_HOURS, between=True)


@_query
def median_gap_ticks(spark, clicks, sf_dir):
    return medians.median_gap_by_dim(clicks, IN_TICKS)


@_query
def median_gap_per_file(spark, clicks, sf_dir):
    return medians.median_gap_by_dim(clicks, PER_FILE, by=(FILE_COLUMN,))


@_query
def fold_median_compat(spark, clicks, sf_dir):
    parts = medians.median_gap_by_dim(clicks, PER_FILE, by=(FILE_COLUMN,))
    return folds.fold_median_compat(parts)


@_query
def median_kll(spark, clicks, sf_dir):
    gaps = medians.continuation_gaps(clicks, PER_FILE)
    return folds.merge_sketches(folds.sketch_gaps(gaps, PER_FILE))


@_query
def approx_quantile_gap(spark, clicks, sf_dir):
    """The ranks that the approximate quantile is proven to lie between. The value
    itself may be any of those, and is left out here."""
    found = medians.approx_quantile_gap(clicks, SIX_HOURS)
    return found.select("gaps", "rank_from", "rank_to", "proven")


@_query
def median_gap_by_session(spark, clicks, sf_dir):
    return medians.median_gap_by_session(sessions.sessionize(clicks, SIX_HOURS))


@_query
def median_gap_rounded(spark, clicks, sf_dir):
    return medians.median_distinct_gap_by_session(sessions.sessionize(clicks, SIX_HOURS))


@_query
def half_event_count(spark, clicks, sf_dir):
    return metrics.half_event_count(sessions.sessionize(clicks, SIX_HOURS))


@_query
def session_durations(spark, clicks, sf_dir):
    return medians.session_durations(sessions.sessionize(clicks, STRICT), STRICT)


@_query
def median_session_duration_by_dim(spark, clicks, sf_dir):
    return medians.median_session_duration_by_dim(
        sessions.sessionize(clicks, STRICT), STRICT, exact=True
    )


# Looking at events and sessions


@_query
def top_users(spark, clicks, sf_dir):
    return explore.top_users(clicks, 10)


@_query
def user_timeline(spark, clicks, sf_dir):
    """One user by id, which a first query finds."""
    user = explore.top_users(clicks, 1).first()["anonymous_id"]
    return explore.user_timeline(clicks, user)


@_query
def busiest_user_timeline(spark, clicks, sf_dir):
    return explore.busiest_user_timeline(clicks)


@_query
def one_session(spark, clicks, sf_dir):
    """One session by id, which a first query finds."""
    found = sessions.sessionize(clicks, SIX_HOURS)
    session = explore.busiest_session(found).first()["session_id"]
    return _shown(explore.one_session(found, session))


@_query
def busiest_session(spark, clicks, sf_dir):
    found = explore.busiest_session(sessions.sessionize(clicks, SIX_HOURS))
    return _shown(found)


@_query
def half_event_count_per_file(spark, clicks, sf_dir):
    return metrics.half_event_count(sessions.sessionize(clicks, PER_FILE), PER_FILE)


@_query
def distinct_gaps_per_file(spark, clicks, sf_dir):
    return explore.distinct_gaps(sessions.sessionize(clicks, PER_FILE), PER_FILE)


@_query
def mixed_json_numbers(spark, clicks, sf_dir):
    """Clicks written as JSON in three number forms, a broken line for each
    event that has none, read back: sessions and broken lines."""
    ts = F.col("device_sent_timestamp")
    form = F.pmod(F.xxhash64("anonymous_id", ts), F.lit(4))
    number = (
        F.when(form == 0, ts.cast("string"))
        .when(form == 1, F.concat(ts.cast("string"), F.lit(".0")))
        .otherwise(F.concat(F.lit('"'), ts.cast("string"), F.lit('"')))
    )
    names = [c for c in CLICK_SCHEMA.fieldNames() if c in clicks.columns and c != SIX_HOURS.ts]
    rest = F.substr(F.to_json(F.struct(*names)), F.lit(2))
    line = F.concat(F.lit('{"device_sent_timestamp":'), number, F.lit(","), rest)
    path = shared_path(spark, "mixed-json")
    lines = clicks.select(F.explode(F.array(line, F.lit('{"broken'))).alias("value"))
    lines.write.text(path)
    read = materialize(read_clicks(spark, path, by_file=False, corrupt="bad"), "mixed-read")
    bad = read.where("bad is not null").agg(F.count(F.lit(1)).alias("bad_lines"))
    total = metrics.sessions_total(_starts(read.where("bad is null").drop("bad")), SIX_HOURS)
    return total.withColumn("bad_lines", bad.scalar())


@_query
def distinct_gaps(spark, clicks, sf_dir):
    return explore.distinct_gaps(sessions.sessionize(clicks, SIX_HOURS))


@_query
def gap_list_by_session(spark, clicks, sf_dir):
    lists = explore.gap_list_by_session(sessions.sessionize(clicks, SIX_HOURS))
    as_ms = F.transform("deltas", lambda d: F.round(d * 1000).cast("long").cast("string"))
    return lists.select("session_id", F.array_join(as_ms, ",").alias("deltas_ms"))


@_query
def file_values(spark, clicks, sf_dir):
    """Events per file, the identity of the input kept as a column."""
    return clicks.groupBy(FILE_COLUMN).agg(F.count(F.lit(1)).alias("events"))


# The application's three answers


def _register_answer(name: str, index: int, median: str) -> None:
    _query(
        lambda spark, clicks, sf_dir: answer_questions(clicks, PER_FILE, median)[index],
        name,
    )


_register_answer("answer_1", 0, "all")
_register_answer("answer_2", 1, "all")
_register_answer("answer_3", 2, "exact")
_register_answer("answer_3_fold", 2, "fold")


# Streams


HOUR_MS = 60 * 60 * 1000
DAY_MS = 24 * HOUR_MS


def _by_day(clicks: DataFrame) -> DataFrame:
    """The days, which stand for files, as they arrive: several a batch, each in one."""
    return replayed(clicks, slot_start(F.col(SIX_HOURS.ts), DAY_MS), 3)


def _disordered(clicks: DataFrame) -> DataFrame:
    """Clicks as they arrive up to 36 hours after their time, every eleventh six days."""
    delay = F.when(F.col("n") % 11 == 0, 6 * DAY_MS).otherwise(F.col("n") % 7 * 6 * HOUR_MS)
    return replayed(clicks, F.col(SIX_HOURS.ts) + delay, 4)


@_query
def stream_counts(spark, clicks, sf_dir):
    parts = run_available(spark, _by_day(clicks), "stream-counts", counts_of_batch(PER_FILE))
    return folds.fold_counts(parts)


@_query
def stream_median(spark, clicks, sf_dir):
    sketches = sketches_of_batch(PER_FILE)
    parts = run_available(spark, _by_day(clicks), "stream-sketches", sketches)
    return folds.merge_sketches(parts)


@_query
def stream_counts_compacted(spark, clicks, sf_dir):
    """The counts after all batches but the last are merged into one part."""
    base = shared_path(spark, "stream-compacted")
    query = start_batches(
        _by_day(clicks), f"{base}/out", f"{base}/checkpoint", counts_of_batch(PER_FILE)
    )
    query.awaitTermination()
    compact(spark, f"{base}/out", keep=1)
    return folds.fold_counts(read_batches(spark, f"{base}/out"))


@_query
def stream_quarantine(spark, clicks, sf_dir):
    """JSON lines in several files, a broken one for every fifth event: sessions of the
    good lines, and the broken lines of each batch."""
    names = [c for c in CLICK_SCHEMA.fieldNames() if c in clicks.columns]
    good = F.to_json(F.struct(*names))
    # A line may end in the middle of any value.
    broken = F.when(F.col("n") % 5 == 0, F.concat(F.lit('{"n":'), F.col("n").cast("string")))
    lines = clicks.select(F.col(SIX_HOURS.ts), F.explode(F.array(good, broken)).alias("value"))
    lines = lines.where("value is not null")
    kept = lines.select("value", F.col(SIX_HOURS.ts).alias("at"))
    path = written_in_order(kept, F.col("at"), 3, "text", ["value"])
    stream = stream_clicks(spark, path, corrupt="line")
    base = shared_path(spark, "stream-quarantine")
    start_quarantined(stream, f"{base}/out", f"{base}/checkpoint", "line").awaitTermination()
    sessions_of = _starts(read_results(spark, f"{base}/out").drop(FILE_COLUMN))
    bad = read_quarantine(spark, f"{base}/out", ["line", FILE_COLUMN])
    bad = bad.groupBy("batch").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.substring("line", 6, 20).cast("long")).alias("of"),
    )
    total = metrics.sessions_total(sessions_of, SIX_HOURS)
    counted = total.select(F.lit("sessions").alias("kind"), F.lit(0).cast("long").alias("of"), "qtd_session")
    shown = bad.select(
        F.concat(F.lit("broken in "), F.col("batch").cast("string")).alias("kind"), "of",
        F.col("rows").alias("qtd_session"),
    )
    return counted.unionByName(shown)


@_query
def stream_session_window(spark, clicks, sf_dir):
    """Sessions as they end, and those that are open at the end of the stream."""
    base = shared_path(spark, "stream-windows")
    windows = stream_session_windows(_disordered(clicks), SIX_HOURS, "8 days")
    start_batches(windows, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return all_windows(spark, f"{base}/out", f"{base}/checkpoint", SIX_HOURS)


def _in_event_time(spark: SparkSession, clicks: DataFrame, spec: SessionSpec) -> str:
    base = shared_path(spark, "stream-event-time")
    start_event_time(
        _disordered(clicks), f"{base}/out", f"{base}/checkpoint", spec, "2 days", DAY_MS, parts=4
    ).awaitTermination()
    return f"{base}/out"


@_query
def stream_session_ids(spark, clicks, sf_dir):
    """Sessions of events that the watermark has passed, from a stream out of order."""
    return _shown(read_released(spark, _in_event_time(spark, clicks, STRICT)))


@_query
def stream_session_ids_compat(spark, clicks, sf_dir):
    return _shown(read_released(spark, _in_event_time(spark, clicks, SIX_HOURS)))


@_query
def stream_late_rows(spark, clicks, sf_dir):
    """Events that came after the watermark had passed their time, and with which batch."""
    aside = read_aside(spark, _in_event_time(spark, clicks, STRICT))
    return aside.withColumn("batch", F.col("batch").cast("long"))


@_query
def stream_session_ledger(spark, clicks, sf_dir):
    base = shared_path(spark, "stream-ledger")
    query = start_sessionizing(
        stream_event_clicks(spark, sf_dir), f"{base}/out", f"{base}/checkpoint", STRICT
    )
    query.awaitTermination()
    return _shown(read_sessions(spark, f"{base}/out"))


@_query
def labelled_devices(spark, clicks, sf_dir):
    """Device values as they are reported."""
    return clicks.groupBy(label(F.col("device_family")).alias("ref")).agg(
        F.count(F.lit(1)).alias("events")
    )

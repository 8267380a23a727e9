"""Clickstream sessionization and session analytics on Spark DataFrames."""

from clickspark.operators.folds import (
    fold_counts,
    fold_median_compat,
    merge_sketches,
    sketch_gaps,
)
from clickspark.operators.explore import (
    busiest_session,
    busiest_user_timeline,
    distinct_gaps,
    event_count,
    gap_list_by_session,
    in_display_order,
    one_session,
    top_users,
    user_timeline,
)
from clickspark.operators.medians import (
    approx_quantile_gap,
    median_distinct_gap_by_session,
    median_gap_by_dim,
    median_gap_by_session,
    median_session_duration_by_dim,
    session_durations,
)
from clickspark.operators.metrics import (
    half_event_count,
    sessions_by,
    sessions_by_dim,
    sessions_per_file,
    sessions_total,
    starts_of,
)
from clickspark.operators.sessions import session_gaps, session_smoke, sessionize
from clickspark.operators.starts import session_starts
from clickspark.plans.questions import answer_questions, run
from clickspark.schema import CLICK_SCHEMA, GAP_MS, NOT_IDENTIFIED, SessionSpec
from clickspark.sources.clicks import read_clicks, read_saved
from clickspark.sources.results import (
    nested_json,
    save_events_json,
    write_question_files,
    write_result_json,
)

__all__ = [
    "CLICK_SCHEMA",
    "GAP_MS",
    "NOT_IDENTIFIED",
    "SessionSpec",
    "answer_questions",
    "approx_quantile_gap",
    "busiest_session",
    "busiest_user_timeline",
    "distinct_gaps",
    "event_count",
    "fold_counts",
    "fold_median_compat",
    "gap_list_by_session",
    "half_event_count",
    "in_display_order",
    "median_distinct_gap_by_session",
    "median_gap_by_dim",
    "median_gap_by_session",
    "median_session_duration_by_dim",
    "merge_sketches",
    "nested_json",
    "one_session",
    "read_clicks",
    "read_saved",
    "run",
    "save_events_json",
    "session_durations",
    "session_gaps",
    "session_smoke",
    "session_starts",
    "sessionize",
    "sessions_by",
    "sessions_by_dim",
    "sessions_per_file",
    "sessions_total",
    "sketch_gaps",
    "starts_of",
    "top_users",
    "user_timeline",
    "write_question_files",
    "write_result_json",
]

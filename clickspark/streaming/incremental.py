"""Counts and medians kept up to date as files arrive.

A file is one scope and never divided between micro-batches, so inside a batch
the sessionizer is the batch one, and batches only ever add rows to the parts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from clickspark.operators.medians import continuation_gaps
from clickspark.operators.folds import sketch_gaps
from clickspark.operators.metrics import sessions_by_dim
from clickspark.operators.starts import session_starts
from clickspark.schema import FILE_COLUMN, SessionSpec

BY_FILE = SessionSpec(scope=(FILE_COLUMN,))


def counts_of_batch(spec: SessionSpec = BY_FILE) -> Callable[[DataFrame], DataFrame]:
    """For ``start_batches``: counts per file; total them with ``fold_counts``."""
    return lambda df: sessions_by_dim(session_starts(df, spec), spec, by=spec.scope)


def sketches_of_batch(spec: SessionSpec = BY_FILE) -> Callable[[DataFrame], DataFrame]:
    """For ``start_batches``: sketches per file; combine with ``merge_sketches``."""
    return lambda df: sketch_gaps(continuation_gaps(df, spec), spec, by=spec.scope)

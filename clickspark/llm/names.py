"""Names for columns that exist only within an operator."""

from __future__ import annotations


def unused(columns: list[str], *wanted: str) -> list[str]:
    """``wanted``, with as many underscores before them as keep them apart from
    ``columns`` (whose names Spark compares without case)."""
    taken = {c.lower() for c in columns}
    marks = "__"
    while any(f"{marks}{w}".lower() in taken for w in wanted):
        marks += "_"
    return [f"{marks}{w}" for w in wanted]

"""The click schema and the settings of a sessionization."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Fixed values of the workload: column names and types of a raw event, the
# inactivity limit, the label of a missing dimension value and the id prefix.
CLICK_SCHEMA = T.StructType(
    [
        T.StructField("anonymous_id", T.StringType()),
        T.StructField("browser_family", T.StringType()),
        T.StructField("device_family", T.StringType()),
        T.StructField("device_sent_timestamp", T.LongType()),
        T.StructField("event", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("os_family", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("version", T.StringType()),
    ]
)
DIMENSIONS = ("device_family", "os_family", "browser_family")
GAP_MS = 30 * 60 * 1000
NOT_IDENTIFIED = "Not Identified"
SESSION_PREFIX = "session_"

FILE_COLUMN = "file"


@dataclass(frozen=True)
class SessionSpec:
    """What a session is, and how its rows are laid out on the cluster.

    A session belongs to one ``user`` and one combination of ``dims``; it ends
    when the next event of that combination comes ``gap_ms`` or more later.

    ``scope``: further columns sessions never cross, such as the input file.
    ``tiebreak``: order of events of equal timestamp.
    ``mode``: ``"compat"`` gives every row the id of the session its user
    started last, on any device; ``"strict"`` the id of the session the row
    itself belongs to. Both number sessions per user, and agree on start rows.
    ``layout``: ``"user"`` places all rows of a user in one window group, with
    one shuffle. ``"ticks"`` bounds every group whatever the data, at the cost
    of more shuffles. ``"auto"`` takes ticks for users of more than
    ``max_group_rows`` events, and for all users should there be more than
    ``max_listed_users`` such. All give the same result.
    ``block_ms``: span of time one window group holds in the ticks layout.
    """

    user: str = "anonymous_id"
    dims: tuple[str, ...] = DIMENSIONS
    ts: str = "device_sent_timestamp"
    gap_ms: int = GAP_MS
    tiebreak: tuple[str, ...] = ("n",)
    scope: tuple[str, ...] = ()
    mode: str = "compat"
    layout: str = "auto"
    max_group_rows: int = 2_000_000
    max_listed_users: int = 100_000
    block_ms: int = 60_000

    def __post_init__(self) -> None:
        if self.mode not in ("compat", "strict"):
            raise ValueError(f"mode must be compat or strict, not {self.mode!r}")
        if self.layout not in ("auto", "user", "ticks"):
            raise ValueError(f"layout must be auto, user or ticks, not {self.layout!r}")
        if self.gap_ms <= 0 or self.block_ms <= 0:
            raise ValueError("gap_ms and block_ms must be positive")

    @property
    def owner(self) -> list[str]:
        """Columns that number sessions: the scope and the user."""
        return [*self.scope, self.user]

    @property
    def keys(self) -> list[str]:
        """Columns between whose rows gaps are measured."""
        return [*self.scope, self.user, *self.dims]

    def with_(self, **changes) -> SessionSpec:
        return replace(self, **changes)

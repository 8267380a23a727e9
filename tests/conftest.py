import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from clickspark.schema import CLICK_SCHEMA, SessionSpec  # noqa: E402
from clickspark.settings import spark_session  # noqa: E402

T0 = 1577836800000
MINUTE = 60_000
SPEC = SessionSpec()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = spark_session(
        "tests",
        "local[4]",
        2,
        **{
            "spark.ui.enabled": "false",
            # Tables of a few rows: compiling a plan takes longer than running it.
            "spark.sql.codegen.wholeStage": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def click(user, device, os, browser, ts, n, event="e"):
    return (user, browser, device, ts, event, n, os, "web", "1")


def clicks(spark, rows):
    return spark.createDataFrame(rows, CLICK_SCHEMA)


# User, device, os, browser, minutes (or ms) after T0, and what is expected:
# same_section, delta_seg, session id in compat mode, session id in strict mode.
HAND = [
    ("u1", "iPhone", "iOS", "Safari", 0, False, 0.0, "session_1_u1", "session_1_u1"),
    ("u1", "iPhone", "iOS", "Safari", 5, True, 300.0, "session_1_u1", "session_1_u1"),
    ("u1", "Spider", "Other", "Bot", 6, False, 0.0, "session_2_u1", "session_2_u1"),
    ("u1", "iPhone", "iOS", "Safari", 7, True, 120.0, "session_2_u1", "session_1_u1"),
    ("u1", "iPhone", "iOS", "Safari", 37, False, 0.0, "session_3_u1", "session_3_u1"),
    ("u1", "iPhone", "iOS", "Safari", 67 - 1 / MINUTE, True, 1799.999, "session_3_u1", "session_3_u1"),
    ("u2", None, "Android", "Chrome", 0, False, 0.0, "session_1_u2", "session_1_u2"),
    ("u2", None, "Android", "Chrome", 1, True, 60.0, "session_1_u2", "session_1_u2"),
    ("u2", "iPhone10,6", "iOS", "Safari", 2, False, 0.0, "session_2_u2", "session_2_u2"),
    ("u2", "iPhone10,6", "iOS", "Safari", 4, True, 120.0, "session_2_u2", "session_2_u2"),
    (None, "iPhone", "iOS", "Safari", 0, False, 0.0, None, None),
    (None, "iPhone", "iOS", "Safari", 10, True, 600.0, None, None),
    ("u3", "", "Android", "Chrome", 0, False, 0.0, "session_1_u3", "session_1_u3"),
]


def hand_rows():
    return [
        click(user, device, os, browser, T0 + round(at * MINUTE), n)
        for n, (user, device, os, browser, at, *_) in enumerate(HAND, 1)
    ]


@pytest.fixture(scope="session")
def hand(spark):
    return clicks(spark, hand_rows()).cache()

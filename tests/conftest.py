import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidewright.session import build_session, pin_utc  # noqa: E402

NOW = datetime(2026, 3, 10, 12, 0, tzinfo=timezone.utc)


def ago(**kw) -> datetime:
    return NOW - timedelta(**kw)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", 4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield pin_utc(session)
    session.stop()

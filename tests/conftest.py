import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "8")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples, nulls first."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, v) for v in r])
    return collect


@pytest.fixture
def plan():
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()
    return text

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillstone.plans.session import discard_settled, local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    discard_settled(session)


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as sorted tuples, optionally of some columns only."""

    def collect(df, *names):
        chosen = df.select(*names) if names else df
        return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

    return collect

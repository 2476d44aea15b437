from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelprep.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""
    def of(df, *cols):
        data = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(data, key=lambda t: tuple((v is not None, str(type(v)), v if not isinstance(v, (list, dict)) else str(v)) for v in t))

    return of

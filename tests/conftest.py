import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelwatch.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "4g")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted by the given columns or by all."""
    found = [tuple(r) for r in df.collect()]
    if order:
        at = [df.columns.index(c) for c in order]
        return sorted(found, key=lambda r: tuple((r[i] is None, r[i]) for i in at))
    return sorted(found, key=str)

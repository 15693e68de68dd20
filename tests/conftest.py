import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from recoengine.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("recoengine-tests", cores="*", shuffle_partitions=8)
    yield s


def rows(df, *cols):
    """Collected rows as tuples, sorted, for order-insensitive asserts."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))

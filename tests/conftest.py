import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kiln.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", 8)
    yield s
    s.stop()


def rows(df, *cols):
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from panelwise.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", spark__sql__shuffle__partitions="4", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def rows(df, *order):
    """Rows as dicts, ordered."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((r[c] is None, r[c]) for c in order)) if order else out


def same_rows(a, b, digits=6):
    """Equal as multisets of rows, doubles rounded."""

    def normal(df):
        names = sorted(df.columns)
        cell = lambda x: round(x, digits) + 0.0 if isinstance(x, float) else x
        return sorted((tuple(cell(r[n]) for n in names) for r in df.collect()), key=repr)

    return sorted(a.columns) == sorted(b.columns) and normal(a) == normal(b)

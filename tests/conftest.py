import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from brightledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores="8", shuffle_partitions=4, app="brightledger-tests")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def rows(df, *order):
    """Collected rows as dicts, sorted by the given columns (or all)."""
    found = [row.asDict() for row in df.collect()]
    return sorted(found, key=lambda r: tuple(repr(r[c]) for c in (order or sorted(r))))

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session

    s = get_session("*", app="tessera-tests", shuffle_partitions=8)
    yield s


def rows(df, *cols):
    """Collected rows as tuples (selected columns, in order)."""
    if cols:
        df = df.select(*cols)
    return [tuple(r) for r in df.collect()]

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tabsmith.session import checkpoint_root, get_spark
    s = get_spark("tests", cpus=4, shuffle_partitions=4, driver_memory="4g")
    checkpoint_root(s)  # tests run without a cluster folder: a private one is set
    yield s


def rows(df, *cols):
    """Collect selected columns as sorted tuples."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())

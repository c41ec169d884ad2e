import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

FIXTURES = ROOT / "tests" / "fixtures"
CLEAN = str(FIXTURES / "clean")
TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from parcelworks.session import local_session

    os.environ.setdefault("PARCELWORKS_DRIVER_MEMORY", "4g")
    session = local_session(cores=4, shuffle_partitions=4, app="parcelworks-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def clean_dir():
    return CLEAN


@pytest.fixture(scope="session")
def built(spark, tmp_path_factory):
    """The clean fixture built once into a warehouse folder."""
    from parcelworks.plans.jobs import build_warehouse

    out = str(tmp_path_factory.mktemp("warehouse"))
    return build_warehouse(spark, out, data_dir=CLEAN)


def rows(df, *cols):
    """Rows as plain tuples, sorted (NULLs first) for stable comparison."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

PARITY_SF = os.environ.get("SHOPLENS_PARITY_SF", "/root/testdata/sf0.01")
SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shoplens.config import build_session
    s = build_session("local[*]", app="shoplens-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_parity():
    from parity import duck
    return duck(PARITY_SF)

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from orderlens.session import local_session

    s = local_session(4, shuffle_partitions=8, app="orderlens-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck01():
    from oracle_compare import duck

    return duck(SF01)

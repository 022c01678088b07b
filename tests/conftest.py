import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import local_session
    s = local_session("*", shuffle_partitions=8, app="ledgerlake-tests")
    yield s


@pytest.fixture(scope="session")
def led(spark):
    from ledgerlake.sources.store import ledger
    return ledger(spark, SMOKE)


@pytest.fixture(scope="session")
def duck():
    from parity import duck as connect
    return connect(SMOKE)

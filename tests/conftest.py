import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
# Optional folder of sample log CSVs (e.g. the four sample files the survey
# describes); the test that uses it is skipped when unset.
REF_DATA = os.environ.get("LOGSCAN_SAMPLE_DIR", "")


@pytest.fixture(scope="session")
def spark():
    from logscan.session import get_session

    s = get_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)

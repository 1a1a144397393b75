"""One local session for all tests."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent / "llm"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidewell.session import session

    s = session("tests", master=f"local[{os.environ.get('TEST_CPUS', '4')}]", shuffle_partitions=4, spark__ui__enabled="false", spark__driver__memory="4g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")), spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the library, and the classes that tests hand to it.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, f"{ROOT}/tests", os.environ.get("PYTHONPATH", "")])
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from siftwork.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", "tests", spark__driver__memory="4g", spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false", spark__sql__warehouse__dir="/tmp/siftwork-tests/warehouse")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"

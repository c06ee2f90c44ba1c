import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from tidehouse import session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    built = session.build("local[4]", "tests", spark__sql__shuffle__partitions="3", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
                          spark__checkpoint__dir=str(shared),
                          spark__sql__warehouse__dir=str(shared / "warehouse"))
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture(scope="session")
def folder():
    return SF_DIR

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from affinity.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = get_session(
        "tests", "local[8]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false",
        spark__driver__memory="4g", spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(warehouse),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    return SF

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from marblework import session

    return session.build(
        "local[4]",
        "tests",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir="file://" + str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )


@pytest.fixture(scope="session")
def tiny():
    return f"{DATA}/sf0.001"

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYTHONPATH", sys.path[0])


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    tmp = tempfile.mkdtemp(prefix="tidemark-")
    session = build_session(
        "local[4]",
        4,
        spark__ui__enabled="false",
        spark__checkpoint__dir=f"file://{tmp}/shared",
        spark__sql__warehouse__dir=f"{tmp}/warehouse",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"

import pytest

from millrace.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "8")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)

import pytest

from duebook.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "duebook-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"

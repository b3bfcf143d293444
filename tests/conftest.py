import pytest

from staveline.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests", "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

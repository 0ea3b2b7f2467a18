import pytest

from maskwright.session import local_session, ship


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(2, 4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    return ship(session)

import pytest

from tabloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tabloom-tests")
    yield session
    session.stop()

import pytest

from mdlake.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "mdlake-tests", "4g", 4)

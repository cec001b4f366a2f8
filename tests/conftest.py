import pytest

from quillprep.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", "8g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("ck")))
    yield session
    session.stop()

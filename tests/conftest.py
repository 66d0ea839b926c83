import pytest

from duskwork.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, partitions=2, **{"spark.default.parallelism": "2"})
    yield session
    session.stop()

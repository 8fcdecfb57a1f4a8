import pytest

from pagemark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "pagemark-tests")
    session.conf.set("spark.sql.shuffle.partitions", "8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

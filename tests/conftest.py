import pytest

from foldwise.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session

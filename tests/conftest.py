import pytest

from lexloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g"})
    yield session
    session.stop()

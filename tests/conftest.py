import pytest

from roadlark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, **{"spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

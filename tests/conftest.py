import pytest
from compare import tables

from lectern.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def sql():
    return tables(SMALL)


@pytest.fixture
def one(spark):
    """Value of a column function over one row of literal values."""

    def value(function, *values):
        types = ", ".join(f"c{i} {'bigint' if isinstance(v, int) else 'string'}" for i, v in enumerate(values))
        df = spark.createDataFrame([values], types)
        return df.select(function(*[df[c] for c in df.columns]).alias("value")).first()["value"]

    return value

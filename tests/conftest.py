import pytest

from millrace.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions=4,
        spark__checkpoint__dir=folder / "checkpoint",
        spark__sql__warehouse__dir=folder / "warehouse",
        spark__driver__memory="4g",
        spark__sql__maxMetadataStringLength=10_000,
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan_of(spark):
    """The physical plan text of a frame, as Spark would run it."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text

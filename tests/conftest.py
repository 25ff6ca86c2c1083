import pytest

from seriesmart.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Shorthand: rows("a int, b string", (1, "x"), ...) -> DataFrame."""

    def build(schema, *data):
        return spark.createDataFrame(list(data), schema)

    return build

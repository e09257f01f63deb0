import pytest

from marketflow.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("shared")
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(root), "spark.sql.warehouse.dir": str(root / "warehouse"),
        "spark.ui.showConsoleProgress": "false", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def messages(spark):
    """Message texts as a table with the columns of a topic."""

    def make(*texts):
        rows = [("t", str(i), text, 0, i) for i, text in enumerate(texts)]
        return spark.createDataFrame(rows, "topic string, key string, value string, partition int, offset long")

    return make

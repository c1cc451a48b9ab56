import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """A one-column DataFrame ``text`` from a list."""
    return lambda values: spark.createDataFrame([(value,) for value in values], "text string")


@pytest.fixture
def files(tmp_path):
    """Write a folder of text files and return its path."""

    def write(contents, folder="in"):
        root = tmp_path / folder
        for name, content in contents.items():
            path = root / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(content.encode())
        return str(root)

    return write


def plan(df) -> str:
    return df._jdf.queryExecution().toString()

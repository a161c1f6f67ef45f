import tempfile

import pytest
from pyspark.sql import SparkSession

from toolquarry.schemas import SOURCE_FILES


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="toolquarry-")


@pytest.fixture(scope="session")
def source_files(spark):
    """Table of source files from ``{path: text or bytes}``."""

    def build(files, project="p"):
        rows = [
            (project, path, bytearray(c.encode() if isinstance(c, str) else c))
            for path, c in files.items()
        ]
        return spark.createDataFrame(rows, SOURCE_FILES)

    return build

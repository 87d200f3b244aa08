import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE.parent))
# Python workers import what test functions refer to.
os.environ["PYTHONPATH"] = os.pathsep.join([str(HERE), str(HERE.parent), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("revlens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_reviews(spark):
    """Typed reviews from dicts, numbered in order."""
    from revlens.schema import REVIEW
    from samples import BASE

    def make(*rows):
        return spark.createDataFrame(
            [tuple({**BASE, "seq": i, **row}[f.name] for f in REVIEW.fields) for i, row in enumerate(rows)],
            REVIEW,
        )

    return make

import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE))

from odd_rows import ODD, SCHEMA  # noqa: E402

@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with columns named as the operators name theirs."""
    clashing = "size long, n long, class string, spans string, _id long, _text string, _row string, score double"
    rows = [(*r, 1, 2, "x", "y", 3, "z", "w", 0.5) for r in ODD]
    return spark.createDataFrame(rows, f"{SCHEMA}, {clashing}").repartition(3)


@pytest.fixture(scope="session")
def odd_texts():
    return [r[1] for r in ODD]


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 13)] + [(None, 1, 1), (99, 1, None), (2, None, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE.parent), str(HERE)]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from compare import session

    spark = session()
    yield spark
    spark.stop()


@pytest.fixture
def folder(spark):
    """A fresh folder in the place all tasks share."""
    from gustline.sources.shared import fresh_path

    return fresh_path(spark, "test")

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textloom.session import local_session  # noqa: E402

SMALL_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "tests", "8g")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return session


@pytest.fixture
def one(spark):
    """Apply a Column function to one text."""
    from pyspark.sql import functions as F

    def apply(fn, text):
        frame = spark.range(1).select(F.lit(text).cast("string").alias("text"))
        return frame.select(fn(F.col("text")).alias("r")).first().r

    return apply

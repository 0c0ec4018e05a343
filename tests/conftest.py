import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from filmgrid.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", master="local[8]", cores=4)
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a column expression over one literal row."""

    def evaluate(expression, **row):
        from pyspark.sql import functions as F

        frame = spark.range(1).select(*[F.lit(value).alias(name) for name, value in row.items()])
        return frame.select(expression).first()[0]

    return evaluate

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace.plans.shop import Shop  # noqa: E402
from millrace.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    home = tempfile.mkdtemp(prefix="run-")
    session = local_session(
        "tests",
        "4",
        **{
            "spark.sql.warehouse.dir": f"{home}/warehouse",
            "spark.checkpoint.dir": f"{home}/checkpoints",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A new folder for each test."""
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture
def shop(spark):
    return Shop(spark, DATA)


def rows(df):
    """Rows as a sorted list of plain tuples."""
    return sorted((tuple(r) for r in df.collect()), key=str)

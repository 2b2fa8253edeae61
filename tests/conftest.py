import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from orgkin.session import local_session

    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        4, "tests", **{
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        }
    )
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def plan():
    """Physical plan text of a frame."""
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text

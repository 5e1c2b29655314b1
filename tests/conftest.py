import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from retail_insight import schemas  # noqa: E402
from retail_insight.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", "retail-insight-tests", {"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture
def make_visits(spark):
    def make(rows):
        return spark.createDataFrame(rows, schemas.USER_VISIT_ACTION)
    return make


@pytest.fixture
def make_users(spark):
    def make(rows):
        """rows: (user_id, age)"""
        return spark.createDataFrame([(u, f"u{u}", f"u{u}", a, "p", "male") for u, a in rows],
                                     schemas.USER_INFO)
    return make

import sys
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from goldvein.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a small frame from rows and a DDL schema."""

    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture
def zone(spark, tmp_path):
    from goldvein.sources.tables import Zone, create_zone

    made = Zone(f"zone_{tmp_path.name.replace('-', '_')}", str(tmp_path / "zone"))
    create_zone(spark, made)
    return made


DAY_ONE = datetime(2024, 1, 1, 6)
DAY_TWO = datetime(2024, 1, 2, 6)
SOME_DAY = date(2024, 1, 1)

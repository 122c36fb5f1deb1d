import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import check  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = check.session(partitions=3)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def obs_of(spark):
    """Observations from (city, date text, urban, rural, night, index) rows."""
    from thermalis.operators.ingest import with_calendar
    from thermalis.schema import OBSERVATIONS

    def build(rows):
        raw = spark.createDataFrame(
            rows, "city string, date string, LST_Day_Urban double, LST_Day_Rural double, "
                  "LST_Night_Urban double, UHI_Index double")
        return with_calendar(raw.selectExpr("city", "to_date(date) AS date", "LST_Day_Urban", "LST_Day_Rural",
                                            "LST_Night_Urban", "UHI_Index")).select(*OBSERVATIONS.names)

    return build


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())

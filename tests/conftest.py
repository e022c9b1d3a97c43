import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from touchline.session import local_session  # noqa: E402

ROWS = "date string, home_team string, away_team string, home_score bigint, away_score bigint, tournament string, city string, country string, neutral boolean"
VALID = [
    ("2024-02-10", "Harbour Lions", "Mill Town", 4, 1, "Coast Shield", "Westport", "Lowland", False),
    ("2024-02-17", "Rhone Valley", "Old Quarry", 3, 3, "Coast Shield", "Easton", "Lowland", True),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.maxMetadataStringLength": "2000",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = local_session(8, "tests", settings)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def make(spark):
    """Contract rows with a real date column; defects are made by passing other rows."""

    def build(rows=VALID):
        from pyspark.sql import functions as F

        return spark.createDataFrame(list(rows), ROWS).withColumn("date", F.to_date("date"))

    return build


@pytest.fixture
def valid(make):
    return make()


def changed(row, **values):
    names = ["date", "home_team", "away_team", "home_score", "away_score", "tournament", "city", "country", "neutral"]
    return tuple(values.get(n, v) for n, v in zip(names, row))


def as_dicts(df):
    return [r.asDict() for r in df.collect()]

"""Sort keys with explicit NULL placement, and tie-breaks that make every top-k deterministic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Without an id, matches are told apart by everything that identifies them.
_NATURAL_KEY = (
    "match_date",
    "date",
    "home_team",
    "away_team",
    "home_score",
    "away_score",
    "tournament",
    "city",
    "country",
    "neutral",
)


def up(name: str | Column) -> Column:
    return F.asc_nulls_last(name)


def down(name: str | Column) -> Column:
    return F.desc_nulls_last(name)


def tie_break(df: DataFrame) -> list[Column]:
    """Last sort keys for match rows: the id when the frame has one, else its natural key."""
    if "match_id" in df.columns:
        return [up("match_id")]
    return [up(c) for c in _NATURAL_KEY if c in df.columns]


def sort_few(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Order a result whose size cannot grow with the data (one row per venue type, per year, per bin).

    A global sort would first run a job to sample its ranges; a handful of rows needs none.
    """
    return df.repartition(1).sortWithinPartitions(*[up(k) if isinstance(k, str) else k for k in keys])

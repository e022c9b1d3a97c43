"""Labels and match-level measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.contract import RESULTS

_home_win, _draw, _away_win = RESULTS


def home_won() -> Column:
    return F.col("home_score") > F.col("away_score")


def away_won() -> Column:
    return F.col("home_score") < F.col("away_score")


def level() -> Column:
    return F.col("home_score") == F.col("away_score")


def total_goals() -> Column:
    return F.col("home_score") + F.col("away_score")


def goal_difference() -> Column:
    return F.abs(F.col("home_score") - F.col("away_score"))


def top_score() -> Column:
    return F.greatest("home_score", "away_score")


def match_result() -> Column:
    """Draw is the default, so a missing score also reads as a draw."""
    return F.when(home_won(), _home_win).when(away_won(), _away_win).otherwise(_draw)


def winner() -> Column:
    return F.when(home_won(), F.col("home_team")).otherwise(F.col("away_team"))


def loser() -> Column:
    return F.when(home_won(), F.col("away_team")).otherwise(F.col("home_team"))


def winner_side() -> Column:
    return F.when(home_won(), "home").otherwise("away")


def scoreline() -> Column:
    return F.concat_ws(":", F.col("home_score").cast("string"), F.col("away_score").cast("string"))


def venue_label(labels: tuple[str, str, str]) -> Column:
    """Name the three states of the neutral flag; missing is a class of its own."""
    yes, no, missing = labels
    return F.when(F.col("neutral"), yes).when(~F.col("neutral"), no).otherwise(missing)


def side_code(goals_for: Column, goals_against: Column) -> Column:
    """W, D or L seen from one team."""
    return F.when(goals_for > goals_against, "W").when(goals_for == goals_against, "D").otherwise("L")

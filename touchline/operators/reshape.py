"""Reshapes: one row per team and match, one row per dimension value, wide to long."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import labels


def team_sides(matches: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Two rows per match: team, opponent, goals_for, goals_against, venue_role, and kept columns.

    An unpivot reads the source once (a union of two selects reads it twice), and unlike an
    exploded array it allocates nothing per row.
    """
    carried = [*keep, "home_team", "away_team", "home_score", "away_score"]
    home = F.col("_side") == "home_team"
    return matches.unpivot(carried, ["home_team", "away_team"], "_side", "team").select(
        *keep,
        "team",
        F.when(home, F.col("away_team")).otherwise(F.col("home_team")).alias("opponent"),
        F.when(home, F.col("home_score")).otherwise(F.col("away_score")).alias("goals_for"),
        F.when(home, F.col("away_score")).otherwise(F.col("home_score")).alias("goals_against"),
        F.when(home, "Home").otherwise("Away").alias("venue_role"),
    )


_CARRIED = ("date", "year", "tournament", "city", "country", "neutral", "total_goals", "goal_difference")


def team_long(enriched: DataFrame) -> DataFrame:
    """Team perspective of enriched matches, with result label and 0/1 flags."""
    keep = (("match_id",) if "match_id" in enriched.columns else ()) + _CARRIED
    won, lost = F.col("goals_for") > F.col("goals_against"), F.col("goals_for") < F.col("goals_against")
    result = F.when(won, "Win").when(lost, "Loss").otherwise("Draw")
    return team_sides(enriched, keep).select(
        "*",
        result.alias("match_result"),
        (result == "Win").cast("int").alias("is_win"),
        (result == "Draw").cast("int").alias("is_draw"),
        (result == "Loss").cast("int").alias("is_loss"),
    )


def team_rows(enriched: DataFrame, team: str) -> DataFrame:
    """The team-long rows of one team.

    The either-side filter comes first, so it reaches the scan; a filter on the unpivoted
    column alone would read and double every match.
    """
    played = (F.col("home_team") == team) | (F.col("away_team") == team)
    return team_long(enriched.filter(played)).filter(F.col("team") == team)


def team_names(matches: DataFrame) -> DataFrame:
    """The names of both sides, two rows per match."""
    return matches.unpivot([], ["home_team", "away_team"], "_side", "team_name").select("team_name")


def unique_teams(matches: DataFrame) -> DataFrame:
    """Distinct names over both sides."""
    return team_names(matches).distinct()


def distinct_count(df: DataFrame, column: str) -> Column:
    """Number of distinct values as a scalar subquery.

    Several distinct counts in one aggregate multiply every row by their number. On columnar storage one
    narrow scan per column reads the same bytes without that, and equal values merge before the shuffle.
    """
    return df.select(column).distinct().agg(F.count(column)).scalar()


def team_results_long(yearly: DataFrame) -> DataFrame:
    """wins / draws / losses columns to (result_type, result_count) rows."""
    kinds = ["wins", "draws", "losses"]
    ids = [c for c in yearly.columns if c not in kinds]
    return yearly.unpivot(ids, kinds, "result_type", "result_count")


def with_code(sides: DataFrame) -> DataFrame:
    """Add the W / D / L code used by the team reports."""
    return sides.withColumn("result", labels.side_code(F.col("goals_for"), F.col("goals_against")))

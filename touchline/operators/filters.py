"""Row filters. Each one stays a plain predicate so that Catalyst can push it to the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import contract as C
from touchline.functions.ordering import down, tie_break, up

VENUE_MODES = ("all", "neutral", "non_neutral")


def in_years(column: str, first: int | None, last: int | None) -> Column:
    """Inclusive year range as a date range: year(date) comparisons never reach Parquet statistics."""
    d = F.col(column)
    keep = d.isNotNull()
    if first is not None:
        keep &= d >= F.make_date(F.lit(first), F.lit(1), F.lit(1))
    if last is not None:
        keep &= d < F.make_date(F.lit(last + 1), F.lit(1), F.lit(1))
    return keep


def suspicious_scores(threshold: int = C.SUSPICIOUS_SCORE) -> Column:
    return (F.col("home_score") > threshold) | (F.col("away_score") > threshold)


def decisive() -> Column:
    return F.col("home_score") != F.col("away_score")


def global_filters(
    matches: DataFrame,
    years: tuple[int | None, int | None] | None = None,
    tournament: str | None = None,
    team: str | None = None,
    country: str | None = None,
    venue: str = "all",
    ordered: bool = False,
) -> DataFrame:
    """Slice enriched matches. None (or 'All') switches a filter off; a missing neutral flag is in neither venue mode.

    Sorting is left to the consumer unless asked for, since it costs a shuffle of the whole slice.
    """
    if venue not in VENUE_MODES:
        raise ValueError(f"venue must be one of {', '.join(VENUE_MODES)}, got: {venue}")
    if years is not None:
        matches = matches.filter(in_years("date", *years))
    if tournament not in (None, "All"):
        matches = matches.filter(F.col("tournament") == tournament)
    if team not in (None, "All"):
        matches = matches.filter((F.col("home_team") == team) | (F.col("away_team") == team))
    if country not in (None, "All"):
        matches = matches.filter(F.col("country") == country)
    if venue == "neutral":
        matches = matches.filter(F.col("neutral"))
    elif venue == "non_neutral":
        matches = matches.filter(~F.col("neutral"))
    return by_date(matches) if ordered else matches


def by_date(matches: DataFrame) -> DataFrame:
    """Date order. The tie-break keys also let the range partitioner split a crowded day."""
    return matches.orderBy(up("date"), *tie_break(matches))


def either_side_like(text: str, literal: bool = False) -> Column:
    """Case-insensitive search on either side; a regular expression unless literal."""
    needle = text.strip().lower()

    def hit(side: str) -> Column:
        name = F.lower(F.col(side))
        found = name.contains(needle) if literal else name.rlike(needle)
        return F.coalesce(found, F.lit(False))

    return hit("home_team") | hit("away_team")


def match_explorer(
    matches: DataFrame,
    team_search: str = "",
    min_total_goals: int = 0,
    draws_only: bool = False,
    big_wins_only: bool = False,
    limit: int = 500,
    literal: bool = False,
) -> DataFrame:
    """Latest enriched matches that meet the local filters."""
    if team_search.strip():
        matches = matches.filter(either_side_like(team_search, literal))
    matches = matches.filter(F.col("total_goals") >= min_total_goals)
    if draws_only:
        matches = matches.filter(F.col("result") == C.RESULTS[1])
    if big_wins_only:
        matches = matches.filter(F.col("goal_difference") >= C.BIG_WIN_MARGIN)
    return matches.orderBy(down("date"), *tie_break(matches)).limit(limit)

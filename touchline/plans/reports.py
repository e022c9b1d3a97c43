"""The fixed reports over the match table, one function per report. Limits and thresholds are arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import contract as C
from touchline.functions import labels
from touchline.functions.numeric import exact_mean, exact_pct, exact_share, row_count
from touchline.functions.ordering import down, sort_few, tie_break, up
from touchline.operators.enrich import as_fact
from touchline.operators.filters import decisive, suspicious_scores
from touchline.operators.reshape import distinct_count, team_names, team_sides, with_code


def dataset_overview(matches: DataFrame, approx: bool = False) -> DataFrame:
    """One row: matches, date range, distinct teams (both sides), tournaments and countries.

    approx=True estimates the distinct counts by sketches in the same aggregate and shuffles no values.
    """
    matches = as_fact(matches)
    facts = [
        row_count().alias("match_count"),
        F.min("match_date").alias("min_match_date"),
        F.max("match_date").alias("max_match_date"),
    ]
    if approx:
        return matches.agg(
            *facts,
            _union_estimate("home_team", "away_team").alias("unique_team_count"),
            F.approx_count_distinct("tournament").alias("tournament_count"),
            F.approx_count_distinct("country").alias("country_count"),
        )
    return matches.agg(*facts).select(
        "*",
        distinct_count(team_names(matches), "team_name").alias("unique_team_count"),
        distinct_count(matches, "tournament").alias("tournament_count"),
        distinct_count(matches, "country").alias("country_count"),
    )


def _union_estimate(*columns: str) -> Column:
    """Approximate distinct count over several columns together: sketches of each, merged."""
    sketches = [F.hll_sketch_agg(c) for c in columns]
    merged = sketches[0]
    for sketch in sketches[1:]:
        merged = F.hll_union(merged, sketch)
    return F.hll_sketch_estimate(merged)


def matches_by_year(matches: DataFrame) -> DataFrame:
    grouped = (
        as_fact(matches)
        .groupBy(F.year("match_date").alias("match_year"))
        .agg(row_count().alias("match_count"), exact_mean(labels.total_goals(), 2).alias("avg_total_goals"))
    )
    return sort_few(grouped, "match_year")


def home_advantage(matches: DataFrame) -> DataFrame:
    """Results by venue type, with percentages."""
    grouped = (
        matches.groupBy(labels.venue_label(C.VENUE_REPORT).alias("venue_type"))
        .agg(
            row_count().alias("match_count"),
            F.count_if(labels.home_won()).alias("home_wins"),
            F.count_if(labels.level()).alias("draws"),
            F.count_if(labels.away_won()).alias("away_wins"),
            exact_pct(labels.home_won()).alias("home_win_pct"),
            exact_pct(labels.level()).alias("draw_pct"),
            exact_pct(labels.away_won()).alias("away_win_pct"),
        )
    )
    return sort_few(grouped, "venue_type")


def most_successful_teams(matches: DataFrame, limit: int = 20) -> DataFrame:
    code = F.col("result")
    return (
        with_code(team_sides(matches))
        .groupBy("team")
        .agg(
            row_count().alias("matches"),
            F.count_if(code == "W").alias("wins"),
            F.count_if(code == "D").alias("draws"),
            F.count_if(code == "L").alias("losses"),
            F.sum("goals_for").alias("goals_for"),
            F.sum("goals_against").alias("goals_against"),
            (F.sum("goals_for") - F.sum("goals_against")).alias("goal_difference"),
            exact_pct(code == "W").alias("win_rate"),
        )
        .orderBy(down("wins"), down("win_rate"), down("goal_difference"), down("matches"), up("team"))
        .limit(limit)
    )


def highest_scoring_teams(matches: DataFrame, min_matches: int = C.MIN_TEAM_MATCHES, limit: int = 20) -> DataFrame:
    return (
        team_sides(matches)
        .groupBy("team")
        .agg(
            row_count().alias("matches"),
            F.sum("goals_for").alias("goals_for"),
            F.sum("goals_against").alias("goals_against"),
            exact_mean(F.col("goals_for"), 3).alias("avg_goals_for"),
            exact_mean(F.col("goals_against"), 3).alias("avg_goals_against"),
        )
        .filter(F.col("matches") >= min_matches)
        .orderBy(down("avg_goals_for"), down("goals_for"), up("team"))
        .limit(limit)
    )


def top_scoring_teams(matches: DataFrame, min_matches: int = C.MIN_TEAM_MATCHES, limit: int = 20) -> DataFrame:
    return (
        team_sides(matches)
        .groupBy("team")
        .agg(
            row_count().alias("matches"),
            F.sum("goals_for").alias("goals_scored"),
            F.sum("goals_against").alias("goals_allowed"),
            exact_mean(F.col("goals_for"), 2).alias("avg_goals_per_match"),
        )
        .filter(F.col("matches") >= min_matches)
        .orderBy(down("goals_scored"), up("team"))
        .limit(limit)
    )


def tournament_analysis(
    matches: DataFrame, min_matches: int = C.MIN_TOURNAMENT_MATCHES, limit: int = 20
) -> DataFrame:
    return (
        matches.groupBy("tournament")
        .agg(
            row_count().alias("match_count"),
            exact_mean(labels.total_goals(), 2).alias("avg_total_goals"),
            exact_mean(labels.goal_difference(), 2).alias("avg_goal_difference"),
        )
        .filter(F.col("match_count") >= min_matches)
        .orderBy(down("match_count"), up("tournament"))
        .limit(limit)
    )


def tournament_summary(matches: DataFrame, min_matches: int = C.MIN_TOURNAMENT_MATCHES, limit: int = 30) -> DataFrame:
    return (
        as_fact(matches)
        .groupBy("tournament")
        .agg(
            row_count().alias("match_count"),
            F.min("match_date").alias("first_match_date"),
            F.max("match_date").alias("last_match_date"),
            exact_mean(labels.total_goals(), 2).alias("avg_total_goals"),
        )
        .filter(F.col("match_count") >= min_matches)
        .orderBy(down("match_count"), up("tournament"))
        .limit(limit)
    )


def home_advantage_shares(matches: DataFrame) -> DataFrame:
    """One row over the matches known to be on non-neutral ground; shares are NULL when there are none."""
    return matches.filter(~F.col("neutral")).agg(
        row_count().alias("non_neutral_matches"),
        F.count_if(labels.home_won()).alias("home_wins"),
        F.count_if(labels.level()).alias("draws"),
        F.count_if(labels.away_won()).alias("away_wins"),
        exact_share(labels.home_won()).alias("home_win_share"),
        exact_share(labels.level()).alias("draw_share"),
        exact_share(labels.away_won()).alias("away_win_share"),
    )


def neutral_vs_non_neutral(matches: DataFrame) -> DataFrame:
    grouped = (
        matches.groupBy(labels.venue_label(C.VENUE_QUERY).alias("neutral_status"))
        .agg(
            row_count().alias("match_count"),
            exact_mean(labels.total_goals(), 2).alias("avg_total_goals"),
            exact_share(labels.level()).alias("draw_share"),
            exact_share(labels.home_won()).alias("home_win_share"),
        )
    )
    return sort_few(grouped, "neutral_status")


def biggest_wins_report(matches: DataFrame, limit: int = 20) -> DataFrame:
    """Largest margins; then more goals, then the earlier match."""
    matches = as_fact(matches)
    return (
        matches.filter(decisive())
        .orderBy(down(labels.goal_difference()), down(labels.total_goals()), up("match_date"), *tie_break(matches))
        .limit(limit)
        .select(
            "match_date",
            "home_team",
            "away_team",
            "home_score",
            "away_score",
            labels.goal_difference().alias("goal_difference"),
            labels.winner().alias("winner"),
            labels.loser().alias("loser"),
            labels.winner_side().alias("winner_side"),
            "tournament",
        )
    )


def biggest_wins(matches: DataFrame, limit: int = 25) -> DataFrame:
    """Largest margins; then the higher winning score, then the earlier match."""
    matches = as_fact(matches)
    return (
        matches.filter(decisive())
        .orderBy(down(labels.goal_difference()), down(labels.top_score()), up("match_date"), *tie_break(matches))
        .limit(limit)
        .select(
            "match_date",
            labels.winner().alias("winner"),
            labels.loser().alias("loser"),
            labels.scoreline().alias("score"),
            labels.goal_difference().alias("goal_difference"),
            "tournament",
        )
    )


_REVIEWED = ("match_date", "home_team", "away_team", "home_score", "away_score", "tournament", "city", "country")


def score_quality_review(matches: DataFrame, threshold: int = C.SUSPICIOUS_SCORE) -> DataFrame:
    """All matches with a score above the threshold, with the measures they are ranked by."""
    matches = as_fact(matches)
    found = matches.filter(suspicious_scores(threshold))
    return found.orderBy(
        down(labels.top_score()), down(labels.total_goals()), up("match_date"), *tie_break(matches)
    ).select(*_REVIEWED, labels.top_score().alias("max_side_score"), labels.total_goals().alias("total_goals"))


def score_quality_check(matches: DataFrame, threshold: int = C.SUSPICIOUS_SCORE) -> DataFrame:
    matches = as_fact(matches)
    found = matches.filter(suspicious_scores(threshold))
    return found.orderBy(down(labels.top_score()), up("match_date"), *tie_break(matches)).select(*_REVIEWED)

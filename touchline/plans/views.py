"""Aggregates behind the analysis views. They take enriched matches (enrich_matches) or team rows (team_long)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline import contract as C
from touchline.functions import labels
from touchline.functions.numeric import half_even, pct, ratio, row_count
from touchline.functions.ordering import down, sort_few, tie_break, up
from touchline.operators.reshape import distinct_count, team_long, team_names, team_sides

_HOME_WIN, _DRAW, _AWAY_WIN = C.RESULTS


def _is(result: str) -> Column:
    return F.col("result") == result


def _share(condition: Column) -> Column:
    """Unrounded percentage of the rows of a group."""
    return F.avg(condition.cast("int")) * 100


# --- whole dataset ---------------------------------------------------------------------------


def _kpis(matches: DataFrame) -> DataFrame:
    return matches.agg(
        row_count().alias("matches"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.avg("total_goals").alias("avg_goals"),
    ).withColumn("teams", distinct_count(team_names(matches), "team_name"))


def overview_kpis(matches: DataFrame) -> DataFrame:
    """One row: matches, teams, tournaments, host countries, date range and mean goals of a slice."""
    return _kpis(matches).select(
        "matches",
        "teams",
        distinct_count(matches, "tournament").alias("tournaments"),
        distinct_count(matches, "country").alias("countries"),
        "first_date",
        "last_date",
        "avg_goals",
    )


def top_value(matches: DataFrame, key: str) -> DataFrame:
    """One row holding a struct (minus_n, value): the most frequent value of a column, the first by name on a tie."""
    groups = matches.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("value")).agg(row_count().alias("n"))
    return groups.agg(F.min(F.struct((-F.col("n")).alias("minus_n"), "value")).alias("top"))


def overview_insights(matches: DataFrame) -> DataFrame:
    """One row: peak year, top tournament, home-win %, mean goals, neutral % (a missing flag counts as not neutral).

    The totals are sums over the year groups. No row for no matches.
    """
    years = matches.groupBy("year").agg(
        row_count().alias("n"),
        F.count_if(_is(_HOME_WIN)).alias("home_wins"),
        F.count_if("neutral").alias("neutral_matches"),
        F.sum("total_goals").alias("goals"),
        F.count("total_goals").alias("scored"),
    )
    known = F.when(F.col("year").isNotNull(), F.struct((-F.col("n")).alias("minus_n"), F.col("year").alias("value")))
    found = years.agg(
        F.sum("n").alias("n"),
        F.min(known).alias("peak"),
        pct(F.sum("home_wins"), F.sum("n")).alias("home_win_pct"),
        ratio(F.sum("goals"), F.sum("scored")).alias("avg_goals"),
        pct(F.sum("neutral_matches"), F.sum("n")).alias("neutral_pct"),
    ).withColumn("top", top_value(matches, "tournament").scalar())
    return found.filter(F.col("n") > 0).select(
        F.col("peak.value").alias("peak_year"),
        (-F.col("peak.minus_n")).alias("peak_year_matches"),
        F.col("top.value").alias("top_tournament"),
        (-F.col("top.minus_n")).alias("top_tournament_matches"),
        "home_win_pct",
        "avg_goals",
        "neutral_pct",
    )


def filter_options(matches: DataFrame) -> DataFrame:
    """(dimension, value) rows: teams of both sides, tournaments, countries, and year_min / year_max.

    One evaluation of the input: each row gives its names and its year twice, and equal ones merge before the shuffle.
    """

    def line(dimension: str, name: Column, year: Column) -> Column:
        return F.struct(F.lit(dimension).alias("dimension"), name.cast("string").alias("name"), year.cast("int").alias("year"))

    none = F.lit(None)
    names = [("team", "home_team"), ("team", "away_team"), ("tournament", "tournament"), ("country", "country")]
    lines = [line(dimension, F.col(c), none) for dimension, c in names]
    lines += [line(dimension, none, F.year("date")) for dimension in ("year_min", "year_max")]
    groups = matches.select(F.inline(F.array(*lines))).groupBy("dimension", "name").agg(F.min("year").alias("low"), F.max("year").alias("high"))
    year = F.when(F.col("dimension") == "year_min", F.col("low")).otherwise(F.col("high"))
    options = groups.select("dimension", F.coalesce("name", year.cast("string")).alias("value"))
    return options.filter(F.col("value").isNotNull()).orderBy("dimension", "value")


def outcome_distribution(matches: DataFrame, keep_absent: bool = False) -> DataFrame:
    """Share of each result in fixed order. keep_absent lists a result nobody reached, with NULL shares."""
    counts = matches.agg(row_count().alias("n"), *[F.count_if(_is(r)).alias(f"c{i}") for i, r in enumerate(C.RESULTS)])
    rows = [F.struct(F.lit(r).alias("result"), F.col(f"c{i}").alias("count")) for i, r in enumerate(C.RESULTS)]
    lines = counts.select("n", F.inline(F.array(*rows)))
    share = ratio(F.when(F.col("count") > 0, F.col("count")), F.col("n"))
    shares = lines.select("result", share.alias("share"), (share * 100).alias("share_pct"))
    return shares if keep_absent else shares.filter(F.col("share").isNotNull())


def goals_histogram(matches: DataFrame, width: int = 1) -> DataFrame:
    """Matches per bin of total goals; bins start at 0."""
    bin_start = (F.floor(F.col("total_goals") / width) * width).cast("bigint")
    grouped = (
        matches.filter(F.col("total_goals").isNotNull())
        .groupBy(bin_start.alias("bin_start"))
        .agg(row_count().alias("matches"))
    )
    return sort_few(grouped, "bin_start")


def scoreline_frequency(matches: DataFrame, limit: int | None = None) -> DataFrame:
    return _counted(matches, labels.scoreline().alias("scoreline"), "scoreline", limit)


def _counted(matches: DataFrame, key: Column | str, name: str, limit: int | None) -> DataFrame:
    ranked = matches.groupBy(key).agg(row_count().alias("matches")).orderBy(down("matches"), up(name))
    return ranked if limit is None else ranked.limit(limit)


def top_tournaments(matches: DataFrame, limit: int | None = 20) -> DataFrame:
    return _counted(matches.filter(F.col("tournament").isNotNull()), "tournament", "tournament", limit)


def top_host_countries(matches: DataFrame, limit: int | None = 15) -> DataFrame:
    return _counted(matches.filter(F.col("country").isNotNull()), "country", "country", limit)


def top_host_cities(matches: DataFrame, limit: int | None = 15) -> DataFrame:
    return _counted(matches.filter(F.col("city").isNotNull()), "city", "city", limit)


# --- years -----------------------------------------------------------------------------------


def matches_per_year(matches: DataFrame) -> DataFrame:
    """Match count and unrounded mean goals per year."""
    grouped = (
        matches.filter(F.col("year").isNotNull())
        .groupBy("year")
        .agg(row_count().alias("matches"), F.avg("total_goals").alias("avg_total_goals"))
    )
    return sort_few(grouped, "year")


def yearly_trends(matches: DataFrame) -> DataFrame:
    """Per year: matches, mean goals, draw share, and home-win share of non-neutral matches (NULL without any)."""
    home_win = F.when(~F.col("neutral"), _is(_HOME_WIN).cast("int"))
    grouped = (
        matches.filter(F.col("year").isNotNull())
        .groupBy("year")
        .agg(
            row_count().alias("matches"),
            F.avg("total_goals").alias("avg_goals"),
            _share(_is(_DRAW)).alias("draw_share"),
            (F.avg(home_win) * 100).alias("home_win_share"),
        )
    )
    return sort_few(grouped, "year")


_TRENDS = ("matches", "avg_goals", "draw_share", "home_win_share")


def smooth_yearly(yearly: DataFrame, window: int) -> DataFrame:
    """Rolling means over `window` rows; NULL until a window is full and holds no NULL.

    The window has no partition key on purpose: its input is one row per year, already aggregated.
    """
    if window <= 1:
        return yearly
    w = Window.orderBy("year").rowsBetween(-(window - 1), 0)
    smooth = {c: F.when(F.count(c).over(w) >= window, F.avg(c).over(w)) for c in _TRENDS}
    return yearly.select(*[smooth[c].alias(c) if c in smooth else F.col(c) for c in yearly.columns])


def with_home_win_share(yearly: DataFrame) -> DataFrame:
    """The years that have a home-win share at all."""
    return yearly.dropna(subset=["home_win_share"])


# --- venues ----------------------------------------------------------------------------------


def venue_comparison(matches: DataFrame) -> DataFrame:
    """Per venue type and result: matches, matches at that venue type, share."""
    venue = labels.venue_label(C.VENUE_VIEW).alias("venue_type")
    grouped = matches.groupBy(venue, "result").agg(row_count().alias("matches"))
    total = F.sum("matches").over(Window.partitionBy("venue_type"))
    return grouped.select("venue_type", "result", "matches", total.alias("venue_matches")).withColumn(
        "share_pct", pct(F.col("matches"), F.col("venue_matches"))
    )


def home_advantage_table(matches: DataFrame, digits: int = 2) -> DataFrame:
    """Per venue type: matches, mean goals of either side and result shares, rounded half to even."""

    def rounded(value: Column, name: str) -> Column:
        return half_even(value, digits).alias(name)

    grouped = (
        matches.groupBy(labels.venue_label(C.VENUE_VIEW).alias("venue_type"))
        .agg(
            row_count().alias("matches"),
            rounded(F.avg("home_score"), "avg_home_goals"),
            rounded(F.avg("away_score"), "avg_away_goals"),
            rounded(_share(_is(_HOME_WIN)), "home_win_share"),
            rounded(_share(_is(_DRAW)), "draw_share"),
            rounded(_share(_is(_AWAY_WIN)), "away_win_share"),
        )
    )
    return sort_few(grouped, "venue_type")


def home_win_shift(matches: DataFrame) -> DataFrame:
    """One row: home-win share on non-neutral and on neutral ground (NULL for a class without matches)."""

    def share_where(venue: Column) -> Column:
        return F.avg(F.when(venue, _is(_HOME_WIN).cast("int"))) * 100

    return matches.agg(
        share_where(~F.col("neutral")).alias("non_neutral_home_win_pct"),
        share_where(F.col("neutral")).alias("neutral_home_win_pct"),
    )


# --- teams -----------------------------------------------------------------------------------


def _tally() -> list[Column]:
    return [
        row_count().alias("matches"),
        F.sum("is_win").alias("wins"),
        F.sum("is_draw").alias("draws"),
        F.sum("is_loss").alias("losses"),
        F.coalesce(F.sum("goals_for"), F.lit(0)).alias("goals_for"),
        F.coalesce(F.sum("goals_against"), F.lit(0)).alias("goals_against"),
    ]


def team_table(matches: DataFrame) -> DataFrame:
    """Per team: results, goals, goal difference, win rate and mean goals, unordered."""
    won, lost = F.col("goals_for") > F.col("goals_against"), F.col("goals_for") < F.col("goals_against")
    drawn = ~(F.coalesce(won, F.lit(False)) | F.coalesce(lost, F.lit(False)))
    tallies = (
        team_sides(matches)
        .filter(F.col("team").isNotNull())
        .groupBy("team")
        .agg(
            row_count().alias("matches"),
            F.count_if(won).alias("wins"),
            F.count_if(drawn).alias("draws"),
            F.count_if(lost).alias("losses"),
            F.coalesce(F.sum("goals_for"), F.lit(0)).alias("goals_for"),
            F.coalesce(F.sum("goals_against"), F.lit(0)).alias("goals_against"),
        )
    )
    return with_team_rates(tallies)


def with_team_rates(tallies: DataFrame) -> DataFrame:
    """Add goal difference, win rate and mean goals to sums per team."""
    return tallies.select(
        "*",
        (F.col("goals_for") - F.col("goals_against")).alias("goal_difference"),
        pct(F.col("wins"), F.col("matches")).alias("win_rate"),
        ratio(F.col("goals_for"), F.col("matches")).alias("avg_goals_for"),
    )


def team_ranking(matches: DataFrame) -> DataFrame:
    return ranked_teams(team_table(matches))


def ranked_teams(teams: DataFrame) -> DataFrame:
    return teams.orderBy(down("wins"), down("matches"), up("team"))


def top_teams_by_wins(matches: DataFrame, limit: int = 20) -> DataFrame:
    return team_table(matches).orderBy(down("wins"), down("win_rate"), up("team")).limit(limit)


def top_teams_by_win_rate(matches: DataFrame, min_matches: int = C.MIN_TEAM_MATCHES, limit: int = 20) -> DataFrame:
    frequent = team_table(matches).filter(F.col("matches") >= min_matches)
    return frequent.orderBy(down("win_rate"), down("wins"), up("team")).limit(limit)


def top_teams_by_avg_goals(matches: DataFrame, min_matches: int = C.MIN_TEAM_MATCHES, limit: int = 20) -> DataFrame:
    frequent = team_table(matches).filter(F.col("matches") >= min_matches)
    return frequent.orderBy(down("avg_goals_for"), down("goals_for"), up("team")).limit(limit)


def team_summary(rows: DataFrame) -> DataFrame:
    """Key figures of a set of team rows; zeros for none."""
    zero = F.lit(0).cast("bigint")
    names = ("wins", "draws", "losses", "goals_for", "goals_against")
    sums = rows.agg(*_tally()).select("matches", *[F.coalesce(F.col(c), zero).alias(c) for c in names])

    def per_match(name: str) -> Column:
        return F.coalesce(ratio(F.col(name), F.col("matches")), F.lit(0.0))

    return sums.select(
        "matches",
        "wins",
        "draws",
        "losses",
        (per_match("wins") * 100).alias("win_rate"),
        "goals_for",
        "goals_against",
        (F.col("goals_for") - F.col("goals_against")).alias("goal_difference"),
        per_match("goals_for").alias("avg_goals_for"),
    )


def team_yearly_results(rows: DataFrame) -> DataFrame:
    return sort_few(rows.filter(F.col("year").isNotNull()).groupBy("year").agg(*_tally()), "year")


def team_top_opponents(rows: DataFrame, limit: int = 10) -> DataFrame:
    return (
        rows.filter(F.col("opponent").isNotNull())
        .groupBy("opponent")
        .agg(row_count().alias("matches"), F.sum("is_win").alias("wins"))
        .orderBy(down("matches"), down("wins"), up("opponent"))
        .limit(limit)
    )


def team_latest_matches(rows: DataFrame, limit: int = 20) -> DataFrame:
    last_keys = [up("match_id")] if "match_id" in rows.columns else [up("opponent"), up("venue_role"), up("tournament")]
    return (
        rows.orderBy(down("date"), *last_keys)
        .limit(limit)
        .select(
            "date",
            "team",
            "opponent",
            "goals_for",
            "goals_against",
            "match_result",
            "tournament",
            "city",
            "country",
            "neutral",
            "venue_role",
        )
    )


# --- tournaments -----------------------------------------------------------------------------


def tournament_teams(matches: DataFrame, limit: int | None = None) -> DataFrame:
    """Teams of a tournament slice by wins."""
    ranked = (
        team_long(matches)
        .filter(F.col("team").isNotNull())
        .groupBy("team")
        .agg(row_count().alias("matches"), F.sum("is_win").alias("wins"))
        .orderBy(down("wins"), down("matches"), up("team"))
    )
    return ranked if limit is None else ranked.limit(limit)


def tournament_kpis(matches: DataFrame) -> DataFrame:
    """One row for a tournament slice: matches, teams, mean goals, date range."""
    return _kpis(matches).select("matches", "teams", "avg_goals", "first_date", "last_date")


def tournament_by_year(matches: DataFrame) -> DataFrame:
    dated = matches.filter(F.col("year").isNotNull())
    return sort_few(dated.groupBy("year").agg(row_count().alias("matches")), "year")


def biggest_wins_slice(matches: DataFrame, limit: int = 10) -> DataFrame:
    """Largest margins of a slice; then more goals, then the later match. Draws are not excluded."""
    return (
        matches.orderBy(down("goal_difference"), down("total_goals"), down("date"), *tie_break(matches))
        .limit(limit)
        .select(
            "date",
            "home_team",
            "away_team",
            "home_score",
            "away_score",
            "goal_difference",
            "tournament",
            "country",
        )
    )

"""Edge cases of reports and views: missing values, ties, gaps, empty slices; and invariants on the given tables."""

import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from tests.conftest import VALID, as_dicts, changed
from touchline.operators import filters, reshape
from touchline.operators.enrich import conform, enrich_matches
from touchline.operators.profile import column_profile, dataset_profile
from touchline.plans import facts, reports, views

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def matches(spark):
    return fixtures.matches(spark, SF_DIR).cache()


@pytest.fixture(scope="module")
def enriched(matches):
    return enrich_matches(matches)


def play(make, *scores, **common):
    """One match per (home score, away score), a day apart, unless told otherwise."""
    rows = []
    for i, (h, a) in enumerate(scores):
        rows.append(changed(VALID[0], date=f"2024-03-{i + 1:02d}", home_score=h, away_score=a, **common))
    return make(rows)


# --- projections and filters -------------------------------------------------------------------


def test_missing_score_reads_as_a_draw(make):
    row = enrich_matches(play(make, (None, 3))).first()
    assert row["result"] == "Draw" and row["total_goals"] is None
    sides = reshape.team_long(enrich_matches(play(make, (None, 3)))).collect()
    assert [r["match_result"] for r in sides] == ["Draw", "Draw"] and [r["is_draw"] for r in sides] == [1, 1]


def test_conform_adds_absent_columns_and_reads_text(spark):
    df = spark.createDataFrame([("2024-01-05", "A", "B", "2", "x")], "date string, home_team string, away_team string, home_score string, away_score string")
    row = conform(df).first()
    assert row["date"] == date(2024, 1, 5) and row["home_score"] == 2 and row["away_score"] is None
    assert row["tournament"] is None and row["neutral"] is None


def test_input_is_not_changed(valid):
    before = as_dicts(valid)
    enrich_matches(valid).collect()
    assert as_dicts(valid) == before and valid.columns[0] == "date"


def test_team_long_has_two_rows_per_match(enriched):
    long = reshape.team_long(enriched)
    assert long.count() == 2 * enriched.count()
    sums = long.agg(F.sum("goals_for").alias("f"), F.sum("goals_against").alias("a"), F.sum("is_win").alias("w"), F.sum("is_loss").alias("l")).first()
    assert sums["f"] == sums["a"] and sums["w"] == sums["l"]


def test_team_rows_equal_the_filtered_long_table(enriched):
    team = "NATION_3 BUILDING"
    one = reshape.team_rows(enriched, team)
    other = reshape.team_long(enriched).filter(F.col("team") == team)
    assert one.count() > 0 and one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


def test_filters_leave_out_missing_flags(make):
    df = enrich_matches(make([changed(VALID[0], neutral=n) for n in (True, False, None)]))
    assert filters.global_filters(df, venue="neutral").count() == 1
    assert filters.global_filters(df, venue="non_neutral").count() == 1
    assert filters.global_filters(df, tournament="All", team="All", country="All").count() == 3
    with pytest.raises(ValueError):
        filters.global_filters(df, venue="indoor")


def test_year_range_is_inclusive(make):
    days = ["2019-12-31", "2020-01-01", "2021-12-31", "2022-01-01", None]
    df = enrich_matches(make([changed(VALID[0], date=d) for d in days]))
    assert filters.global_filters(df, years=(2020, 2021)).count() == 2
    ordered = filters.global_filters(df, ordered=True).collect()
    assert [r["date"] for r in ordered][-1] is None


def test_search_is_a_pattern_unless_literal(make):
    df = enrich_matches(make([changed(VALID[0], home_team="axb"), changed(VALID[0], home_team="A.B"), changed(VALID[0], home_team=None)]))
    assert filters.match_explorer(df, " a.b ").count() == 2
    assert filters.match_explorer(df, "a.b", literal=True).count() == 1
    assert filters.match_explorer(df, "  ").count() == 3


def test_explorer_drops_missing_totals_and_limits(make):
    df = enrich_matches(play(make, (None, 1), (0, 0), (6, 1), (5, 0)))
    assert filters.match_explorer(df).count() == 3
    assert filters.match_explorer(df, big_wins_only=True).count() == 2
    assert filters.match_explorer(df, draws_only=True).count() == 1
    assert filters.match_explorer(df, limit=1).first()["home_score"] == 5


# --- reports -----------------------------------------------------------------------------------


def test_overview_counts_each_name_once(make):
    df = make([VALID[0], changed(VALID[0], home_team="Mill Town", away_team="Harbour Lions", country=None)])
    row = reports.dataset_overview(df).first()
    assert (row["match_count"], row["unique_team_count"], row["tournament_count"], row["country_count"]) == (2, 2, 1, 1)
    assert reports.dataset_overview(df, approx=True).first().asDict() == row.asDict()


def test_overview_of_nothing(valid):
    row = reports.dataset_overview(valid.limit(0)).first()
    assert row["match_count"] == 0 and row["min_match_date"] is None and row["unique_team_count"] == 0


def test_approximate_overview_is_close(matches):
    exact, close = reports.dataset_overview(matches).first(), reports.dataset_overview(matches, approx=True).first()
    assert abs(exact["unique_team_count"] - close["unique_team_count"]) <= 5


def test_missing_flag_is_a_venue_type_of_its_own(make):
    df = make([changed(VALID[0], neutral=n) for n in (True, None, None)])
    assert {r["venue_type"]: r["match_count"] for r in reports.home_advantage(df).collect()} == {"neutral": 1, "unknown": 2}
    assert [r["neutral_status"] for r in reports.neutral_vs_non_neutral(df).collect()] == ["null", "true"]


def test_rounding_is_half_away_from_zero(make):
    # One of eight: 0.125 keeps its digits at four places and becomes 0.13 at two.
    df = play(make, (1, 0), *[(0, 0)] * 7, neutral=False)
    row = reports.home_advantage_shares(df).first()
    assert row["home_win_share"] == 0.125
    mean = reports.matches_by_year(play(make, (1, 0), (0, 0), (0, 0), (0, 0), (0, 0), (0, 0), (0, 0), (0, 0))).first()
    assert mean["avg_total_goals"] == 0.13


def test_shares_of_an_empty_class_are_missing(valid):
    row = reports.home_advantage_shares(valid.limit(0)).first()
    assert row["non_neutral_matches"] == 0 and row["home_win_share"] is None


def test_ties_are_broken_by_name_and_date(make):
    df = play(make, (3, 0), (3, 0), (0, 3))
    assert [r["match_date"].day for r in reports.biggest_wins_report(df).collect()] == [1, 2, 3]
    teams = reports.most_successful_teams(make([VALID[1]])).collect()
    assert [r["team"] for r in teams] == ["Old Quarry", "Rhone Valley"]


def test_draws_only_count_as_wins_in_the_slice_view(make):
    df = play(make, (0, 0), (2, 1))
    assert reports.biggest_wins(df).count() == 1
    slice_ = views.biggest_wins_slice(enrich_matches(df)).collect()
    assert [r["goal_difference"] for r in slice_] == [1, 0]


def test_group_thresholds_are_arguments(make):
    df = play(make, (1, 0), (2, 0))
    assert reports.tournament_analysis(df).count() == 0
    assert reports.tournament_analysis(df, min_matches=2).first()["avg_goal_difference"] == 1.5
    assert reports.highest_scoring_teams(df, min_matches=2, limit=1).first()["team"] == "Harbour Lions"


def test_facts(make):
    df = make(
        [
            changed(VALID[0], date="2001-05-01", home_score=9, away_score=0, city=None),
            changed(VALID[1], date="2003-05-01", home_score=0, away_score=4, country=None),
            changed(VALID[1], date="2003-06-01"),
        ]
    )
    rows = [(r["fact_name"], r["fact_value"], r["details"]) for r in facts.interesting_facts(df, min_year_matches=2).collect()]
    assert rows == [
        ("Oldest recorded match", "2001-05-01", "Harbour Lions 9:0 Mill Town"),
        ("Most recent recorded match", "2003-06-01", "Rhone Valley 3:3 Old Quarry"),
        ("Most active year", "2003", "2 matches"),
        ("Highest-scoring year (2+ matches)", "2003", "5.00 goals per match across 2 matches"),
        ("Tournament with most matches", "Coast Shield", "3 matches"),
        ("Country hosting the most matches", "Lowland", "2 matches"),
        ("Most frequent host city", "Easton", "2 matches"),
        ("Biggest home win", "9-goal margin", "2001-05-01: Harbour Lions 9:0 Mill Town"),
        ("Biggest away win", "4-goal margin", "2003-05-01: Rhone Valley 0:4 Old Quarry"),
        ("Highest-scoring single match", "9 total goals", "2001-05-01: Harbour Lions 9:0 Mill Town"),
        ("Most common scoreline", "0:4", "1 matches"),
    ]
    assert facts.interesting_facts(df.limit(0)).count() == 0
    assert "Highest-scoring year (50+ matches)" not in {r["fact_name"] for r in facts.interesting_facts(df).collect()}


# --- views -------------------------------------------------------------------------------------


def test_shares_add_up(enriched):
    total = views.outcome_distribution(enriched).agg(F.sum("share_pct")).first()[0]
    assert total == pytest.approx(100)
    per_venue = views.venue_comparison(enriched).groupBy("venue_type").agg(F.sum("share_pct").alias("s")).collect()
    assert all(r["s"] == pytest.approx(100) for r in per_venue)


def test_ranking_adds_up(enriched):
    ranking = views.team_ranking(enriched)
    assert ranking.filter("wins + draws + losses <> matches").count() == 0
    sums = ranking.agg(F.sum("matches").alias("m"), F.sum("goal_difference").alias("d")).first()
    assert sums["m"] == 2 * enriched.count() and sums["d"] == 0


def test_absent_result_can_be_kept(make):
    df = enrich_matches(play(make, (1, 0)))
    assert [r["result"] for r in views.outcome_distribution(df).collect()] == ["Home win"]
    kept = views.outcome_distribution(df, keep_absent=True).collect()
    assert [(r["result"], r["share"]) for r in kept] == [("Home win", 1.0), ("Draw", None), ("Away win", None)]


def test_year_without_non_neutral_matches_has_no_home_share(make):
    df = enrich_matches(make([changed(VALID[0], neutral=True), changed(VALID[0], date="2025-01-01")]))
    trends = views.yearly_trends(df)
    assert [r["home_win_share"] for r in trends.collect()] == [None, 100.0]
    assert [r["year"] for r in views.with_home_win_share(trends).collect()] == [2025]


def test_rolling_mean_counts_rows_and_skips_nulls(make):
    years = [2000, 2001, 2005, 2006]
    rows = [changed(VALID[0], date=f"{y}-01-01", home_score=i, neutral=(y == 2001)) for i, y in enumerate(years)]
    trends = views.yearly_trends(enrich_matches(make(rows)))
    smooth = views.smooth_yearly(trends, 2).orderBy("year").collect()
    assert [r["avg_goals"] for r in smooth] == [None, 1.5, 2.5, 3.5]
    assert [r["home_win_share"] for r in smooth] == [None, None, None, 100.0]
    assert as_dicts(views.smooth_yearly(trends, 1)) == as_dicts(trends)
    assert all(r["matches"] is None for r in views.smooth_yearly(trends, 10).collect())


def test_absent_venue_class(make):
    df = enrich_matches(make([changed(VALID[0], neutral=True)]))
    row = views.home_win_shift(df).first()
    assert row["non_neutral_home_win_pct"] is None and row["neutral_home_win_pct"] == 100.0
    table = views.home_advantage_table(df).collect()
    assert [(r["venue_type"], r["draw_share"]) for r in table] == [("Neutral", 0.0)]


def test_missing_flag_counts_as_not_neutral_in_the_insights(make):
    df = enrich_matches(make([changed(VALID[0], neutral=n) for n in (True, None, None, False)]))
    assert views.overview_insights(df).first()["neutral_pct"] == 25.0
    assert views.overview_insights(df.limit(0)).count() == 0


def test_insights_break_ties_by_the_first_name(make):
    df = enrich_matches(make([changed(VALID[0], tournament="B", date="2001-01-01"), changed(VALID[0], tournament="A", date="2000-01-01")]))
    row = views.overview_insights(df).first()
    assert row["peak_year"] == 2000 and row["top_tournament"] == "A"


def test_summary_of_no_rows_is_zero(valid):
    row = views.team_summary(reshape.team_rows(enrich_matches(valid), "Nobody")).first()
    assert set(row.asDict().values()) == {0}


def test_team_views(make):
    df = enrich_matches(play(make, (1, 0), (0, 0), (0, 2)))
    rows = reshape.team_rows(df, "Mill Town")
    summary = views.team_summary(rows).first()
    assert (summary["wins"], summary["draws"], summary["losses"], summary["goals_for"]) == (1, 1, 1, 2)
    assert [r["date"].day for r in views.team_latest_matches(rows, 2).collect()] == [3, 2]
    assert views.team_top_opponents(rows).first()["opponent"] == "Harbour Lions"
    long = reshape.team_results_long(views.team_yearly_results(rows)).collect()
    assert {(r["result_type"], r["result_count"]) for r in long} == {("wins", 1), ("draws", 1), ("losses", 1)}


def test_histogram(make):
    df = enrich_matches(play(make, (1, 0), (2, 1), (2, 2), (None, 1)))
    assert [(r["bin_start"], r["matches"]) for r in views.goals_histogram(df, width=2).collect()] == [(0, 1), (2, 1), (4, 1)]


def test_filter_options(make):
    df = enrich_matches(make([VALID[0], changed(VALID[0], date="2020-02-02", country=None, home_team=None)]))
    got = [(r["dimension"], r["value"]) for r in views.filter_options(df).collect()]
    assert got == [
        ("country", "Lowland"),
        ("team", "Harbour Lions"),
        ("team", "Mill Town"),
        ("tournament", "Coast Shield"),
        ("year_max", "2024"),
        ("year_min", "2020"),
    ]


# --- profile -----------------------------------------------------------------------------------


def test_profile(spark):
    rows = [("1999-07-31", h, "Mill Town", 2, a, c, n) for h, a, c, n in [("Lions", 5, "Shield", True), ("Miners", 2, "Trophy", None)]]
    rows.append((None, "Lions", "Quarry", 0, 6, "Shield", False))
    names = "date string, home_team string, away_team string, home_score bigint, away_score bigint, tournament string, neutral boolean"
    df = spark.createDataFrame(rows, names).withColumn("date", F.to_date("date"))
    columns = {r["column_name"]: r for r in column_profile(df).collect()}
    assert columns["date"]["missing_count"] == 1 and columns["date"]["missing_pct"] == 33.33
    assert columns["date"]["data_type"] == "date" and columns["home_team"]["distinct_count"] == 2
    row = dataset_profile(df.unionByName(df.limit(1)), "m.csv").first()
    assert row["duplicate_row_count"] == 1 and row["row_count"] == 4 and row["column_count"] == 7
    assert (row["date_min"], row["date_max"]) == ("1999-07-31", "1999-07-31")
    assert (row["home_team_count"], row["away_team_count"], row["tournament_count"]) == (2, 2, 2)
    close = {r["column_name"]: r.asDict() for r in column_profile(df, approx=True).collect()}
    assert close == {k: v.asDict() for k, v in columns.items()}


def test_profile_without_or_with_text_dates(spark):
    df = spark.createDataFrame([("bad-date", "x"), ("2024-01-03", None)], "date string, home_team string")
    row = dataset_profile(df, "m.csv").first()
    assert row["date_min"] is None and row["home_team_count"] == 1 and row["tournament_count"] is None
    assert dataset_profile(df.drop("date"), "m.csv").first()["date_max"] is None


def test_profile_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "date date, home_team string")
    assert dataset_profile(df, "m.csv").first()["row_count"] == 0
    assert [(r["column_name"], r["missing_pct"], r["distinct_count"]) for r in column_profile(df).orderBy("position").collect()] == [
        ("date", 0.0, 0),
        ("home_team", 0.0, 0),
    ]


# --- column profile over sources that cost more than their bytes -----------------------------------


def by_name(df):
    return {r["column_name"]: (r["position"], r["data_type"], r["missing_count"], r["missing_pct"], r["distinct_count"]) for r in column_profile(df).collect()}


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Scan (?:csv|parquet|ExistingRDD)", plan))


def test_column_profile_evaluates_a_text_source_once(spark, tmp_path):
    rows = spark.range(4000).select(
        F.col("id").alias("a"), (F.col("id") % 7).alias("b"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("x"), F.col("id") % 11)).alias("c"), F.lit(None).cast("string").alias("d")
    )
    rows.write.option("header", True).csv(str(tmp_path / "text"))
    rows.write.parquet(str(tmp_path / "columns"))
    text = spark.read.option("header", True).schema("a bigint, b bigint, c string, d string").csv(str(tmp_path / "text"))
    stored = spark.read.parquet(str(tmp_path / "columns"))
    assert scans(column_profile(text)) == 1 and scans(column_profile(stored)) == 4
    assert by_name(text) == by_name(stored)
    assert by_name(text)["c"] == (3, "string", 1334, 33.35, 11) and by_name(text)["d"][2:] == (4000, 100.0, 0)
    joined = stored.join(text.select(F.col("a").alias("key")), F.col("a") == F.col("key"))
    assert by_name(joined)["b"] == by_name(stored)["b"] and scans(column_profile(joined)) <= 2


def test_column_profile_tells_values_of_any_type_apart(spark):
    rows = [
        (0.0, datetime(2024, 10, 27, 0, 30), b"a", [1], "2024-01-01", Decimal("1.10")),
        (-0.0, datetime(2024, 10, 27, 1, 30), b"A", [1], "2024-01-02", Decimal("1.1")),
        (float("nan"), datetime(2024, 10, 27, 0, 30), b"", None, None, Decimal("1.11")),
        (float("nan"), None, None, [2], "", None),
    ]
    df = spark.createDataFrame(rows, "f double, t timestamp, b binary, l array<int>, `odd.name` string, n decimal(9,2)")
    want = {c: df.groupBy(F.col(f"`{c}`").alias("v")).count().filter("v is not null").count() for c in df.columns}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # an hour that comes twice
        found = by_name(df)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert {c: found[c][4] for c in df.columns} == want == {"f": 2, "t": 2, "b": 3, "l": 2, "odd.name": 3, "n": 2}


def test_column_profile_of_frames_without_rows_or_columns(spark):
    empty = spark.createDataFrame([], "place int, value string, copies double, rows array<int>")
    assert {c: v[2:] for c, v in by_name(empty).items()} == {c: (0, 0.0, 0) for c in empty.columns}
    with_clashes = spark.createDataFrame([(1, "a", 2.0, [1]), (None, "a", 3.0, [1])], empty.schema)
    assert {c: v[4] for c, v in by_name(with_clashes).items()} == {"place": 1, "value": 1, "copies": 2, "rows": 1}

"""What the physical plans must look like for the queries to hold at any size."""

import re

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from touchline.operators import filters, reshape
from touchline.operators.enrich import enrich_matches
from touchline.operators.quality import validate_matches
from touchline.plans import facts, reports, views
from touchline.session import session_conf


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> int:
    return plan(df).count("FileScan parquet")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The derived matches as a Parquet table, as a load leaves them."""
    path = str(tmp_path_factory.mktemp("stored") / "matches")
    fixtures.matches(spark, "/root/testdata/sf0.01").write.parquet(path)
    return spark.read.parquet(path)


def test_year_range_reaches_the_scan(stored):
    text = plan(filters.global_filters(enrich_matches(stored), years=(1994, 1996), country="NATION_1", venue="neutral"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for part in ("GreaterThanOrEqual(match_date", "LessThan(match_date", "EqualTo(country", "EqualTo(neutral"):
        assert part in pushed


def test_either_side_filter_reaches_the_scan(stored):
    text = plan(views.team_summary(reshape.team_rows(enrich_matches(stored), "NATION_1 BUILDING")))
    assert "Or(EqualTo(home_team" in re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)


def test_only_needed_columns_are_read(stored):
    text = plan(reports.home_advantage(stored))
    assert "ReadSchema: struct<home_score:int,away_score:int,neutral:boolean>" in text
    text = plan(views.team_ranking(enrich_matches(stored)))
    assert "tournament" not in re.search(r"ReadSchema: (.*)", text).group(1)


@pytest.mark.parametrize(
    ("query", "reads"),
    [
        # One narrow scan per distinct count, none of them wider than its column.
        (reports.dataset_overview, 4),
        (reports.most_successful_teams, 1),
        (reports.highest_scoring_teams, 1),
        (lambda m: views.overview_insights(enrich_matches(m)), 2),
        (lambda m: views.yearly_trends(enrich_matches(m)), 1),
        (lambda m: views.venue_comparison(enrich_matches(m)), 1),
        (lambda m: views.home_advantage_table(enrich_matches(m)), 1),
        (lambda m: views.team_ranking(enrich_matches(m)), 1),
        (lambda m: validate_matches(m.withColumnRenamed("match_date", "date"), duplicates=False), 1),
    ],
)
def test_number_of_scans(stored, query, reads):
    assert scans(query(stored)) == reads


def test_facts_read_the_matches_twice(stored):
    """All counts and extreme values come from one aggregate over grouping sets, the matches that reach an extreme from a second scan."""
    counts = facts._counts(stored, 50)
    assert scans(counts) == 1 and len(re.findall(r"\bExpand\b", plan(counts))) == 1
    assert scans(facts.interesting_facts(stored)) == 1


def test_distinct_counts_do_not_multiply_rows(stored):
    columns = re.findall(r"ReadSchema: struct<(.*?)>", plan(reports.dataset_overview(stored)))
    assert {"tournament:string", "country:string", "match_date:date"} <= set(columns)


@pytest.mark.parametrize(
    "query",
    [
        reports.biggest_wins_report,
        reports.biggest_wins,
        reports.most_successful_teams,
        reports.tournament_summary,
        lambda m: views.biggest_wins_slice(enrich_matches(m)),
        lambda m: filters.match_explorer(enrich_matches(m)),
        lambda m: views.top_host_cities(enrich_matches(m)),
    ],
)
def test_top_k_never_sorts_everything(stored, query):
    text = plan(query(stored))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


@pytest.mark.parametrize(
    "query",
    [
        reports.dataset_overview,
        reports.home_advantage,
        reports.most_successful_teams,
        facts.interesting_facts,
        lambda m: views.team_ranking(enrich_matches(m)),
        lambda m: views.yearly_trends(enrich_matches(m)),
        lambda m: views.overview_insights(enrich_matches(m)),
        lambda m: views.filter_options(enrich_matches(m)),
    ],
)
def test_rows_are_merged_before_they_are_shuffled(stored, query):
    """Every exchange sits above an aggregate (or a result already aggregated), so a hot key never travels row by row."""
    text = plan(query(stored))
    assert "Join" not in text and "CartesianProduct" not in text
    lines = [line.strip(" :+-*()0123456789") for line in text.splitlines()]
    for i, line in enumerate(lines):
        if line.startswith("Exchange"):
            assert any("Aggregate" in below for below in lines[i + 1 :])
            assert not re.match(r"FileScan|Scan|ColumnarToRow|Expand", lines[i + 1])


def test_reports_stay_in_generated_code(stored):
    spark = stored.sparkSession
    with session_conf(spark, spark__sql__adaptive__enabled="false"):
        lines = plan(reports.most_successful_teams(stored)).splitlines()
    for line in lines:
        if re.search(r"HashAggregate|Expand|Project \[|Filter ", line):
            assert re.search(r"\*\(\d+\)", line), line


def test_no_python_workers(stored):
    for query in (facts.interesting_facts, lambda m: validate_matches(m.withColumnRenamed("match_date", "date"))):
        assert "Python" not in plan(query(stored)) and "Pandas" not in plan(query(stored))


def test_hot_keys_give_whole_results(spark):
    """A third of all rows share one team, tournament, city and day."""
    n = 30_000
    hot = F.col("id") % 3 == 0
    rows = spark.range(n).select(
        F.when(hot, F.lit("2024-06-01").cast("date")).otherwise(F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 3000).cast("int"))).alias("date"),
        F.when(hot, "Hot").otherwise(F.concat(F.lit("T"), F.col("id") % 500)).alias("home_team"),
        F.concat(F.lit("U"), F.col("id") % 700).alias("away_team"),
        (F.col("id") % 5).alias("home_score"),
        (F.col("id") % 4).alias("away_score"),
        F.when(hot, "Cup").otherwise(F.concat(F.lit("C"), F.col("id") % 40)).alias("tournament"),
        F.when(hot, "City").alias("city"),
        F.lit("Land").alias("country"),
        F.lit(False).alias("neutral"),
    )
    m = enrich_matches(rows)
    ranking = {r["team"]: r for r in views.team_ranking(m).collect()}
    assert ranking["Hot"]["matches"] == n // 3 and sum(r["matches"] for r in ranking.values()) == 2 * n
    assert views.top_tournaments(m).first().asDict() == {"tournament": "Cup", "matches": n // 3}
    assert filters.global_filters(m, ordered=True).count() == n
    assert reshape.team_rows(m, "Hot").count() == n // 3

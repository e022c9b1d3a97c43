"""Sums per source against the reports over the rows themselves."""

import re
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from touchline import contract as C
from touchline.operators import quality
from touchline.operators.enrich import enrich_matches
from touchline.plans import jobs, reports, rollups, views
from touchline.sources.outputs import export_slice
from touchline.sources.table import ensure_matches_table, load_matches, read_matches_table

REPORTS = {
    "home_advantage": reports.home_advantage,
    "neutral_vs_non_neutral": reports.neutral_vs_non_neutral,
    "matches_by_year": reports.matches_by_year,
    "team_ranking": views.team_ranking,
    "most_successful_teams": reports.most_successful_teams,
    "highest_scoring_teams": reports.highest_scoring_teams,
    "tournament_analysis": reports.tournament_analysis,
    "tournament_summary": reports.tournament_summary,
}
AS_OF = date(1995, 6, 1)


@pytest.fixture(scope="module")
def matches(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rollups") / "rows")
    rows = fixtures.matches(spark, "/root/testdata/sf0.001")
    rows.select("match_id", F.col("match_date").alias("date"), *C.CONTRACT[1:]).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def table(spark, tmp_path):
    name = "sums_" + uuid.uuid4().hex
    ensure_matches_table(spark, name, str(tmp_path / name))
    return name


def load(spark, rows, table, source, **more):
    return load_matches(spark, rows.select(*C.CONTRACT), table, source, **more)


def lines(df):
    return sorted(map(str, df.collect()))


def assert_equal_reports(spark, table, names=("home_advantage", "team_ranking")):
    """names are the reports to compare besides the validation: two of the sums in most steps, all of them in some."""
    rows = read_matches_table(spark, table)
    for name in names:
        report = REPORTS[name]
        found, wanted = getattr(rollups, name)(spark, table), report(rows)
        assert set(found.columns) == set(wanted.columns), name
        assert found.select(wanted.columns).collect() == wanted.collect(), name
    contract = rows.select(*C.CONTRACT)
    wanted = quality.validate_matches(contract, AS_OF, duplicates=False)
    assert lines(rollups.validate_table(spark, table, AS_OF)) == lines(wanted)


def read_sources(df):
    """The sources whose data files a plan reads."""
    return {re.search(r"/source_file=([^/]*)/", p)[1] for p in df.inputFiles() if "/_summaries/" not in p}


def test_reports_before_and_after_each_step(spark, matches, table):
    assert_equal_reports(spark, table)
    assert rollups.refresh(spark, table) == []
    load(spark, matches, table, "first.csv")
    assert_equal_reports(spark, table)
    assert rollups.refresh(spark, table) == ["first.csv"]
    assert rollups.refresh(spark, table) == []
    # One source with sums, one without, with rows that the first holds too.
    load(spark, matches.filter("neutral"), table, "second.csv")
    assert_equal_reports(spark, table, REPORTS)
    contract = read_matches_table(spark, table).select(*C.CONTRACT)
    for as_of in (date(1990, 1, 1), None):
        wanted = quality.validate_matches(contract, as_of)
        assert lines(rollups.validate_table(spark, table, as_of, duplicates=True)) == lines(wanted)
    assert rollups.refresh(spark, table) == ["second.csv"]
    # Sums of replaced rows are not found again.
    load(spark, matches.filter("NOT neutral"), table, "first.csv", replace=True)
    assert_equal_reports(spark, table)
    assert rollups.refresh(spark, table) == ["first.csv"]
    assert_equal_reports(spark, table, REPORTS)


def test_only_new_sources_are_read(spark, matches, table):
    load(spark, matches, table, "old.csv")
    rollups.refresh(spark, table)
    load(spark, matches.filter("neutral"), table, "new.csv")
    for kind in rollups.KINDS:
        plan = rollups.sums(spark, table, kind)._jdf.queryExecution().executedPlan().toString()
        scan = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)[1]
        assert "coalesce(source_file" in plan and "new.csv" in plan and "old.csv" not in scan
    rollups.refresh(spark, table)
    location = rollups.table_location(spark, table)
    for kind in rollups.KINDS:
        assert read_sources(rollups.sums(spark, table, kind)) == set(), location
    assert read_sources(rollups.team_ranking(spark, table)) == set()
    assert read_sources(rollups.home_advantage(spark, table)) == set()


def test_source_names_with_signs_and_numbers(spark, matches, table):
    names = ["2020", "a b=c%25.csv", "größe/it's #1?.csv", ""]
    for name in names:
        load(spark, matches.limit(5), table, name)
    assert sorted(rollups.stamps(spark, table)) == sorted(names)
    assert rollups.refresh(spark, table) == sorted(names)
    assert rollups.refresh(spark, table) == []
    load(spark, matches.limit(7), table, "a b=c%25.csv", replace=True)
    assert rollups.refresh(spark, table) == ["a b=c%25.csv"]
    assert_equal_reports(spark, table)
    assert rollups.drop_stale(spark, table) == len(rollups.KINDS)
    assert rollups.drop_stale(spark, table) == 0
    assert_equal_reports(spark, table)


def test_removed_source_and_repeated_sums(spark, matches, table):
    load(spark, matches, table, "kept.csv")
    load(spark, matches.limit(50), table, "gone.csv")
    rollups.refresh(spark, table)
    location = rollups.table_location(spark, table)
    rollups.files.delete(spark, f"{location}/source_file=gone.csv")
    assert_equal_reports(spark, table)
    # A refresh that starts again after it lost one kind writes that kind only, and nothing twice.
    rollups.files.delete(spark, f"{location}/_summaries/teams")
    assert rollups.refresh(spark, table) == ["kept.csv"]
    assert_equal_reports(spark, table)


def test_load_job_keeps_the_sums(spark, matches, table, tmp_path):
    path = str(tmp_path / "season.csv")
    export_slice(enrich_matches(matches), path)
    jobs.load_job(spark, path, table, summarize=True)
    assert read_sources(rollups.team_ranking(spark, table)) == set()
    assert_equal_reports(spark, table)

"""Every operator as a query (spark, sf_dir) -> DataFrame over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from touchline import contract as C
from touchline.functions import parsing
from touchline.functions.text import strip_strings
from touchline.operators import filters, profile, quality, reshape, standardize
from touchline.operators.enrich import enrich_matches
from touchline.operators.mapping import apply_mapping, mapping_report
from touchline.plans import facts, jobs, reports, rollups, views
from touchline.session import scratch_path
from touchline.sources import csv, outputs, table

Query = Callable[[SparkSession, str], DataFrame]

TEAM = "NATION_0 AUTOMOBILE"
TOURNAMENT = "HOUSEHOLD 5-LOW"
AS_OF = date(1998, 1, 1)


def _on_matches(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(fixtures.matches(spark, sf_dir))


def _on_enriched(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(enrich_matches(fixtures.matches(spark, sf_dir)))


def _on_team(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_enriched(lambda m: fn(reshape.team_rows(m, TEAM)))


def _on_tournament(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_enriched(lambda m: fn(filters.global_filters(m, tournament=TOURNAMENT)))


def _on_raw(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(fixtures.raw_matches(spark, sf_dir))


def _as_read(raw: DataFrame) -> DataFrame:
    """Raw rows as a scan would give them had the file used the contract's names."""
    named = strip_strings(apply_mapping(raw, fixtures.RAW_MAPPING))
    return named.withColumn("date", parsing.parse_date(F.col("date"), named.schema["date"].dataType))


def _contract_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixtures.matches(spark, sf_dir)
    return m.select(F.col("match_date").alias("date"), *C.CONTRACT[1:])


def _standardized(raw: DataFrame) -> DataFrame:
    return standardize.standardize_matches(raw, fixtures.RAW_MAPPING, AS_OF)[0]


def _audit(raw: DataFrame) -> DataFrame:
    return standardize.audit_lines(standardize.standardize_matches(raw, fixtures.RAW_MAPPING, AS_OF)[1])


def _score_coercion(raw: DataFrame) -> DataFrame:
    text = F.col("h_points")
    kind = raw.schema["h_points"].dataType
    return (
        raw.groupBy(text.alias("raw_score"), parsing.parse_score(text, kind).alias("score"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def _neutral_normalization(raw: DataFrame) -> DataFrame:
    text = F.col("elsewhere")
    return raw.groupBy(text.alias("raw_neutral"), parsing.normalize_neutral(text).alias("neutral")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def _new_table(spark: SparkSession) -> str:
    """A table of its own for this run, with its files in the scratch folder."""
    place = scratch_path(spark, "matches")
    name = "check_matches_" + place.rsplit("-", 1)[-1]
    table.ensure_matches_table(spark, name, place)
    return name


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw") + ".csv"
    outputs.write_output(fixtures.raw_matches(spark, sf_dir), path, fmt="csv")
    return csv.read_matches_csv(spark, path)


def _csv_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "drop")
    outputs.write_output(fixtures.raw_matches(spark, sf_dir), path, fmt="csv")
    rows = csv.read_matches_dir(spark, path)
    return rows.groupBy("event").agg(F.count(F.lit(1)).alias("row_count"))


def _csv_multi_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes of two lines with quotes in them, written and read by many tasks."""
    path = scratch_path(spark, "lines") + ".csv"
    note = F.concat("remark", F.lit('\n"'), F.trim("event"), F.lit('"'))
    outputs.write_output(fixtures.raw_matches(spark, sf_dir).select("match_date", "home", note.alias("note")), path, fmt="csv")
    return csv.read_matches_csv(spark, path, multi_line=True)


def _csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of neutral matches in contract order and of others in reverse order without the city, three files each."""
    path = scratch_path(spark, "mixed")
    rows = _contract_rows(spark, sf_dir).withColumn("played", F.col("date"))
    rest = [c for c in reversed(rows.columns) if c != "city"]
    for part in (rows.filter("neutral"), rows.filter("NOT neutral").select(rest)):
        part.repartition(3).write.mode("append").option("header", True).csv(path)
    read = csv.read_matches_dir(spark, path)
    read = read.filter("source_file LIKE 'part-%'").groupBy("neutral", F.year("date").alias("year"))
    return read.agg(F.count(F.lit(1)).alias("row_count"), F.count("city").alias("with_city"), F.count_distinct("source_file").alias("file_count"))


def _mapping_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = {k: v for k, v in fixtures.RAW_MAPPING.items() if k != "tournament"} | {"venue": " Event", "city": "town", "away_team": "HOME"}
    return mapping_report(fixtures.raw_matches(spark, sf_dir), wrong)


def _export_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "slice") + ".csv"
    m = enrich_matches(fixtures.matches(spark, sf_dir))
    outputs.export_slice(filters.global_filters(m, years=(1994, 1996), venue="neutral"), path)
    return csv.read_matches_csv(spark, path)


def _load_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of one source, the second replacing the first."""
    name = _new_table(spark)
    rows = _contract_rows(spark, sf_dir)
    table.load_matches(spark, rows, name, "season.csv")
    table.load_matches(spark, rows, name, "season.csv", replace=True)
    return spark.table(name).select(*C.LOAD_COLUMNS)


def _rows_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table load next to the load of a CSV export of the neutral matches."""
    name = _new_table(spark)
    path = scratch_path(spark, "neutral")
    m = enrich_matches(fixtures.matches(spark, sf_dir))
    outputs.export_slice(filters.global_filters(m, venue="neutral"), f"{path}/neutral.csv")
    table.load_matches(spark, _contract_rows(spark, sf_dir), name, "all.csv")
    jobs.load_job(spark, f"{path}/neutral.csv", name)
    return table.rows_by_source(spark, name)


def _summed(kinds: tuple[str, ...], fn: Callable[[SparkSession, str], DataFrame]) -> Query:
    """A report from sums per source: of one source first, then of a second one that was loaded next to it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        name = _new_table(spark)
        rows = _contract_rows(spark, sf_dir)
        for source, part in {"first.csv": rows.filter("neutral"), "second.csv": rows.filter("neutral IS NOT TRUE")}.items():
            table.load_matches(spark, part, name, source)
            rollups.refresh(spark, name, kinds)
        return fn(spark, name)

    return query


def _open_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _new_table(spark)
    table.load_matches(spark, _contract_rows(spark, sf_dir), name, "season.csv")
    rows, label = table.open_matches(spark, name)
    kind = F.lit(label.split(":")[0]).alias("source_kind")
    return rows.groupBy("tournament").agg(F.count(F.lit(1)).alias("row_count"), F.max("date").alias("last_date")).select("*", kind)


def _open_matches_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report over a CSV export, opened because there is no table."""
    path = scratch_path(spark, "fallback") + ".csv"
    outputs.export_slice(enrich_matches(fixtures.matches(spark, sf_dir)), path)
    return reports.most_successful_teams(table.open_matches(spark, None, path)[0])


def _standardize_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows exported under their own names, standardised and published by the job."""
    path = scratch_path(spark, "standardize")
    source, target = f"{path}/source.csv", f"{path}/out"
    outputs.export_slice(enrich_matches(fixtures.matches(spark, sf_dir)), source)
    jobs.standardize_job(spark, source, {c: c for c in C.CONTRACT}, target)
    return spark.read.parquet(target)


def _load_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids after the loads of two sources: unique and without gaps."""
    name = _new_table(spark)
    rows = _contract_rows(spark, sf_dir)
    table.load_matches(spark, rows, name, "first.csv")
    table.load_matches(spark, rows, name, "second.csv")
    return spark.table(name).agg(
        F.count(F.lit(1)).alias("row_count"), F.min("match_id").alias("first_id"), F.max("match_id").alias("last_id"),
        F.count_distinct("match_id").alias("distinct_ids"),
    )


def _standardize_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with days first in every other row and a time of day in the others, standardised and published by the job."""
    path = scratch_path(spark, "layouts")
    source, target = f"{path}/source.csv", f"{path}/out"
    day = F.when(F.col("match_id") % 2 == 0, F.date_format("match_date", "dd/MM/yyyy")).otherwise(
        F.date_format("match_date", "yyyy-MM-dd'T'HH:mm:ss")
    )
    rows = fixtures.matches(spark, sf_dir).withColumn("played", day).select("played", *C.CONTRACT[1:])
    outputs.write_output(rows, source, fmt="csv")
    layouts = (*C.DATE_FORMATS, (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"))
    mapping = {"date": "played"} | {c: c for c in C.CONTRACT[1:]}
    jobs.standardize_job(spark, source, mapping, target, date_formats=layouts)
    return spark.read.parquet(target)


def _profile_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored column profile of a CSV file."""
    path = scratch_path(spark, "profiled")
    outputs.write_output(fixtures.raw_matches(spark, sf_dir), f"{path}/raw.csv", fmt="csv")
    jobs.profile_job(spark, f"{path}/raw.csv", f"{path}/out", AS_OF)
    return spark.read.parquet(f"{path}/out/column_profile")


def _validation_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that only fire on frames of another shape: a text date, no tournament, no rows."""
    rows = _contract_rows(spark, sf_dir)
    shapes = {
        "text date": rows.withColumn("date", F.col("date").cast("string")),
        "no tournament": rows.drop("tournament"),
        "no rows": rows.filter(F.year("date") < 1900),
    }
    reports_ = [quality.validate_matches(df, AS_OF, duplicates=False).withColumn("shape", F.lit(s)) for s, df in shapes.items()]
    return reports_[0].unionByName(reports_[1]).unionByName(reports_[2])


def _smoothed(window: int) -> Query:
    return _on_enriched(lambda m: views.smooth_yearly(views.yearly_trends(m), window))


def queries() -> dict[str, Query]:
    return {
        # sources and sinks
        "csv_roundtrip": _csv_roundtrip,
        "csv_directory": _csv_directory,
        "csv_multi_line": _csv_multi_line,
        "csv_mixed_headers": _csv_mixed_headers,
        "mapping_check": _mapping_check,
        "export_slice": _export_slice,
        "standardize_job": _standardize_job,
        "load_matches": _load_matches,
        "rows_by_source": _rows_by_source,
        "rollup_home_advantage": _summed(("venues",), rollups.home_advantage),
        "rollup_team_ranking": _summed(("teams",), rollups.team_ranking),
        "rollup_tournament_summary": _summed(("tournaments",), rollups.tournament_summary),
        "rollup_validation": _summed(("rules", "days"), lambda s, name: rollups.validate_table(s, name, AS_OF)),
        "open_matches": _open_matches,
        "open_matches_file": _open_matches_file,
        "load_ids": _load_ids,
        "standardize_layouts": _standardize_layouts,
        "profile_job": _profile_job,
        "prepare_for_load": lambda s, d: table.prepare_for_load(_contract_rows(s, d), "season.csv"),
        # standardisation, quality, profile
        "standardize_matches": _on_raw(_standardized),
        "transform_audit": _on_raw(_audit),
        "score_coercion": _on_raw(_score_coercion),
        "neutral_normalization": _on_raw(_neutral_normalization),
        "validation_report": _on_raw(lambda r: quality.validate_matches(_as_read(r), AS_OF, stripped=True)),
        "validation_summary": _on_raw(
            lambda r: quality.validation_summary(_as_read(r), AS_OF, stripped=True).drop("errors", "warnings")
        ),
        "validation_edge": _validation_edge,
        "dataset_profile": _on_raw(lambda r: profile.dataset_profile(_as_read(r), "raw.csv")),
        "column_profile": _on_raw(lambda r: profile.column_profile(_as_read(r))),
        # projections and filters
        "enrich_matches": _on_matches(enrich_matches),
        "team_long": _on_enriched(reshape.team_long),
        "unique_teams": _on_matches(reshape.unique_teams),
        "global_filters": _on_enriched(
            lambda m: filters.global_filters(m, years=(1993, 1997), country="NATION_0", venue="non_neutral", ordered=True)
        ),
        "global_filters_team": _on_enriched(
            lambda m: filters.global_filters(m, years=(1993, None), tournament="AUTOMOBILE 5-LOW", team=TEAM, venue="neutral")
        ),
        "match_explorer": _on_enriched(lambda m: filters.match_explorer(m, "nation_1.*build", min_total_goals=3)),
        "match_explorer_draws": _on_enriched(lambda m: filters.match_explorer(m, "NATION_2 ", draws_only=True, literal=True)),
        "match_explorer_big_wins": _on_enriched(lambda m: filters.match_explorer(m, big_wins_only=True, limit=100)),
        # reports
        "dataset_overview": _on_matches(reports.dataset_overview),
        "matches_by_year": _on_matches(reports.matches_by_year),
        "home_advantage": _on_matches(reports.home_advantage),
        "most_successful_teams": _on_matches(reports.most_successful_teams),
        "highest_scoring_teams": _on_matches(reports.highest_scoring_teams),
        "biggest_wins_report": _on_matches(reports.biggest_wins_report),
        "tournament_analysis": _on_matches(reports.tournament_analysis),
        "score_quality_review": _on_matches(reports.score_quality_review),
        "interesting_facts": _on_matches(facts.interesting_facts),
        "top_scoring_teams": _on_matches(reports.top_scoring_teams),
        "biggest_wins": _on_matches(reports.biggest_wins),
        "home_advantage_shares": _on_matches(reports.home_advantage_shares),
        "neutral_vs_non_neutral": _on_matches(reports.neutral_vs_non_neutral),
        "tournament_summary": _on_matches(reports.tournament_summary),
        "score_quality_check": _on_matches(reports.score_quality_check),
        # views
        "overview_kpis": _on_enriched(views.overview_kpis),
        "overview_insights": _on_enriched(views.overview_insights),
        "filter_options": _on_enriched(views.filter_options),
        "outcome_distribution": _on_enriched(views.outcome_distribution),
        "goals_histogram": _on_enriched(views.goals_histogram),
        "goals_histogram_2": _on_enriched(lambda m: views.goals_histogram(m, 2)),
        "scoreline_frequency": _on_enriched(views.scoreline_frequency),
        "top_tournaments": _on_enriched(views.top_tournaments),
        "top_host_countries": _on_enriched(views.top_host_countries),
        "top_host_cities": _on_enriched(views.top_host_cities),
        "matches_per_year": _on_enriched(views.matches_per_year),
        "yearly_trends": _on_enriched(views.yearly_trends),
        "yearly_trends_known": _on_enriched(lambda m: views.with_home_win_share(views.yearly_trends(m))),
        "yearly_trends_smoothed": _smoothed(3),
        "yearly_trends_smoothed_5": _smoothed(5),
        "venue_comparison": _on_enriched(views.venue_comparison),
        "home_advantage_table": _on_enriched(views.home_advantage_table),
        "home_win_shift": _on_enriched(views.home_win_shift),
        "team_ranking": _on_enriched(views.team_ranking),
        "top_teams_by_wins": _on_enriched(views.top_teams_by_wins),
        "top_teams_by_win_rate": _on_enriched(views.top_teams_by_win_rate),
        "top_teams_by_avg_goals": _on_enriched(views.top_teams_by_avg_goals),
        "team_summary": _on_team(views.team_summary),
        "team_yearly_results": _on_team(views.team_yearly_results),
        "team_results_long": _on_team(lambda r: reshape.team_results_long(views.team_yearly_results(r))),
        "team_top_opponents": _on_team(views.team_top_opponents),
        "team_latest_matches": _on_team(views.team_latest_matches),
        "tournament_teams": _on_tournament(views.tournament_teams),
        "tournament_kpis": _on_tournament(views.tournament_kpis),
        "tournament_by_year": _on_tournament(views.tournament_by_year),
        "biggest_wins_slice": _on_tournament(views.biggest_wins_slice),
    }

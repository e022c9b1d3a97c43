"""Sums per source of the matches table, from which reports and checks on the whole table are answered.

A load changes one source, so sums are kept per source: `refresh` reads only the sources that changed, and a report adds the sums up.
They lie in a hidden folder of the table, under a stamp made of the names of the source's data files. A load gives its files new
names, so sums of replaced or removed rows are never found again, whoever replaced them. Sources without sums are summed when a
report asks for them; results are therefore right at any moment, and `refresh` only decides how much is read.

The table's constraints hold for every row (no missing team, score or date), which the sums rely on.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import contract as C
from touchline.functions import labels
from touchline.functions.numeric import exact_ratio, row_count
from touchline.functions.ordering import down, sort_few, up
from touchline.operators import quality
from touchline.operators.duplicates import duplicate_rows
from touchline.operators.reshape import team_sides
from touchline.plans import views
from touchline.sources import files
from touchline.sources.table import read_matches_table, table_location

_FOLDER = "_summaries"  # a hidden folder of the table, which scans skip
_NO_NAME = "__HIVE_DEFAULT_PARTITION__"  # how Spark names the folder of an empty partition value


def _sum(value: Column | str, name: str) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias(name)


def _results() -> list[Column]:
    return [
        row_count().alias("matches"),
        F.count_if(labels.home_won()).alias("home_wins"),
        F.count_if(labels.level()).alias("draws"),
        F.count_if(labels.away_won()).alias("away_wins"),
        _sum(labels.total_goals(), "goals"),
    ]


def _venues(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source_file", F.year("match_date").alias("year"), "neutral").agg(*_results())


def _teams(rows: DataFrame) -> DataFrame:
    scored, allowed = F.col("goals_for"), F.col("goals_against")
    return (
        team_sides(rows, ("source_file",))
        .groupBy("source_file", "team")
        .agg(
            row_count().alias("matches"),
            F.count_if(scored > allowed).alias("wins"),
            F.count_if(scored == allowed).alias("draws"),
            F.count_if(scored < allowed).alias("losses"),
            _sum(scored, "goals_for"),
            _sum(allowed, "goals_against"),
        )
    )


def _tournaments(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source_file", "tournament").agg(
        row_count().alias("match_count"),
        F.min("match_date").alias("first_match_date"),
        F.max("match_date").alias("last_match_date"),
        _sum(labels.total_goals(), "goals"),
        _sum(labels.goal_difference(), "differences"),
    )


def _days(rows: DataFrame) -> DataFrame:
    """Matches per day, which decide the future-date rule for any day of reference; at most one row per source and day."""
    return rows.groupBy("source_file", "match_date").agg(row_count().alias("matches"))


def _rules(rows: DataFrame) -> DataFrame:
    """The counts of the row rules. The future-date rule depends on the day of reference and is left to _days."""
    named = rows.withColumnRenamed("match_date", "date").select("source_file", *C.CONTRACT)
    rules = quality.build_rules(named.drop("source_file"), duplicates=False)
    counts = [count for name, count in rules.counts.items() if name != "future_date"]
    return rules.prepare(named).groupBy("source_file").agg(*counts)


KINDS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "venues": _venues,
    "teams": _teams,
    "tournaments": _tournaments,
    "days": _days,
    "rules": _rules,
}


# --- keeping the sums ------------------------------------------------------------------------


def stamps(spark: SparkSession, table: str = "matches") -> dict[str, str]:
    """Source name to a digest of its name and of the names of its data files, from the file list that any scan is planned on."""
    spark.catalog.refreshTable(table)
    found: dict[str, list[str]] = {}
    for path in spark.table(table).inputFiles():
        folder, name = path.rsplit("/", 2)[1:]
        # The folder name is escaped twice: as a partition value and as a part of a URI.
        source = unquote(unquote(folder)).removeprefix("source_file=")
        found.setdefault("" if source == _NO_NAME else source, []).append(name)
    return {s: hashlib.sha256("\n".join([s, *sorted(names)]).encode()).hexdigest() for s, names in found.items()}


def _place(spark: SparkSession, table: str, kind: str) -> str:
    return f"{table_location(spark, table)}/{_FOLDER}/{kind}"


def _stored(spark: SparkSession, table: str, kind: str) -> tuple[DataFrame | None, set[str]]:
    """The stored sums of all stamps, and those stamps."""
    folder = _place(spark, table, kind)
    if not files.exists(spark, folder):
        return None, set()
    schema = KINDS[kind](spark.table(table)).withColumn("stamp", F.lit("")).schema
    stored = spark.read.schema(schema).parquet(folder)
    return stored, {m[1] for path in stored.inputFiles() if (m := re.search(r"/stamp=([0-9a-f]{64})/", path))}


def _name() -> Column:
    return F.coalesce(F.col("source_file"), F.lit(""))


def _of_sources(spark: SparkSession, table: str, sources: list[str]) -> DataFrame:
    """The rows of some sources; others are not read."""
    return spark.table(table).filter(_name().isin(sources))


def refresh(spark: SparkSession, table: str = "matches", kinds: tuple[str, ...] = tuple(KINDS)) -> list[str]:
    """Sum the sources that were loaded, replaced or written since; returns their names. Other sources are not read.

    Each kind of sum is one narrow scan of those sources. Sums of one stamp are put in place as a whole, so a failed or repeated
    run, or two at once, leave no half or double sums.
    """
    now = stamps(spark, table)
    changed: set[str] = set()
    for kind in kinds:
        have = _stored(spark, table, kind)[1]
        missing = {source: stamp for source, stamp in now.items() if stamp not in have}
        if not missing:
            continue
        changed |= set(missing)
        marks = spark.createDataFrame(list(missing.items()), "_source string, stamp string")
        summed = KINDS[kind](_of_sources(spark, table, list(missing)))
        marked = summed.join(marks, _name() == F.col("_source")).drop("_source").hint("rebalance", "source_file")
        writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("source_file", "stamp").parquet(_place(spark, table, kind))
    return sorted(changed)


def drop_stale(spark: SparkSession, table: str = "matches") -> int:
    """Delete sums of rows that are no longer in the table; returns the number of folders. For a time without readers."""
    current = set(stamps(spark, table).values())
    dropped = 0
    for kind in KINDS:
        stored = _stored(spark, table, kind)[0]
        paths = stored.inputFiles() if stored is not None else []
        for folder in sorted({path.rsplit("/", 1)[0] for path in paths}):
            if folder.rsplit("stamp=", 1)[1] not in current:
                files.delete(spark, unquote(folder))
                dropped += 1
    return dropped


def sums(spark: SparkSession, table: str, kind: str) -> DataFrame:
    """Sums per source: the stored ones that are current, and those of the other sources worked out from their rows."""
    now = stamps(spark, table)
    stored, have = _stored(spark, table, kind)
    build = KINDS[kind]
    missing = [s for s, stamp in now.items() if stamp not in have]
    if stored is None:
        return build(spark.table(table))
    known = stored.filter(F.col("stamp").isin([stamp for stamp in now.values() if stamp in have])).drop("stamp")
    return known.unionByName(build(_of_sources(spark, table, missing))) if missing else known


# --- reports ---------------------------------------------------------------------------------


def home_advantage(spark: SparkSession, table: str = "matches") -> DataFrame:
    """Rows of reports.home_advantage over the table."""
    grouped = sums(spark, table, "venues").groupBy(labels.venue_label(C.VENUE_REPORT).alias("venue_type"))
    names = ("home_wins", "draws", "away_wins")
    counted = grouped.agg(_sum("matches", "match_count"), *[_sum(n, n) for n in names])
    shares = [exact_ratio(F.col(n) * 100, F.col("match_count"), 2).alias(n.removesuffix("s") + "_pct") for n in names]
    return sort_few(counted.select("*", *shares), "venue_type")


def neutral_vs_non_neutral(spark: SparkSession, table: str = "matches") -> DataFrame:
    """Rows of reports.neutral_vs_non_neutral over the table."""
    matches = F.sum("matches")
    grouped = sums(spark, table, "venues").groupBy(labels.venue_label(C.VENUE_QUERY).alias("neutral_status"))
    counted = grouped.agg(
        matches.alias("match_count"),
        exact_ratio(F.sum("goals"), matches, 2).alias("avg_total_goals"),
        exact_ratio(F.sum("draws"), matches, 4).alias("draw_share"),
        exact_ratio(F.sum("home_wins"), matches, 4).alias("home_win_share"),
    )
    return sort_few(counted, "neutral_status")


def matches_by_year(spark: SparkSession, table: str = "matches") -> DataFrame:
    """Rows of reports.matches_by_year over the table."""
    grouped = sums(spark, table, "venues").groupBy(F.col("year").alias("match_year"))
    matches = F.sum("matches")
    return sort_few(
        grouped.agg(matches.alias("match_count"), exact_ratio(F.sum("goals"), matches, 2).alias("avg_total_goals")), "match_year"
    )


def _tallies(spark: SparkSession, table: str) -> DataFrame:
    counts = ("matches", "wins", "draws", "losses", "goals_for", "goals_against")
    return sums(spark, table, "teams").groupBy("team").agg(*[_sum(c, c) for c in counts])


def team_table(spark: SparkSession, table: str = "matches") -> DataFrame:
    """Rows of views.team_table over the table."""
    return views.with_team_rates(_tallies(spark, table))


def team_ranking(spark: SparkSession, table: str = "matches") -> DataFrame:
    """Rows of views.team_ranking over the table."""
    return views.ranked_teams(team_table(spark, table))


def most_successful_teams(spark: SparkSession, table: str = "matches", limit: int = 20) -> DataFrame:
    """Rows of reports.most_successful_teams over the table."""
    rated = _tallies(spark, table).select(
        "*",
        (F.col("goals_for") - F.col("goals_against")).alias("goal_difference"),
        exact_ratio(F.col("wins") * 100, F.col("matches"), 2).alias("win_rate"),
    )
    return rated.orderBy(down("wins"), down("win_rate"), down("goal_difference"), down("matches"), up("team")).limit(limit)


def highest_scoring_teams(
    spark: SparkSession, table: str = "matches", min_matches: int = C.MIN_TEAM_MATCHES, limit: int = 20
) -> DataFrame:
    """Rows of reports.highest_scoring_teams over the table."""
    rated = _tallies(spark, table).filter(F.col("matches") >= min_matches)
    means = [exact_ratio(F.col(c), F.col("matches"), 3).alias(f"avg_{c}") for c in ("goals_for", "goals_against")]
    rated = rated.select("team", "matches", "goals_for", "goals_against", *means)
    return rated.orderBy(down("avg_goals_for"), down("goals_for"), up("team")).limit(limit)


def _tournament_sums(spark: SparkSession, table: str, min_matches: int) -> DataFrame:
    grouped = sums(spark, table, "tournaments").groupBy("tournament")
    counted = grouped.agg(
        _sum("match_count", "match_count"),
        F.min("first_match_date").alias("first_match_date"),
        F.max("last_match_date").alias("last_match_date"),
        exact_ratio(F.sum("goals"), F.sum("match_count"), 2).alias("avg_total_goals"),
        exact_ratio(F.sum("differences"), F.sum("match_count"), 2).alias("avg_goal_difference"),
    )
    return counted.filter(F.col("match_count") >= min_matches).orderBy(down("match_count"), up("tournament"))


def tournament_analysis(
    spark: SparkSession, table: str = "matches", min_matches: int = C.MIN_TOURNAMENT_MATCHES, limit: int = 20
) -> DataFrame:
    """Rows of reports.tournament_analysis over the table."""
    return _tournament_sums(spark, table, min_matches).limit(limit).drop("first_match_date", "last_match_date")


def tournament_summary(
    spark: SparkSession, table: str = "matches", min_matches: int = C.MIN_TOURNAMENT_MATCHES, limit: int = 30
) -> DataFrame:
    """Rows of reports.tournament_summary over the table."""
    return _tournament_sums(spark, table, min_matches).limit(limit).drop("avg_goal_difference")


# --- checks ----------------------------------------------------------------------------------


def validate_table(spark: SparkSession, table: str = "matches", as_of: date | None = None, duplicates: bool = False) -> DataFrame:
    """The report of quality.validate_matches over the contract columns of the table, from sums: a check after a load reads only
    the new source. duplicates=True adds the duplicate rule, which compares all rows and therefore reads all of them.
    """
    rows = read_matches_table(spark, table).select(*C.CONTRACT)
    rules = quality.build_rules(rows, as_of, duplicates)
    kept = [name for name in rules.counts if name != "future_date"]
    counts = sums(spark, table, "rules").agg(*[_sum(name, name) for name in kept])
    today = F.lit(as_of) if as_of else F.current_date()
    future = sums(spark, table, "days").filter(F.col("match_date") > today).agg(_sum("matches", "future_date"))
    counts = counts.withColumn("future_date", future.scalar())
    if duplicates:
        counts = counts.withColumn("duplicate_rows", duplicate_rows(rows).scalar())
    return quality.report_from(counts, rules)

"""Batch jobs from a CSV file to a published output, a loaded table or a stored profile."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import contract as C
from touchline.operators import quality
from touchline.operators.profile import column_profile, dataset_profile
from touchline.operators.standardize import AUDIT_SCHEMA, audit_from, audit_lines, final_columns, plan_standardization
from touchline.plans import rollups
from touchline.session import scratch_path
from touchline.sources import files
from touchline.sources.csv import scan_errors, read_matches_csv
from touchline.sources.outputs import write_as, write_output
from touchline.sources.table import load_matches


def standardize_job(
    spark: SparkSession,
    source: str,
    mapping: Mapping[str, str],
    output: str,
    overwrite: bool = False,
    as_of: date | None = None,
    fmt: str = "parquet",
    duplicates: bool = True,
    date_formats=C.DATE_FORMATS,
    **scan,
) -> DataFrame:
    """Read, standardise, check and publish; returns the audit row. Any error leaves the output as it was.

    The CSV is parsed once: rows go to a staging folder while the rule counts are taken from the same
    pass, and the folder is moved in only if no error was counted. The duplicate rule reads the staged rows.
    date_formats holds for the date column under whatever name; scan takes na_tokens and multi_line.
    """
    df = read_matches_csv(spark, source, date_formats=date_formats, **scan)
    plan = plan_standardization(df, mapping, as_of, duplicates, stripped=True, date_formats=date_formats)
    blocked = [C.MSG_OUTPUT_EXISTS.format(output)] if files.exists(spark, output) and not overwrite else []
    with scan_errors():
        if plan.mapping_errors or blocked:
            audit = _fixed(audit_from(plan, plan.counts(duplicates), source), AUDIT_SCHEMA)
            return _with_errors(audit, blocked)
        staged = files.sibling(output, "staging")
        try:
            seen = Observation()
            checked = plan.checked.observe(seen, *plan.rules.counts.values())
            write_as(final_columns(checked), staged, fmt)
            counts = _one_row(spark, seen.get)
            if duplicates:
                rows = spark.read.parquet(staged) if fmt == "parquet" else read_back(spark, staged)
                counts = counts.withColumn("duplicate_rows", F.lit(quality.duplicate_rows(rows).first()[0]))
            audit = _fixed(audit_from(plan, counts, source, output), AUDIT_SCHEMA)
            if audit.first()["is_successful"]:
                files.swap_in(spark, staged, output)
                return audit
            return _fixed(audit.withColumn("output_file", F.lit(None).cast("string")), AUDIT_SCHEMA)
        finally:
            if files.exists(spark, staged):
                files.delete(spark, staged)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """A standardised CSV output, typed by the contract."""
    return spark.read.schema(C.INTERIM_SCHEMA).option("header", True).option("escape", '"').csv(path)


def _one_row(spark: SparkSession, values: Mapping[str, int]) -> DataFrame:
    schema = T.StructType([T.StructField(k, T.LongType()) for k in values])
    return spark.createDataFrame([tuple(values.values())], schema)


def _fixed(few: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Hold a result of a few rows (an audit, a profile), so that reading it later runs nothing again."""
    return few.sparkSession.createDataFrame(few.collect(), schema or few.schema)


def _with_errors(audit: DataFrame, more: list[str]) -> DataFrame:
    if not more:
        return audit
    extra = F.array(*[F.lit(m) for m in more])
    return audit.withColumn("errors", F.concat("errors", extra)).withColumn("is_successful", F.lit(False))


def write_audit(audit: DataFrame, path: str, overwrite: bool = True) -> None:
    """Store an audit as (section, position, value) lines; done for failed runs too."""
    write_output(audit_lines(audit), path, overwrite)


def load_job(
    spark: SparkSession, path: str, table: str = "matches", replace: bool = False, summarize: bool = False, **scan
) -> int:
    """Load a standardised CSV under its file name; returns the number of rows loaded. scan takes the options of the scan.

    summarize=True brings the table's sums per source up to date, which reads the loaded source only.
    """
    with scan_errors():
        df = read_matches_csv(spark, path, **scan)
        loaded = load_matches(spark, df, table, files.base_name(path), replace)
    if summarize:
        rollups.refresh(spark, table)
    return loaded


def profile_job(
    spark: SparkSession, path: str, output: str | None = None, as_of: date | None = None, approx: bool = False, **scan
) -> tuple[DataFrame, DataFrame]:
    """(dataset profile with validation texts, column profile) of a CSV file, stored as two tables if asked.

    The text is parsed once, into a columnar copy in the scratch folder that all counts then read.
    """
    copy = scratch_path(spark, "profile")
    try:
        with scan_errors():
            read_matches_csv(spark, path, **scan).write.parquet(copy)
        df = spark.read.parquet(copy)
        report = quality.validate_matches(df, as_of, stripped=True)
        table_level = _fixed(dataset_profile(df, files.base_name(path), report, approx))
        columns = _fixed(column_profile(df, approx))
    finally:
        files.delete(spark, copy)
    if output is not None:
        write_output(table_level, f"{output.rstrip('/')}/dataset_profile", overwrite=True)
        write_output(columns, f"{output.rstrip('/')}/column_profile", overwrite=True)
    return table_level, columns

"""Standardisation: a raw frame and a column mapping in, contract rows and an audit record out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import contract as C
from touchline.functions import parsing
from touchline.functions.numeric import row_count
from touchline.functions.text import strip_strings
from touchline.operators import quality
from touchline.operators.mapping import apply_mapping, check_mapping, clean_mapping, dropped_columns

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("output_file", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("output_rows", T.LongType()),
        T.StructField("input_columns", T.ArrayType(T.StringType())),
        T.StructField("output_columns", T.ArrayType(T.StringType())),
        T.StructField("renamed_columns", T.MapType(T.StringType(), T.StringType())),
        T.StructField("added_columns", T.ArrayType(T.StringType())),
        T.StructField("dropped_columns", T.ArrayType(T.StringType())),
        T.StructField("type_conversions", T.ArrayType(T.StringType())),
        T.StructField("warnings", T.ArrayType(T.StringType())),
        T.StructField("errors", T.ArrayType(T.StringType())),
        T.StructField("is_successful", T.BooleanType()),
    ]
)


@dataclass
class Standardization:
    """The lazy pieces of one standardisation.

    checked holds the contract columns with the scores still raw, plus helper columns (the raw neutral
    value, the scores as numbers): the rules have to see what conversion would hide.
    """

    source: DataFrame
    mapping: dict[str, str]
    mapping_errors: list[str]
    checked: DataFrame | None = None
    rules: quality.RuleSet = field(default_factory=quality.RuleSet)
    added: list[str] = field(default_factory=list)

    def data(self) -> DataFrame:
        """Contract rows. No row is ever dropped; a value that cannot be read is NULL."""
        if self.checked is None:
            return self.source.sparkSession.createDataFrame([], C.INTERIM_SCHEMA)
        return final_columns(self.checked)

    def counts(self, duplicates: bool = True) -> DataFrame:
        """One row of rule counts: one pass over the source, plus one for duplicates."""
        if self.checked is None:
            return self.source.agg(row_count().alias("row_count"))
        counts = self.checked.agg(*self.rules.counts.values())
        if duplicates:
            counts = counts.withColumn("duplicate_rows", quality.duplicate_rows(self.data()).scalar())
        return counts


def final_columns(checked: DataFrame) -> DataFrame:
    scores = {c: parsing.whole(F.col(f"_number_{c}")).alias(c) for c in C.SCORES}
    return checked.select(*[scores.get(c, F.col(c)) for c in C.CONTRACT])


def plan_standardization(
    df: DataFrame,
    mapping: Mapping[str, str],
    as_of: date | None = None,
    duplicates: bool = True,
    stripped: bool = False,
    date_formats=C.DATE_FORMATS,
) -> Standardization:
    """stripped says that the text is trimmed already, as after a CSV scan."""
    mapping = clean_mapping(mapping)
    problems = check_mapping(df.columns, mapping)
    if problems:
        return Standardization(df, mapping, problems)
    mapped = apply_mapping(df, mapping)
    if not stripped:
        mapped = strip_strings(mapped)
    types = {f.name: f.dataType for f in mapped.schema.fields}
    added = [c for c in C.OPTIONAL if c not in types]
    raw_neutral = F.col("neutral").cast("string") if "neutral" in types else F.lit(None).cast("string")
    contract = [_checked_column(c, types, date_formats).alias(c) for c in C.CONTRACT]
    rules = quality.build_rules(mapped.select(*contract), as_of, duplicates, stripped=True)
    _conversion_rules(rules)
    checked = rules.prepare(mapped.select(*contract, raw_neutral.alias("_neutral")))
    return Standardization(df, mapping, [], checked, rules, added)


def _checked_column(name: str, types: dict[str, T.DataType], date_formats) -> Column:
    target = C.INTERIM_SCHEMA[name].dataType
    if name not in types:
        return F.lit(None).cast(target)
    if name == "date":
        return parsing.parse_date(F.col(name), types[name], date_formats, stripped=True)
    if name == "neutral":
        return parsing.normalize_neutral(F.col(name), types[name], stripped=True)
    return F.col(name) if name in C.SCORES else F.col(name).cast(target)


def _conversion_rules(rules: quality.RuleSet) -> None:
    """Counts behind the conversion messages, which come before the quality messages."""
    for name in C.SCORES:
        number = F.col(f"_number_{name}")
        rules.count(f"unsafe_{name}", (F.col(name).isNotNull() & number.isNull()) | parsing.is_fractional(number))
    rules.count("lost_neutral", F.col("_neutral").isNotNull() & F.col("neutral").isNull())


def audit_from(plan: Standardization, counts: DataFrame, source_file: str = "", output_file: str | None = None) -> DataFrame:
    """The audit row: names, numbers and messages, never a value from the data."""

    def texts(values) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    ok = not plan.mapping_errors
    by_source = {source: target for target, source in plan.mapping.items()}
    renamed = F.create_map(*[F.lit(x) for pair in by_source.items() for x in pair])
    conversions, unsafe, lost = [], [], []
    if ok:
        conversions.append(F.lit(C.MSG_DID_DATE))
        for name in C.SCORES:
            bad = F.col(f"unsafe_{name}") > 0
            unsafe.append(F.when(bad, C.MSG_UNSAFE_SCORE.format(name)))
            conversions.append(F.when(~bad, C.MSG_DID_SCORE.format(name)))
        conversions.append(F.lit(C.MSG_DID_NEUTRAL))
        text = F.concat(F.lit(C.MSG_UNKNOWN_NEUTRAL + " "), F.col("lost_neutral").cast("string"), F.lit(C.MSG_NEUTRAL_COUNT))
        lost.append(F.when(F.col("lost_neutral") > 0, text))
        errors = quality.messages_from(plan.rules, "error", *unsafe)
        warnings = quality.messages_from(plan.rules, "warning", *lost)
    else:
        errors, warnings = texts(plan.mapping_errors), texts([])
    return counts.select(
        F.lit(source_file).alias("source_file"),
        F.lit(output_file).cast("string").alias("output_file"),
        F.col("row_count").alias("input_rows"),
        (F.col("row_count") if ok else F.lit(0)).cast("bigint").alias("output_rows"),
        texts(plan.source.columns).alias("input_columns"),
        texts(C.CONTRACT if ok else []).alias("output_columns"),
        renamed.cast("map<string,string>").alias("renamed_columns"),
        texts(plan.added).alias("added_columns"),
        texts(dropped_columns(plan.source.columns, plan.mapping)).alias("dropped_columns"),
        (F.array_compact(F.array(*conversions)) if ok else texts([])).alias("type_conversions"),
        warnings.alias("warnings"),
        errors.alias("errors"),
    ).withColumn("is_successful", F.size("errors") == 0)


def standardize_matches(
    df: DataFrame, mapping: Mapping[str, str], as_of: date | None = None, duplicates: bool = True, date_formats=C.DATE_FORMATS
) -> tuple[DataFrame, DataFrame]:
    """(data, audit), both lazy. With a broken mapping the data is empty and the audit says why."""
    plan = plan_standardization(df, mapping, as_of, duplicates, date_formats=date_formats)
    return plan.data(), audit_from(plan, plan.counts(duplicates))


def audit_lines(audit: DataFrame) -> DataFrame:
    """The audit as (section, position, value) lines for writing or reading as a report."""

    def listed(section: str) -> Column:
        return F.transform(
            F.col(section),
            lambda value, i: F.struct(F.lit(section).alias("section"), (i + 1).alias("position"), value.alias("value")),
        )

    def single(section: str) -> Column:
        return F.struct(F.lit(section), F.lit(1), F.col(section).cast("string"))

    pairs = F.transform(
        F.map_entries("renamed_columns"),
        lambda e, i: F.struct(F.lit("renamed_columns"), i + 1, F.concat_ws(" -> ", e["key"], e["value"])),
    )
    ones = F.array(*[single(c) for c in ("source_file", "output_file", "input_rows", "output_rows", "is_successful")])
    lists = [
        listed(c)
        for c in (
            "input_columns",
            "output_columns",
            "added_columns",
            "dropped_columns",
            "type_conversions",
            "warnings",
            "errors",
        )
    ]
    line = "array<struct<section:string,position:int,value:string>>"
    return audit.select(F.inline(F.concat(*[c.cast(line) for c in (*lists, pairs, ones)])))

"""Data-quality rules. They report; they never drop or repair a row.

All row rules are counts inside ONE aggregate, so a frame is read once however many rules run.
Only the duplicate rule needs a shuffle of its own (a group-by over all columns).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import contract as C
from touchline.functions import parsing
from touchline.functions.numeric import row_count
from touchline.functions.text import ref, string_columns, strip
from touchline.operators.duplicates import duplicate_rows

REPORT_COLUMNS = ("rule_id", "severity", "column", "violations", "message")


@dataclass
class Outcome:
    """One line a report may hold. Violations and message are expressions over the counts row."""

    rule_id: str
    severity: str
    column: str | None
    violations: Column
    message: Column


@dataclass
class RuleSet:
    """helpers: columns computed once per row, before the counts that share them."""

    helpers: dict[str, Column] = field(default_factory=dict)
    counts: dict[str, Column] = field(default_factory=dict)
    outcomes: list[Outcome] = field(default_factory=list)

    def helper(self, name: str, value: Column) -> Column:
        self.helpers[name] = value
        return F.col(name)

    def prepare(self, df: DataFrame) -> DataFrame:
        """The frame with its helper columns in a projection of their own: the optimizer keeps costly
        expressions apart from consumers that use them more than once.
        """
        return df.withColumns(self.helpers) if self.helpers else df

    def count(self, name: str, condition: Column) -> Column:
        self.counts[name] = F.count_if(condition).alias(name)
        return F.col(name)

    def error(self, rule_id: str, column: str | None, violations: Column, message: str | Column) -> None:
        self._add(rule_id, "error", column, violations, message)

    def warning(self, rule_id: str, column: str | None, violations: Column, message: str | Column) -> None:
        self._add(rule_id, "warning", column, violations, message)

    def _add(self, rule_id, severity, column, violations, message) -> None:
        text = F.lit(message) if isinstance(message, str) else message
        self.outcomes.append(Outcome(rule_id, severity, column, violations.cast("bigint"), text))


def build_rules(
    df: DataFrame, as_of: date | None = None, duplicates: bool = True, stripped: bool = False
) -> RuleSet:
    """The rules that apply to this frame's columns and types, errors before warnings.

    stripped says that the text is trimmed already.
    """
    rules = RuleSet()
    types = {f.name: f.dataType for f in df.schema.fields}
    rules.counts["row_count"] = row_count().alias("row_count")

    rules.error("V1", None, (F.col("row_count") == 0).cast("int"), C.MSG_EMPTY)
    absent = [c for c in C.REQUIRED if c not in types]
    if absent:
        rules.error("V2", None, F.lit(len(absent)), C.MSG_MISSING_REQUIRED.format(", ".join(absent)))
        return rules

    for name in C.REQUIRED:
        rules.error("V3", name, rules.count(f"null_{name}", F.col(name).isNull()), C.MSG_NULLS.format(name))
    numbers = {
        c: rules.helper(f"_number_{c}", parsing.parse_number(F.col(c), types[c], stripped)) for c in C.SCORES
    }
    for name, number in numbers.items():
        bad = number.isNull() | (number < 0) | parsing.is_fractional(number)
        rules.error("V5", name, rules.count(f"bad_{name}", bad), C.MSG_BAD_SCORE.format(name))
    text = {}
    for i, c in enumerate(sorted({*string_columns(df), "home_team", "away_team"})):
        value = ref(c).cast("string")
        text[c] = rules.helper(f"_text_{i}", value if stripped else strip(value))
    home, away = text["home_team"], text["away_team"]
    rules.error("V7", None, rules.count("same_team", (home != "") & (home == away)), C.MSG_SAME_TEAM)
    dated = parsing.is_date(types["date"])
    if dated:
        rules.error("V9", "date", F.col("null_date"), C.MSG_BAD_DATE)
    else:
        rules.error("V8", "date", F.lit(1), C.MSG_DATE_TYPE)

    _blank_text(rules, {c: text[c] for c in sorted(string_columns(df))})
    for name, number in numbers.items():
        high = rules.count(f"high_{name}", number > C.SUSPICIOUS_SCORE)
        rules.warning("V6", name, high, C.MSG_HIGH_SCORE.format(name, C.SUSPICIOUS_SCORE))
    if dated:
        today = F.lit(as_of) if as_of else F.current_date()
        future = rules.count("future_date", F.col("date").cast("date") > today)
        rules.warning("V10", "date", future, C.MSG_FUTURE_DATE)
    optional = [c for c in C.OPTIONAL if c not in types]
    if optional:
        rules.warning("V11", None, F.lit(len(optional)), C.MSG_MISSING_OPTIONAL.format(", ".join(optional)))
    if duplicates:
        rules.warning("V12", None, F.col("duplicate_rows"), C.MSG_DUPLICATES)
    if "neutral" in types and not isinstance(types["neutral"], T.BooleanType):
        flag = text["neutral"] if "neutral" in text else F.col("neutral").cast("string")
        unknown = rules.count("unknown_neutral", ~F.lower(flag).isin(*C.NEUTRAL_KNOWN))
        rules.warning("V13", "neutral", unknown, C.MSG_UNKNOWN_NEUTRAL)
    return rules


def _blank_text(rules: RuleSet, text: dict[str, Column]) -> None:
    """One warning that names every text column holding a blank value, in alphabetical order."""
    if not text:
        return
    found = [rules.count(f"blank_{i}", value == "") for i, value in enumerate(text.values())]
    listed = F.concat_ws(", ", *[F.when(n > 0, F.lit(name)) for n, name in zip(found, text)])
    total = reduce(lambda a, b: a + b, found)
    rules.warning("V4", None, total, F.concat(F.lit(C.MSG_BLANK_TEXT), listed, F.lit(".")))


def rule_counts(df: DataFrame, rules: RuleSet, duplicates: bool = True) -> DataFrame:
    """The one-row counts frame: a single aggregate, with the duplicate count as a scalar subquery."""
    counts = rules.prepare(df).agg(*rules.counts.values())
    if duplicates:
        counts = counts.withColumn("duplicate_rows", duplicate_rows(df).scalar())
    return counts


def report_from(counts: DataFrame, rules: RuleSet) -> DataFrame:
    """Turn the counts row into one line per violated rule."""
    lines = [
        F.struct(
            F.lit(o.rule_id).alias("rule_id"),
            F.lit(o.severity).alias("severity"),
            F.lit(o.column).cast("string").alias("column"),
            o.violations.alias("violations"),
            o.message.alias("message"),
        )
        for o in rules.outcomes
    ]
    return counts.select(F.inline(F.array(*lines))).filter(F.col("violations") > 0)


def messages_from(rules: RuleSet, severity: str, *first: Column) -> Column:
    """ARRAY<STRING> over the counts row: the messages of violated rules, in rule order, each once."""
    found = [F.when(o.violations > 0, o.message) for o in rules.outcomes if o.severity == severity]
    return F.array_distinct(F.array_compact(F.array(*first, *found)))


def validate_matches(
    df: DataFrame, as_of: date | None = None, duplicates: bool = True, stripped: bool = False
) -> DataFrame:
    """(rule_id, severity, column, violations, message) for every violated rule.

    as_of replaces today's date in the future-date rule. duplicates=False skips the rule that shuffles.
    stripped=True saves trimming text that a scan has trimmed already.
    """
    rules = build_rules(df, as_of, duplicates, stripped)
    wanted = any(o.rule_id == "V12" for o in rules.outcomes)
    return report_from(rule_counts(df, rules, wanted), rules)


def validation_summary(
    df: DataFrame, as_of: date | None = None, duplicates: bool = True, stripped: bool = False
) -> DataFrame:
    """One row: is_valid, numbers and texts of errors and warnings, row and column counts."""
    rules = build_rules(df, as_of, duplicates, stripped)
    wanted = any(o.rule_id == "V12" for o in rules.outcomes)
    return summary_from(rule_counts(df, rules, wanted), rules, len(df.columns))


def summary_from(counts: DataFrame, rules: RuleSet, column_count: int) -> DataFrame:
    errors, warnings = messages_from(rules, "error"), messages_from(rules, "warning")
    return counts.select(errors.alias("errors"), warnings.alias("warnings"), "row_count").select(
        (F.size("errors") == 0).alias("is_valid"),
        F.size("errors").alias("error_count"),
        F.size("warnings").alias("warning_count"),
        "row_count",
        F.lit(column_count).alias("column_count"),
        "errors",
        "warnings",
    )

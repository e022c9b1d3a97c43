"""Column mapping: contract field -> source column."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline import contract as C
from touchline.functions.numeric import row_count
from touchline.functions.text import ref


def clean_mapping(mapping: Mapping[str, str]) -> dict[str, str]:
    """Trim the targets; trim and lower-case the source names, as header names are on read."""
    return {target.strip(): source.strip().lower() for target, source in mapping.items()}


def check_mapping(columns: Iterable[str], mapping: Mapping[str, str]) -> list[str]:
    """All problems of a mapping at once, from column names alone (no Spark job)."""
    columns = set(columns)
    problems = []
    unknown = sorted(set(mapping) - set(C.CONTRACT))
    if unknown:
        problems.append(C.MSG_UNKNOWN_TARGETS.format(", ".join(unknown)))
    absent = [c for c in C.REQUIRED if c not in mapping]
    if absent:
        problems.append(C.MSG_MISSING_TARGETS.format(", ".join(absent)))
    reused = sorted(source for source, uses in Counter(mapping.values()).items() if uses > 1)
    if reused:
        problems.append(C.MSG_REUSED_SOURCES.format(", ".join(reused)))
    problems += [C.MSG_SOURCE_ABSENT.format(s, t) for t, s in mapping.items() if s not in columns]
    return problems


def mapping_report(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """(problem, rows) per problem of a mapping, rows being how many rows of the frame wait for it to be solved; none if there is none."""
    problems = check_mapping(df.columns, clean_mapping(mapping))
    listed = F.array(*[F.lit(p) for p in problems]) if problems else F.array().cast("array<string>")
    return df.agg(row_count().alias("rows")).select(F.explode(listed).alias("problem"), "rows")


def dropped_columns(columns: Iterable[str], mapping: Mapping[str, str]) -> list[str]:
    return sorted(set(columns) - set(mapping.values()))


def apply_mapping(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped source columns under their contract names and drop the rest."""
    return df.select(*[ref(source).alias(target) for target, source in mapping.items()])

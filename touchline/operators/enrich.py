"""Analysis projection: the contract columns plus what every view derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline import contract as C
from touchline.functions import labels, parsing


def as_fact(df: DataFrame) -> DataFrame:
    """Name the date column the way the warehouse table does."""
    if "match_date" not in df.columns and "date" in df.columns:
        return df.withColumnRenamed("date", "match_date")
    return df


def conform(df: DataFrame) -> DataFrame:
    """Exactly the contract columns, typed; absent ones are NULL. Keeps match_id for tie-breaks."""
    if "date" not in df.columns and "match_date" in df.columns:
        df = df.withColumnRenamed("match_date", "date")
    types = {f.name: f.dataType for f in df.schema.fields}
    out = [F.col("match_id")] if "match_id" in types else []
    for field in C.INTERIM_SCHEMA.fields:
        name = field.name
        if name not in types:
            col = F.lit(None).cast(field.dataType)
        elif name == "date":
            col = parsing.parse_date(F.col(name), types[name])
        elif name in C.SCORES:
            col = parsing.parse_score(F.col(name), types[name])
        elif name == "neutral":
            col = parsing.normalize_neutral(F.col(name), types[name])
        else:
            col = F.col(name).cast(field.dataType)
        out.append(col.alias(name))
    return df.select(*out)


def enrich_matches(df: DataFrame) -> DataFrame:
    """Add year, total_goals, goal_difference and result."""
    return conform(df).select(
        "*",
        F.year("date").alias("year"),
        labels.total_goals().alias("total_goals"),
        labels.goal_difference().alias("goal_difference"),
        labels.match_result().alias("result"),
    )

"""Dataset and column profiles: aggregates only, never a value from a row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import parsing
from touchline.functions.numeric import half_even, row_count
from touchline.functions.text import ref
from touchline.operators.duplicates import PLAIN
from touchline.operators.quality import duplicate_rows
from touchline.operators.reshape import distinct_count

ENTITIES = (("home_team", "home_team_count"), ("away_team", "away_team_count"), ("tournament", "tournament_count"))


def dataset_profile(df: DataFrame, source_file: str, report: DataFrame | None = None, approx: bool = False) -> DataFrame:
    """One row of table-level facts; report adds the texts of a validation report.

    Duplicates take one group-by over all columns. approx=True estimates the entity counts by sketches.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    dated = "date" in types and parsing.is_date(types["date"])
    present = [(c, alias) for c, alias in ENTITIES if c in types]
    aggregates = [row_count().alias("row_count")]
    if dated:
        aggregates += [F.min(F.col("date").cast("date")).alias("_from"), F.max(F.col("date").cast("date")).alias("_to")]
    if approx:
        aggregates += [F.approx_count_distinct(c).alias(alias) for c, alias in present]
    facts = df.agg(*aggregates).withColumn("duplicate_row_count", duplicate_rows(df).scalar())
    if not approx:
        facts = facts.withColumns({alias: distinct_count(df, c) for c, alias in present})

    def day(name: str) -> Column:
        return F.date_format(name, "yyyy-MM-dd") if dated else F.lit(None).cast("string")

    def entity(name: str, alias: str) -> Column:
        return F.col(alias) if name in types else F.lit(None).cast("bigint")

    columns = [
        F.lit(source_file).alias("source_file"),
        F.col("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.col("duplicate_row_count"),
        day("_from").alias("date_min"),
        day("_to").alias("date_max"),
        *[entity(c, alias).alias(alias) for c, alias in ENTITIES],
    ]
    if report is not None:
        columns += [_texts(report, "error").alias("validation_errors"), _texts(report, "warning").alias("validation_warnings")]
    return facts.select(*columns)


def _texts(report: DataFrame, severity: str) -> Column:
    """A report has at most a few dozen lines, so gathering its texts is bounded."""
    texts = report.filter(F.col("severity") == severity).agg(F.collect_list("message").alias("texts"))
    return texts.scalar()


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """One row per column: position, name, type, missing count and share, distinct non-missing values.

    Over plain columnar files every column is grouped by itself: that reads each byte once and keeps native types. Anything else
    (text, joins, aggregates, rows of the driver) is evaluated once: its columns become (column, value) rows of one group-by, but for
    columns whose text would not tell values apart, which are evaluated on their own. Either way equal values merge before the
    shuffle. approx=True needs one pass and shuffles no values.
    """
    if approx:
        return _finish(_sketched(df), df)
    together = {} if reads_columns_alone(df) else _value_texts(df)
    lines = [_line(df.groupBy(ref(name).alias("value")), F.lit(name)) for name in df.columns if name not in together]
    if together:
        names = F.array(*[F.lit(name) for name in together])
        cells = F.array(*[F.struct(F.lit(i).alias("place"), value.alias("value")) for i, value in enumerate(together.values())])
        found = df.select(F.inline(cells)).groupBy("place", "value").agg(row_count().alias("copies"))
        counted = found.groupBy("place").agg(*_counts())
        # A frame without rows has no cells, yet every column has its line.
        every = df.sparkSession.range(len(together)).select(F.col("id").cast("int").alias("place"))
        whole = every.join(F.broadcast(counted), "place", "left").na.fill(0)
        lines.append(whole.withColumn("column_name", F.element_at(names, F.col("place") + 1)).drop("place"))
    return _finish(reduce(DataFrame.unionByName, lines), df)


def reads_columns_alone(df: DataFrame) -> bool:
    """Whether one column of the frame costs little more than its bytes: only projections and filters over Parquet or ORC files."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    return plan.nodeName().startswith("LogicalRelation") and plan.relation().toString().lower() in ("parquet", "orc")


def _value_texts(df: DataFrame) -> dict[str, Column]:
    """Columns as text that differs if and only if their values do; columns without such a text are left out."""

    def text(value: Column, kind: T.DataType) -> Column | None:
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            value = value + F.lit(0.0)  # both zeros are one value
        elif isinstance(kind, T.TimestampType):
            value = F.unix_micros(value)
        elif isinstance(kind, T.BinaryType):
            value = F.hex(value)
        elif not isinstance(kind, (*PLAIN, T.TimestampNTZType)) or isinstance(kind, T.StringType) and kind.collation != "UTF8_BINARY":
            return None  # nested, or a collation that takes different texts for equal
        return value.cast("string")

    texts = {f.name: text(ref(f.name), f.dataType) for f in df.schema.fields}
    return {name: value for name, value in texts.items() if value is not None}


def _counts() -> list[Column]:
    missing = F.sum(F.when(F.col("value").isNull(), F.col("copies")))
    return [
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.coalesce(missing, F.lit(0)).alias("missing"),
        F.count("value").alias("distinct_values"),
    ]


def _line(groups: GroupedData, name: Column) -> DataFrame:
    return groups.agg(row_count().alias("copies")).agg(*_counts()).withColumn("column_name", name)


def _sketched(df: DataFrame) -> DataFrame:
    """Approximate distinct counts in a single aggregate without shuffling values."""
    aggregates = [row_count().alias("_rows")]
    for i, c in enumerate(df.columns):
        aggregates.append(F.count_if(ref(c).isNull()).alias(f"m{i}"))
        aggregates.append(F.approx_count_distinct(ref(c)).alias(f"d{i}"))
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_rows").alias("rows"),
            F.col(f"m{i}").alias("missing"),
            F.col(f"d{i}").alias("distinct_values"),
        )
        for i, c in enumerate(df.columns)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*lines)))


def _finish(counts: DataFrame, df: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(c) for c in df.columns])
    dtypes = F.array(*[F.lit(t) for _, t in df.dtypes])
    position = F.array_position(names, F.col("column_name"))
    share = F.when(F.col("rows") > 0, half_even(F.col("missing") / F.col("rows") * 100, 2)).otherwise(0.0)
    return counts.select(
        position.cast("int").alias("position"),
        "column_name",
        F.element_at(dtypes, position.cast("int")).alias("data_type"),
        F.col("missing").cast("bigint").alias("missing_count"),
        share.alias("missing_pct"),
        F.col("distinct_values").cast("bigint").alias("distinct_count"),
    )

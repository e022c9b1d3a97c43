"""The warehouse table: definition, reads, and idempotent loads by source."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import contract as C
from touchline.functions import parsing
from touchline.functions.numeric import row_count
from touchline.functions.text import strip
from touchline.operators.enrich import conform
from touchline.operators.quality import validate_matches
from touchline.session import scratch_path, session_conf
from touchline.sources import files
from touchline.sources.csv import read_matches_csv

_CLAIMS = "_match_ids"  # a hidden folder of the table, which scans skip
_CLAIM_TRIES = 1000


class DataUnavailable(RuntimeError):
    """Neither the table nor the fallback output can be read."""


def ensure_matches_table(spark: SparkSession, table: str = "matches", location: str | None = None) -> None:
    """Create the table if absent. Partitioned by source, so a load touches only its own partition.

    Parquet holds no CHECK constraints; load_matches enforces them on every row it writes.
    """
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in C.TABLE_SCHEMA.fields)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY (source_file){place}")


def read_matches_table(spark: SparkSession, table: str = "matches") -> DataFrame:
    """The nine contract columns (plus match_id) of the table. Unsorted: consumers sort what they keep."""
    return spark.table(table).select("match_id", F.col("match_date").alias("date"), *C.CONTRACT[1:])


def read_matches_jdbc(
    spark: SparkSession,
    url: str,
    table: str = "matches",
    partitions: int = 32,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """The same columns from a database, read in parallel over ranges between the smallest and largest match_id."""
    ends = spark.read.jdbc(url, f"(SELECT min(match_id) AS low, max(match_id) AS high FROM {table}) ends", properties=properties or {}).first()
    lower, upper = (ends[0], ends[1] + 1) if ends[0] is not None else (0, 1)
    rows = spark.read.jdbc(
        url,
        table,
        column="match_id",
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties or {},
    )
    return rows.select("match_id", F.col("match_date").alias("date"), *C.CONTRACT[1:])


def open_matches(
    spark: SparkSession, table: str | None = "matches", fallback_path: str | None = None
) -> tuple[DataFrame, str]:
    """(rows, label of the source used): the table first, then a standardised output, else DataUnavailable.

    Either way the rows are typed by the contract, so a CSV output gives numbers where the table does.
    """
    if table and spark.catalog.tableExists(table):
        return conform(read_matches_table(spark, table)), f"table: {table}"
    if fallback_path and files.exists(spark, fallback_path):
        if fallback_path.rstrip("/").lower().endswith(".csv"):
            rows = read_matches_csv(spark, fallback_path)
        else:
            rows = spark.read.parquet(fallback_path)
        return conform(rows), f"file: {fallback_path}"
    raise DataUnavailable("No match data: load the matches table or write a standardised output first.")


def rows_by_source(spark: SparkSession, table: str = "matches", source_file: str | None = None) -> DataFrame:
    """Rows per source; with a name, that partition alone is read and there is one row, with 0 for an absent source."""
    rows = spark.table(table)
    if source_file is not None:
        named = rows.filter(F.col("source_file") == source_file)
        return named.agg(F.lit(source_file).alias("source_file"), row_count().alias("row_count"))
    return rows.groupBy("source_file").agg(row_count().alias("row_count"))


def _flag(value: Column, data_type: T.DataType) -> Column:
    """Neutral flag as a load accepts it: booleans, or text and numbers that plainly are one."""
    if isinstance(data_type, (T.BooleanType, T.NullType)):
        return value.cast("boolean")
    text = F.lower(value.cast("string"))
    return F.when(text.isin("true", "1", "1.0"), F.lit(True)).when(text.isin("false", "0", "0.0"), F.lit(False))


def _with_helpers(df: DataFrame) -> DataFrame:
    """Add the scores as numbers and the neutral flag, each worked out once per row."""
    types = {f.name: f.dataType for f in df.schema.fields}
    helpers = {f"_number_{c}": parsing.parse_number(F.col(c), types[c]) for c in C.SCORES}
    neutral = _flag(F.col("neutral"), types["neutral"]) if "neutral" in types else F.lit(None).cast("boolean")
    return df.withColumns({**helpers, "_flag": neutral})


def _load_values(df: DataFrame, source_file: str) -> dict[str, Column]:
    """The ten load columns over a frame with helpers, typed; absent optional columns are NULL."""

    def value(name: str) -> Column:
        if name == "match_date":
            return parsing.parse_date(F.col("date"), df.schema["date"].dataType)
        if name == "source_file":
            return F.lit(source_file)
        if name in C.SCORES:
            return parsing.whole(F.col(f"_number_{name}"))
        if name == "neutral":
            return F.col("_flag")
        return F.col(name) if name in df.columns else F.lit(None)

    return {c: value(c).cast(C.TABLE_SCHEMA[c].dataType).alias(c) for c in C.LOAD_COLUMNS}


def _violation(df: DataFrame) -> Column:
    """TRUE where a row of a frame with helpers breaks a table constraint."""
    bad = F.lit(False)
    for name in C.REQUIRED:
        bad |= F.col(name).isNull()
    for name in C.SCORES:
        number = F.col(f"_number_{name}")
        bad |= number.isNull() | (number < 0) | parsing.is_fractional(number)
    home, away = strip(F.col("home_team")), strip(F.col("away_team"))
    bad |= (home != "") & (home == away)
    if "neutral" in df.columns:
        bad |= F.col("neutral").isNotNull() & F.col("_flag").isNull()
    return F.coalesce(bad, F.lit(True))


def _reject(problems: list[str]) -> None:
    if problems:
        raise ValueError(C.MSG_NOT_LOADABLE + "; ".join(problems))


def _error_messages(df: DataFrame) -> list[str]:
    """Texts of the violated error rules (a few lines at most)."""
    rows = validate_matches(df, duplicates=False).filter(F.col("severity") == "error").collect()
    return [row["message"] for row in rows]


def _neutral_message(df: DataFrame) -> list[str]:
    kind = df.schema["neutral"].dataType if "neutral" in df.columns else T.NullType()
    if isinstance(kind, (T.BooleanType, T.NullType)):
        return []
    value = F.col("neutral")
    lost = df.filter(value.isNotNull() & _flag(value, kind).isNull())
    return [C.MSG_UNKNOWN_NEUTRAL] if lost.limit(1).count() else []


def prepare_for_load(df: DataFrame, source_file: str, validate: bool = True) -> DataFrame:
    """Rows ready for the table. Raises ValueError with all messages if a rule of severity error is violated.

    validate=False leaves that to the caller (load_matches checks rows while it writes them).
    """
    if validate:
        _reject(_error_messages(df) or _neutral_message(df))
    ready = _with_helpers(df)
    return ready.select(*_load_values(ready, source_file).values())


def load_matches(
    spark: SparkSession,
    df: DataFrame,
    table: str = "matches",
    source_file: str = "",
    replace: bool = False,
    loaded_at: datetime | None = None,
    by_date: bool = True,
    scratch: str | None = None,
) -> int:
    """Load one source; returns its row count. A source already present needs replace=True, which
    replaces its rows and no others. All or nothing. Loads of different sources may run at once, also from several drivers;
    two loads of one source at once are not told apart.

    One pass over the input: constraints are checked inside the write of a staged copy (in scratch, else the folder of
    spark.checkpoint.dir). A broken row fails the job; the rules then run to say what was wrong. The staged rows get ids
    without gaps and move into the table in a second write, which Spark only shows at job commit. Their ids are claimed between the
    two, when their number is known; only if the second write fails do they stay unused.
    by_date sorts each written file, so date ranges skip row groups.
    """
    problems = _schema_problems(df)
    _reject(problems)
    ensure_matches_table(spark, table)
    present = spark.table(table).filter(F.col("source_file") == source_file).limit(1).count() > 0
    if present and not replace:
        raise ValueError(C.MSG_SOURCE_LOADED.format(source_file))

    # The check sits in a column of the write, not in a filter: a filter would be pushed below the input's
    # own projections and repeat their work.
    ready = _with_helpers(df)
    stop = F.raise_error(F.lit(C.MSG_NOT_LOADABLE)).cast("bigint")
    stamp = F.lit(loaded_at) if loaded_at else F.current_timestamp()
    values = _load_values(ready, source_file)
    place = F.when(_violation(ready), stop).otherwise(F.monotonically_increasing_id()).alias("_place")
    values["loaded_at"] = stamp.cast("timestamp").alias("loaded_at")
    seen = Observation()
    checked = ready.select(place, *values.values()).observe(seen, row_count().alias("rows"))
    staged = scratch_path(spark, "load", scratch)
    try:
        try:
            checked.write.parquet(staged)
        except PySparkException as error:
            if C.MSG_NOT_LOADABLE in str(error):
                _reject(_error_messages(df) or _neutral_message(df))
            raise
        loaded = seen.get["rows"]
        _reject([] if loaded else [C.MSG_EMPTY])
        first_id = claim_ids(spark, table, loaded)
        rows = _numbered(spark.read.schema(checked.schema).parquet(staged), first_id).select(*C.TABLE_SCHEMA.names)
        if by_date:
            rows = rows.sortWithinPartitions("source_file", "match_date")
        with session_conf(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
            rows.write.insertInto(table, overwrite=True)
        return loaded
    finally:
        if files.exists(spark, staged):
            files.delete(spark, staged)


def _numbered(staged: DataFrame, first_id: int) -> DataFrame:
    """match_id from first_id on, without gaps. _place holds the task (from bit 33 on) and the row inside it, so the ids of a
    task start after the counts of the tasks before it. Those counts are one row per task of the staged write.
    """
    task = F.shiftright("_place", 33).alias("_task")
    counts = staged.groupBy(task).agg(row_count().alias("n"))
    before = F.sum("n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_task", (F.coalesce(before, F.lit(0)) + first_id).alias("_start"))
    row = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return staged.withColumn("_task", task).join(F.broadcast(starts), "_task").withColumn("match_id", F.col("_start") + row)


def _schema_problems(df: DataFrame) -> list[str]:
    absent = [c for c in C.REQUIRED if c not in df.columns]
    if absent:
        return [C.MSG_MISSING_REQUIRED.format(", ".join(absent))]
    return [] if parsing.is_date(df.schema["date"].dataType) else [C.MSG_DATE_TYPE]


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return described.first()["data_type"]


def claim_ids(spark: SparkSession, table: str, n: int) -> int:
    """Take the next n match_ids for the caller alone; returns the first.

    Claims are numbered files in a hidden folder of the table, each holding the first id after it. A claim is made by creating the
    file with the next number; if another writer was faster, the number is taken and the claim starts from theirs. Loads so need
    no lock and no scan; the table is only scanned for its largest id while there are no claims yet. Claims stay, one of a few bytes per
    load: a number that were free again could be claimed twice.
    """
    folder = f"{table_location(spark, table)}/{_CLAIMS}"
    for _ in range(_CLAIM_TRIES):
        numbers = [name for name in files.names(spark, folder) if name.isdigit()]
        if numbers:
            start = int(files.head(spark, f"{folder}/{numbers[-1]}"))
        else:
            last = spark.table(table).agg(F.max("match_id").alias("last")).first()["last"]
            start = 1 if last is None else last + 1
        number = int(numbers[-1]) + 1 if numbers else 1
        if files.create_whole(spark, f"{folder}/{number:020d}", str(start + n).encode()):
            return start
    raise RuntimeError(f"Could not claim ids of table {table}: {_CLAIM_TRIES} times another writer was faster")

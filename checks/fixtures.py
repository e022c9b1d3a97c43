"""Stand-in match data derived from the given orders, customer and nation tables.

It only serves the checks and the bench; the library takes any frame with the contract columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_MAPPING = {
    "date": "match_date",
    "home_team": "home",
    "away_team": "away",
    "home_score": "h_points",
    "away_score": "a_points",
    "tournament": "event",
    "neutral": "elsewhere",
}


# Naming the schema saves a read of file footers per table.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One match per order, in the shape of the warehouse table."""
    orders = _table(spark, sf_dir, "orders")
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation")
    hosts = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("host"))
    guests = nation.select(F.col("n_nationkey").alias("guest_key"), F.col("n_name").alias("guest"))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    h = ((key * 7919 + cust * 104729) % 1009).cast("int")
    a = ((key * 6151 + cust * 3079) % 1013).cast("int")
    played = (
        orders.join(customer.join(hosts, "c_nationkey"), cust == F.col("c_custkey"))
        .withColumn("guest_key", ((F.col("c_nationkey") + 1 + key % 24) % 25).cast("int"))
        .join(guests, "guest_key")
        .withColumns({"h": h, "a": a})
    )
    h, a = F.col("h"), F.col("a")
    return played.select(
        key.alias("match_id"),
        F.col("o_orderdate").cast("date").alias("match_date"),
        F.concat_ws(" ", "host", "c_mktsegment").alias("home_team"),
        F.concat_ws(" ", "guest", "c_mktsegment").alias("away_team"),
        F.when(h == 7, 24).when(h == 11, 31).when(h % 2 == 0, h % 3).otherwise(h % 6).alias("home_score"),
        F.when(a == 5, 22).when(a % 2 == 0, a % 3).otherwise(a % 4).alias("away_score"),
        F.concat_ws(" ", "c_mktsegment", "o_orderpriority").alias("tournament"),
        F.when(key % 17 != 0, F.concat(F.lit("City "), cust % 40)).alias("city"),
        F.when(key % 23 != 0, F.col("host")).alias("country"),
        F.when(F.col("o_orderstatus") == "O", True).when(F.col("o_orderstatus") == "F", False).alias("neutral"),
    )


def raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same orders as dirty source text under foreign names; every 200th row comes twice."""
    orders = _table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    def each(divisor: int) -> Column:
        return key % divisor == 0

    tokens = ["true", "1", " YES ", "y", "Neutral", "false", "0", "No", "n", "home", "maybe", None]
    spelled = F.element_at(F.array(*[F.lit(t) for t in tokens]), (key % 12 + 1).cast("int"))
    base = orders.select(
        key.alias("k"),
        F.when(each(97), "not_a_date")
        .when(~each(89), F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd"))
        .alias("match_date"),
        F.concat(F.lit("  Team "), cust % 40, F.lit(" ")).alias("home"),
        F.concat(F.lit("Team "), F.when(each(211), cust % 40).otherwise(40 + cust % 37)).alias("away"),
        F.when(each(101), "abc")
        .when(each(103), "1.5")
        .when(each(107), "-1")
        .when(each(109), "1d")
        .when(each(2), F.concat(key % 5, F.lit(".0")))
        .otherwise((key % 24).cast("string"))
        .alias("h_points"),
        F.when(~each(113), F.concat(F.lit(" "), cust % 6)).alias("a_points"),
        F.when(each(127), "   ").otherwise(F.col("o_orderpriority")).alias("event"),
        spelled.alias("elsewhere"),
        F.col("o_orderstatus").alias("remark"),
    )
    copies = F.when(each_key(200), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return base.select("*", F.explode(copies).alias("copy")).drop("k", "copy")


def each_key(divisor: int) -> Column:
    return F.col("k") % divisor == 0

"""Repeated rows by the two ways, against counting in plain Python."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.operators import duplicates


def test_gaps_come_back():
    r = np.random.default_rng(3)
    cases = [np.array([5]), np.array([0, 1]), np.arange(100), np.array([0, 1 << 61]), np.array([7, 8, 1 << 40, (1 << 40) + 1])]
    cases += [np.unique(r.integers(0, 1 << bits, n)) for bits in (4, 20, 35, 61) for n in (2, 9, 5000)]
    for values in cases:
        assert duplicates.unpack_gaps(duplicates.pack_gaps(values.astype(np.int64))).tolist() == values.tolist()
    spread = np.unique(r.integers(0, 1 << 35, 1 << 18))
    assert len(duplicates.pack_gaps(spread)) < 2.6 * len(spread)


def rows(seed, n):
    r = random.Random(seed)
    some = [(r.randrange(50), r.choice(["a", "b", "", None, "a:1"]), r.choice([True, False, None]), r.choice([None, "1", "a"])) for _ in range(n)]
    return some + [(1, "hot", None, "x")] * (n // 2)


@pytest.mark.parametrize("run_rows, range_rows, broadcast", [(1 << 20, 1 << 22, 500_000), (64, 100, 500_000), (64, 1 << 22, 3)])
def test_both_ways_count_the_same(spark, monkeypatch, run_rows, range_rows, broadcast):
    for name, value in {"SMALL_BYTES": 0, "RUN_ROWS": run_rows, "RANGE_ROWS": range_rows, "BROADCAST_HASHES": broadcast}.items():
        monkeypatch.setattr(duplicates, name, value)
    for seed, n in ((1, 0), (2, 1), (3, 700)):
        data = rows(seed, n)
        frame = spark.createDataFrame(data, "hash int, b string, hash_of_row boolean, d string").repartition(5)
        want = sum(c - 1 for c in Counter(data).values())
        assert duplicates.duplicate_rows(frame).collect() == [(want,)] == duplicates.repeats(frame).collect()


def test_unique_rows_and_other_columns(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "SMALL_BYTES", 0)
    frame = spark.range(0, 5000, 1, 4).withColumn("x", F.col("id").cast("string"))
    assert duplicates.duplicate_rows(frame).first()[0] == 0
    assert duplicates.duplicate_rows(frame.unionByName(frame.filter("id < 7"))).first()[0] == 7
    nested = frame.select((F.col("id") % 3).alias("n"), F.array((F.col("id") % 2).cast("double")).alias("a"))
    assert duplicates.duplicate_rows(nested).first()[0] == 5000 - 6


def test_small_inputs_need_no_job(spark):
    frame = spark.range(100).selectExpr("id % 10 AS a", "cast(id % 5 AS string) AS b")
    assert duplicates.input_bytes(frame) < duplicates.SMALL_BYTES
    assert duplicates.duplicate_rows(frame).first()[0] == 90

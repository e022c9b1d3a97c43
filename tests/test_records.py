"""CSV files with line breaks inside quotes by many tasks, and folders of files with different headers."""

import csv as python_csv
import io
import random

import pytest
from pyspark.sql import functions as F

from touchline import contract as C
from touchline.plans import jobs
from touchline.session import session_conf
from touchline.sources import csv, outputs, records, table

FIELDS = ["date", "home_team", "away_team", "note"]


def written(rows, names=FIELDS, end="\n"):
    out = io.StringIO()
    python_csv.writer(out, lineterminator=end).writerows([names, *rows])
    return out.getvalue()


def made(seed, n):
    r = random.Random(seed)
    pieces = ["plain", 'a "quoted" word', "two\nlines", "é,ü", "\n", "three\n\nlines\n", '"', "x" * 40, "many " * 300 + "\nlines"]
    return [("2024-01-%02d" % r.randint(1, 28), f"Team {r.randint(0, 9)}", r.choice(pieces) + "w", r.choice(pieces) + r.choice(pieces) + "z") for _ in range(n)]


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("split", ["64", "1000", "7777", "64m"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_lines_in_any_split(spark, tmp_path, split, end):
    rows = made(len(split), 60)
    path = tmp_path / "m.csv"
    path.write_bytes(written(rows, end=end).encode())
    with session_conf(spark, spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1"):
        found = csv.read_matches_csv(spark, str(path), multi_line=True, na_tokens=())
        assert found.columns == FIELDS
        if split in ("64", "1000"):
            assert found.rdd.getNumPartitions() > 8
        assert sorted((str(d), h, a, n) for d, h, a, n in found.collect()) == sorted((d, h, a.strip(), n.strip()) for d, h, a, n in rows)


def test_same_rows_as_the_reader_of_one_task(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text(written(made(4, 200)) + "\n\n2024-02-30,short\n", encoding="utf-8")
    one = spark.read.options(header=True, multiLine=True, escape='"').csv(str(path)).select("home_team", "note")
    with session_conf(spark, spark__sql__files__maxPartitionBytes="3000", spark__sql__files__openCostInBytes="1"):
        many = csv.read_matches_csv(spark, str(path), multi_line=True, na_tokens=()).select("home_team", "note")
        assert sorted_rows(many) == sorted_rows(one.select("home_team", F.trim(F.regexp_replace("note", r"^\s+|\s+$", "")).alias("note")))


def test_many_open_blocks_are_met_by_a_shuffle(spark, tmp_path, monkeypatch):
    rows = made(9, 80)
    (tmp_path / "m.csv").write_text(written(rows), encoding="utf-8")
    with session_conf(spark, spark__sql__files__maxPartitionBytes="500", spark__sql__files__openCostInBytes="1"):
        few = sorted_rows(records.csv_records(spark, str(tmp_path / "m.csv")))
        monkeypatch.setattr(records, "BROADCAST_BLOCKS", 2)
        shuffled = records.csv_records(spark, str(tmp_path / "m.csv"))
        assert "REPARTITION_BY_COL" in shuffled._jdf.queryExecution().toString()
        assert sorted_rows(shuffled) == few


def test_errors_are_kept(spark, tmp_path):
    def read(text, name):
        (tmp_path / name).write_bytes(text)
        with csv.scan_errors():
            return csv.read_matches_csv(spark, str(tmp_path / name), multi_line=True).collect()

    head = b"date,home_team,away_team\n"
    with pytest.raises(ValueError, match="more fields"):
        read(head + b'2024-01-01,"a\nb",c,d\n', "long.csv")
    with pytest.raises(ValueError, match="unclosed quote"):
        read(head + b'2024-01-01,"a\nb",c\n2024-01-01,"x\ny,z\n', "open.csv")
    with pytest.raises(ValueError, match="UTF-8"):
        read(head + "2024-01-01,\"Rh\nône\",c\n".encode("latin-1"), "latin.csv")
    assert read(head, "empty.csv") == []
    assert [r["home_team"] for r in read(b"\xef\xbb\xbf" + head + b'2024-01-01,"a\r\nb",c', "bom.csv")] == ["a\nb"]


def test_jobs_take_records_over_lines(spark, tmp_path):
    rows = [("2024-01-01", "A\nB", "C", 1, 0, "Cup"), ("2024-01-02", "D", "E", 2, 2, "Cup")]
    (tmp_path / "s.csv").write_text(written(rows, C.REQUIRED), encoding="utf-8")
    done = jobs.standardize_job(spark, str(tmp_path / "s.csv"), {c: c for c in C.REQUIRED}, str(tmp_path / "out"), multi_line=True)
    assert done.first()["is_successful"] and spark.read.parquet(str(tmp_path / "out")).filter("home_team = 'A\nB'").count() == 1


@pytest.mark.parametrize("multi_line", [False, True])
def test_folder_with_different_headers(spark, tmp_path, multi_line):
    texts = {
        "a [1].csv": "Date,home_team,away_team,city\n2024-01-01,A,B,Porto\n",
        "b.csv": "away_team, HOME_TEAM ,date\nD,C,2024-01-02\n",
        "c.CSV": "date,home_team,away_team,city\n2024-01-03,E,F,Faro\n",
        "d.csv": "﻿Date,home_team,away_team,city\n2024-01-04,G,H,Braga\n",
        "skip.txt": "x\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    found = csv.read_matches_dir(spark, str(tmp_path), multi_line=multi_line)
    assert found.columns == ["date", "home_team", "away_team", "city", "source_file"]
    assert [tuple(map(str, r)) for r in found.orderBy("date").collect()] == [
        ("2024-01-01", "A", "B", "Porto", "a [1].csv"), ("2024-01-02", "C", "D", "None", "b.csv"),
        ("2024-01-03", "E", "F", "Faro", "c.CSV"), ("2024-01-04", "G", "H", "Braga", "d.csv"),
    ]
    (tmp_path / "e.csv").write_text("city,CITY \nx,y\n", encoding="utf-8")
    with pytest.raises(ValueError, match="city"):
        csv.read_matches_dir(spark, str(tmp_path), multi_line=multi_line)


def test_splits_that_change_between_the_passes_fail(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text(written(made(3, 80)), encoding="utf-8")
    with session_conf(spark, spark__sql__files__maxPartitionBytes="700", spark__sql__files__openCostInBytes="1"):
        found = csv.read_matches_csv(spark, str(path), multi_line=True)
    with session_conf(spark, spark__sql__files__maxPartitionBytes="900", spark__sql__files__openCostInBytes="1"), pytest.raises(Exception, match="Read the file again"):
        found.collect()

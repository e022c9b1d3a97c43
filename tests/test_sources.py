from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import VALID, as_dicts, changed
from touchline import contract as C
from touchline.operators.enrich import enrich_matches
from touchline.plans import jobs
from touchline.session import session_conf
from touchline.sources import csv, files, outputs, table

HEADER = "Date ,home_team,AWAY_team,home_score,away_score,tournament,city,country,neutral\n"
LINES = (
    "2024-02-10,Harbour Lions,Mill Town,4,1,Coast Shield,Westport,Lowland,false\n"
    "2024-02-17,Rhone Valley,Old Quarry,3,3,Coast Shield,Easton,Lowland,true\n"
)
SAME = {c: c for c in C.CONTRACT}


@pytest.fixture
def file(tmp_path):
    def write(text, name="matches.csv", encoding="utf-8"):
        path = tmp_path / name
        path.write_bytes(text.encode(encoding))
        return str(path)

    return write


@pytest.fixture
def new_table(spark, tmp_path):
    name = "t_" + tmp_path.name.replace("-", "_")
    table.ensure_matches_table(spark, name, str(tmp_path / "warehouse"))
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


# --- CSV ---------------------------------------------------------------------------------------


def test_read_and_validate(spark, file):
    data, report = csv.read_and_validate(spark, file(HEADER + LINES), date(2025, 1, 1))
    assert data.columns == list(C.CONTRACT)
    assert data.count() == 2 and report.count() == 0
    assert data.schema["date"].dataType.simpleString() == "date"


def test_long_lines_fail_and_short_ones_are_filled(spark, file, tmp_path):
    path = file(HEADER + LINES + "2024-03-03,A,B,1\n")
    assert [r["tournament"] for r in csv.read_matches_csv(spark, path).orderBy("date").collect()][2] is None
    long = file(HEADER + LINES + '2024-01-03,A,"B, ""C""",1,0,Cup,Final,X,Y,true\n', "long.csv")
    for read in (lambda d: d.count(), lambda d: d.select("home_team").collect(), lambda d: d.collect()):
        with pytest.raises(ValueError, match="more fields"), csv.scan_errors():
            read(csv.read_matches_csv(spark, long))
    with pytest.raises(ValueError, match="more fields"), csv.scan_errors():
        csv.read_matches_dir(spark, str(tmp_path)).count()
    for job in (lambda: jobs.standardize_job(spark, long, SAME, str(tmp_path / "out")), lambda: jobs.profile_job(spark, long)):
        with pytest.raises(ValueError, match="more fields"):
            job()


def test_open_quotes_name_the_option(spark, file):
    text = HEADER + '2024-01-01,"Alpha\nUnited",B,1,0,Cup,C,D,true\n'
    with pytest.raises(ValueError, match="multi_line"), csv.scan_errors():
        csv.read_matches_csv(spark, file(text)).collect()
    assert csv.read_matches_csv(spark, file(text), multi_line=True).first()["home_team"] == "Alpha\nUnited"


def test_clashing_headers_are_named(spark, file):
    with pytest.raises(ValueError, match="home_team"):
        csv.read_matches_csv(spark, file("Home_Team, home_team\na,b\n"))


def test_file_names_come_as_given(spark, file, tmp_path):
    names = sorted(["my season ü.csv", "a+b.csv", "50%.csv"])
    for name in names:
        file(HEADER + LINES, name)
    found = csv.read_matches_dir(spark, str(tmp_path)).select("source_file").distinct().collect()
    assert sorted(r["source_file"] for r in found) == names
    assert sorted(r["name"] for r in csv.list_match_files(spark, str(tmp_path)).collect()) == names


def test_layouts_reach_the_jobs(spark, file, tmp_path):
    text = "day,h,a,x,y,t\n31/12/2023,A,B,10,9,Cup\n2024-01-01T18:00:00,C,D,1,0,Cup\n2024-01-02 18:00,C,D,1,0,Cup\n"
    mapping = dict(zip(C.REQUIRED, ["day", "h", "a", "x", "y", "t"]))
    formats = (*C.DATE_FORMATS, (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"))
    out = str(tmp_path / "out.csv")
    assert jobs.standardize_job(spark, file(text), mapping, out, fmt="csv", date_formats=formats).first()["is_successful"]
    rows, _ = table.open_matches(spark, None, out)
    assert [str(r["date"]) for r in rows.orderBy("date").collect()] == ["2023-12-31", "2024-01-01", "2024-01-02"]
    assert rows.filter("home_score > away_score").count() == 3  # 10 is more than 9


def test_absent_source_counts_zero(spark, new_table):
    assert [tuple(r) for r in table.rows_by_source(spark, new_table, "none.csv").collect()] == [("none.csv", 0)]


def test_missing_tokens_blanks_quotes_and_bad_dates(spark, file):
    text = HEADER + 'bad," Álpha, ""A"" ",NA, NA ,   ,None,"","N/A",\n'
    row = csv.read_matches_csv(spark, file(text)).first()
    assert row["date"] is None and row["home_team"] == 'Álpha, "A"' and row["away_team"] is None
    assert row["home_score"] == "NA" and row["away_score"] == ""
    assert row["tournament"] is None and row["city"] is None and row["country"] is None and row["neutral"] is None


def test_byte_order_mark_and_accents_in_header(spark, file):
    data = csv.read_matches_csv(spark, file("﻿Date,Équipe\n2024-01-01,x\n"))
    assert data.columns == ["date", "équipe"] and data.first()["équipe"] == "x"


def test_text_that_is_not_utf8_is_an_error(spark, file):
    path = file(HEADER + LINES.replace("Rhone", "Rhône"), encoding="latin-1")
    with pytest.raises(ValueError, match="UTF-8"), csv.scan_errors():
        csv.read_matches_csv(spark, path).collect()


def test_replacement_character_is_legal_text(spark, file):
    path = file(HEADER + LINES.replace("Rhone", "Rh�ne"))
    assert "Rh�ne Valley" in {r["home_team"] for r in csv.read_matches_csv(spark, path).collect()}


def test_header_that_is_not_utf8_is_an_error(spark, file):
    with pytest.raises(ValueError, match="UTF-8"):
        csv.read_matches_csv(spark, file("Équipe\nx\n", encoding="latin-1"))


def test_line_break_inside_quotes_needs_multi_line(spark, file):
    path = file(HEADER + LINES.replace("Westport", '"West\nport"'))
    assert csv.read_matches_csv(spark, path, multi_line=True).count() == 2


def test_missing_file_and_wrong_suffix(spark, file, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv.read_matches_csv(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ValueError, match=r"\.csv"):
        csv.read_matches_csv(spark, file("test", "matches.txt"))


def test_directory_lists_csv_files_by_name(spark, file, tmp_path):
    file(HEADER + LINES, "c.CSV")
    file(HEADER + LINES, "a.csv")
    file("x\n", "b.txt")
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "d.csv").write_text(HEADER + LINES)
    listed = csv.list_match_files(spark, str(tmp_path)).collect()
    assert [r["name"] for r in listed] == ["a.csv", "c.CSV"]
    rows = csv.read_matches_dir(spark, str(tmp_path))
    assert {(r["source_file"], r["n"]) for r in rows.groupBy("source_file").agg(F.count("*").alias("n")).collect()} == {
        ("a.csv", 2),
        ("c.CSV", 2),
    }


def test_directory_with_different_headers_is_joined_by_name(spark, file, tmp_path):
    file(HEADER + LINES, "a.csv")
    file(LINES.splitlines()[0].replace("2024", "2023") + "\n", "empty_header.csv")
    file("home_team,date\nOther,2022-01-01\n", "b.csv")
    found = csv.read_matches_dir(spark, str(tmp_path)).orderBy("date").filter("date is not null").collect()
    assert [(r["home_team"], r["city"], r["source_file"]) for r in found] == [
        ("Other", None, "b.csv"), ("Harbour Lions", "Westport", "a.csv"), ("Rhone Valley", "Easton", "a.csv"),
    ]


def test_directory_errors(spark, file, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv.list_match_files(spark, str(tmp_path / "absent"))
    with pytest.raises(NotADirectoryError):
        csv.read_matches_dir(spark, file(HEADER))


# --- outputs -----------------------------------------------------------------------------------


def test_output_is_refused_then_replaced(spark, valid, tmp_path):
    path = str(tmp_path / "out")
    outputs.write_output(valid, path)
    with pytest.raises(FileExistsError):
        outputs.write_output(valid.limit(1), path)
    assert spark.read.parquet(path).count() == 2
    outputs.write_output(valid.limit(1), path, overwrite=True)
    assert spark.read.parquet(path).count() == 1
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_failed_output_leaves_the_old_one(spark, valid, tmp_path):
    path = str(tmp_path / "out")
    outputs.write_output(valid, path)
    broken = valid.withColumn("city", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        outputs.write_output(broken, path, overwrite=True)
    assert spark.read.parquet(path).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_export_slice(spark, valid, tmp_path):
    path = str(tmp_path / "slice.csv")
    outputs.export_slice(enrich_matches(valid), path)
    text = spark.read.option("header", True).csv(path)
    assert text.columns == list(C.CONTRACT)
    assert {r["date"] for r in text.collect()} == {"2024-02-10", "2024-02-17"}


def test_csv_output_keeps_blanks(spark, valid, tmp_path):
    path = str(tmp_path / "blank.csv")
    outputs.write_output(valid.withColumn("city", F.lit(" NA ")), path, fmt="csv")
    assert {r["city"] for r in csv.read_matches_csv(spark, path).collect()} == {"NA"}


# --- standardise job ---------------------------------------------------------------------------


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_standardize_job_publishes(spark, file, tmp_path, fmt):
    source, out = file(HEADER + LINES), str(tmp_path / "interim" / "matches.csv")
    audit = jobs.standardize_job(spark, source, SAME, out, fmt=fmt).first()
    assert audit["is_successful"] and audit["output_file"] == out and audit["source_file"] == source
    rows = jobs.read_back(spark, out) if fmt == "csv" else spark.read.parquet(out)
    assert rows.columns == list(C.CONTRACT) and rows.count() == 2
    assert open(source).read() == HEADER + LINES


def test_standardize_job_refuses_then_replaces(spark, file, tmp_path):
    source, out = file(HEADER + LINES), str(tmp_path / "out")
    jobs.standardize_job(spark, source, SAME, out)
    again = jobs.standardize_job(spark, source, SAME, out).first()
    assert not again["is_successful"] and again["output_file"] is None
    assert any("already exists" in e for e in again["errors"])
    assert jobs.standardize_job(spark, source, SAME, out, overwrite=True).first()["is_successful"]


def test_standardize_job_writes_nothing_on_errors(spark, file, tmp_path):
    bad = file(HEADER + LINES.replace(",4,1,", ",1.5,1,"))
    audit = jobs.standardize_job(spark, bad, SAME, str(tmp_path / "out"))
    row = audit.first()
    assert not row["is_successful"] and row["output_file"] is None
    assert "Column 'home_score' cannot be safely converted to integer scores." in row["errors"]
    assert [p.name for p in tmp_path.iterdir()] == ["matches.csv"]
    jobs.write_audit(audit, str(tmp_path / "audit"))
    assert spark.read.parquet(str(tmp_path / "audit")).filter("section = 'errors'").count() == len(row["errors"])


def test_standardize_job_keeps_the_old_output_on_errors(spark, file, tmp_path):
    out = str(tmp_path / "out")
    jobs.standardize_job(spark, file(HEADER + LINES), SAME, out)
    bad = file(HEADER + LINES.replace("Old Quarry", "Rhone Valley"), "bad.csv")
    assert not jobs.standardize_job(spark, bad, SAME, out, overwrite=True).first()["is_successful"]
    assert spark.read.parquet(out).count() == 2


def test_standardize_job_warns_about_duplicates(spark, file, tmp_path):
    text = HEADER + LINES + LINES
    audit = jobs.standardize_job(spark, file(text), SAME, str(tmp_path / "out")).first()
    assert audit["is_successful"] and audit["warnings"] == ["Duplicate rows found in the dataset."]


def test_standardize_job_with_a_broken_mapping(spark, file, tmp_path):
    audit = jobs.standardize_job(spark, file(HEADER + LINES), {"date": "nowhere"}, str(tmp_path / "out")).first()
    assert not audit["is_successful"] and audit["input_rows"] == 2 and not (tmp_path / "out").exists()


def test_standardize_job_rejects_other_encodings(spark, file, tmp_path):
    path = file(HEADER + LINES.replace("Rhone", "Rhône"), encoding="latin-1")
    with pytest.raises(ValueError, match="UTF-8"):
        jobs.standardize_job(spark, path, SAME, str(tmp_path / "out"))
    assert [p.name for p in tmp_path.iterdir()] == ["matches.csv"]


def test_profile_job(spark, file, tmp_path):
    text = HEADER + LINES.replace(",4,1,", ",-1,1,")
    table_level, columns = jobs.profile_job(spark, file(text), str(tmp_path / "profile"), date(2025, 1, 1))
    row = table_level.first()
    assert row["source_file"] == "matches.csv" and row["row_count"] == 2 and row["date_max"] == "2024-02-17"
    assert row["validation_errors"] == ["Column 'home_score' must contain non-negative integer scores."]
    assert row["validation_warnings"] == []
    assert spark.read.parquet(str(tmp_path / "profile" / "column_profile")).count() == columns.count() == 9


# --- warehouse table ---------------------------------------------------------------------------


def test_prepare_for_load(valid):
    rows = table.prepare_for_load(valid, "season.csv")
    assert rows.columns == list(C.LOAD_COLUMNS)
    assert rows.schema["home_score"].dataType.simpleString() == "int"
    assert {r["source_file"] for r in rows.collect()} == {"season.csv"}


def test_prepare_rejects_errors_with_all_messages(make):
    bad = make([changed(VALID[0], home_score=-1, away_team="Harbour Lions")])
    with pytest.raises(ValueError, match="non-negative integer scores.; home_team must not be equal"):
        table.prepare_for_load(bad, "x.csv")


def test_first_load_and_ids(spark, valid, new_table):
    stamp = datetime(2025, 1, 1, 12)
    assert table.load_matches(spark, valid, new_table, "a.csv", loaded_at=stamp) == 2
    rows = spark.table(new_table).collect()
    assert len({r["match_id"] for r in rows}) == 2 and min(r["match_id"] for r in rows) >= 1
    assert {r["loaded_at"] for r in rows} == {stamp}
    table.load_matches(spark, valid, new_table, "b.csv")
    ids = [r["match_id"] for r in spark.table(new_table).orderBy("source_file", "match_id").collect()]
    assert len(set(ids)) == 4 and max(ids[:2]) < min(ids[2:])


def test_ids_have_no_gaps_however_many_tasks_load(spark, make, new_table):
    rows = make([changed(VALID[i % 2], date=f"2024-0{1 + i % 9}-11") for i in range(640)]).repartition(64)
    assert table.load_matches(spark, rows, new_table, "a.csv") == 640
    assert table.load_matches(spark, rows.limit(7), new_table, "b.csv") == 7
    ids = sorted(r["match_id"] for r in spark.table(new_table).collect())
    assert ids == list(range(1, 648))


def test_loads_at_the_same_time(spark, make, new_table):
    table.ensure_matches_table(spark, new_table)
    rows = {f"{n}.csv": make([changed(VALID[i % 2], date=f"2024-0{1 + i % 9}-11") for i in range(100 + n)]).repartition(4) for n in range(4)}
    with ThreadPoolExecutor(4) as pool:
        loaded = list(pool.map(lambda name: table.load_matches(spark, rows[name], new_table, name), rows))
    assert loaded == [100, 101, 102, 103]
    assert {r["source_file"]: r["row_count"] for r in table.rows_by_source(spark, new_table).collect()} == dict(zip(rows, loaded))
    assert sorted(r["match_id"] for r in spark.table(new_table).select("match_id").collect()) == list(range(1, 407))
    # Each source has a run of ids of its own.
    ends = spark.table(new_table).groupBy("source_file").agg((F.max("match_id") - F.min("match_id") + 1).alias("ids"), F.count("*").alias("n"))
    assert all(r["ids"] == r["n"] for r in ends.collect())
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_claims_by_many_writers(spark, valid, new_table):
    assert table.load_matches(spark, valid, new_table, "a.csv") == 2
    with ThreadPoolExecutor(8) as pool:
        starts = list(pool.map(lambda n: (table.claim_ids(spark, new_table, n), n), [3, 1, 4, 1, 5, 9, 2, 6]))
    at = 3
    for start, n in sorted(starts):
        assert start == at
        at += n
    assert table.claim_ids(spark, new_table, 1) == 34


def test_ids_go_on_where_a_table_without_claims_ends(spark, valid, new_table):
    table.load_matches(spark, valid, new_table, "a.csv")
    files.delete(spark, f"{table.table_location(spark, new_table)}/_match_ids")
    table.load_matches(spark, valid, new_table, "b.csv")
    assert sorted(r["match_id"] for r in spark.table(new_table).collect()) == [1, 2, 3, 4]


def test_a_file_is_created_once_and_whole(spark, tmp_path):
    path = str(tmp_path / "deep" / "claim")
    assert files.create_whole(spark, path, b"12") and not files.create_whole(spark, path, b"7")
    assert files.head(spark, path) == b"12" and files.names(spark, str(tmp_path / "deep")) == ["claim"]
    assert files.names(spark, str(tmp_path / "none")) == []


def test_a_session_option_held_by_two(spark):
    name = "spark.sql.sources.partitionOverwriteMode"
    first, second = (session_conf(spark, spark__sql__sources__partitionOverwriteMode="dynamic") for _ in range(2))
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(name) == "dynamic"
    with pytest.raises(RuntimeError, match="held at dynamic"), session_conf(spark, spark__sql__sources__partitionOverwriteMode="static"):
        pass
    second.__exit__(None, None, None)
    assert spark.conf.get(name).lower() == "static"


def test_repeated_load_is_rejected_and_changes_nothing(spark, valid, new_table):
    table.load_matches(spark, valid, new_table, "a.csv")
    before = as_dicts(spark.table(new_table).orderBy("match_id"))
    with pytest.raises(ValueError, match="already exist"):
        table.load_matches(spark, valid, new_table, "a.csv")
    assert as_dicts(spark.table(new_table).orderBy("match_id")) == before


def test_replace_touches_only_the_same_source(spark, valid, new_table):
    table.load_matches(spark, valid, new_table, "a.csv")
    table.load_matches(spark, valid, new_table, "it's b.csv")
    kept = as_dicts(spark.table(new_table).filter("source_file = 'a.csv'").orderBy("match_id"))
    assert table.load_matches(spark, valid.limit(1), new_table, "it's b.csv", replace=True) == 1
    assert as_dicts(spark.table(new_table).filter("source_file = 'a.csv'").orderBy("match_id")) == kept
    counts = {r["source_file"]: r["row_count"] for r in table.rows_by_source(spark, new_table).collect()}
    assert counts == {"a.csv": 2, "it's b.csv": 1}
    assert table.rows_by_source(spark, new_table, "a.csv").first()["row_count"] == 2


@pytest.mark.parametrize(
    "defect",
    [{"home_score": -1}, {"home_score": None}, {"date": None}, {"away_team": " Harbour Lions"}, {"tournament": None}],
)
def test_broken_rows_load_nothing_and_keep_the_old(spark, make, new_table, defect):
    table.load_matches(spark, make(), new_table, "a.csv")
    with pytest.raises(ValueError, match="not valid for loading: "):
        table.load_matches(spark, make([changed(VALID[0], **defect), VALID[1]]), new_table, "a.csv", replace=True)
    assert spark.table(new_table).count() == 2
    # A refused load has claimed no ids.
    assert table.load_matches(spark, make(), new_table, "b.csv") == 2
    assert spark.table(new_table).agg(F.count_distinct("match_id")).first()[0] == 4


def test_failing_input_loads_nothing(spark, valid, new_table):
    table.load_matches(spark, valid, new_table, "a.csv")
    broken = valid.withColumn("city", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        table.load_matches(spark, broken, new_table, "a.csv", replace=True)
    assert spark.table(new_table).count() == 2


def test_empty_and_incomplete_input(spark, valid, new_table):
    with pytest.raises(ValueError, match="empty"):
        table.load_matches(spark, valid.limit(0), new_table, "a.csv")
    with pytest.raises(ValueError, match="Missing required columns: tournament"):
        table.load_matches(spark, valid.drop("tournament"), new_table, "a.csv")
    with pytest.raises(ValueError, match="converted to datetime"):
        table.load_matches(spark, valid.withColumn("date", F.lit("2024-01-01")), new_table, "a.csv")
    assert table.load_matches(spark, valid.drop("city", "country", "neutral"), new_table, "a.csv") == 2


def test_neutral_text_must_be_a_flag(spark, valid, new_table):
    assert table.load_matches(spark, valid.withColumn("neutral", F.lit("True")), new_table, "a.csv") == 2
    with pytest.raises(ValueError, match="neutral"):
        table.load_matches(spark, valid.withColumn("neutral", F.lit("maybe")), new_table, "b.csv")


def test_load_job(spark, file, new_table):
    path = file(HEADER + LINES, "season.csv")
    assert jobs.load_job(spark, path, new_table) == 2
    with pytest.raises(ValueError, match="already exist"):
        jobs.load_job(spark, path, new_table)
    assert jobs.load_job(spark, path, new_table, replace=True) == 2
    assert [r["neutral"] for r in spark.table(new_table).orderBy("match_date").collect()] == [False, True]


def test_loaded_files_are_sorted_by_date(spark, make, new_table):
    rows = [changed(VALID[i % 2], date=f"2024-01-{28 - i:02d}") for i in range(20)]
    table.load_matches(spark, make(rows).coalesce(1), new_table, "a.csv")
    place = spark.sql(f"DESCRIBE FORMATTED {new_table}").filter("col_name = 'Location'").first()["data_type"]
    dates = [r["match_date"] for r in spark.read.parquet(place).select("match_date").collect()]
    assert dates == sorted(dates) and len(dates) == 20


def test_open_matches_prefers_the_table(spark, valid, new_table, tmp_path):
    out = str(tmp_path / "interim")
    outputs.write_output(valid, out)
    table.load_matches(spark, valid, new_table, "a.csv")
    rows, label = table.open_matches(spark, new_table, out)
    assert label == f"table: {new_table}" and rows.columns == ["match_id", *C.CONTRACT]
    rows, label = table.open_matches(spark, "absent_table", out)
    assert label == f"file: {out}" and rows.count() == 2
    with pytest.raises(table.DataUnavailable):
        table.open_matches(spark, "absent_table", str(tmp_path / "absent"))


def test_swap_restores_the_old_output(spark, valid, tmp_path):
    target = str(tmp_path / "out")
    outputs.write_output(valid, target)
    with pytest.raises(Exception):
        files.swap_in(spark, str(tmp_path / "absent"), target)
    assert spark.read.parquet(target).count() == 2

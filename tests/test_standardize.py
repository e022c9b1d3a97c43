from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_dicts
from touchline import contract as C
from touchline.functions.parsing import normalize_neutral, parse_date
from touchline.functions.text import blank_to_null, strip
from touchline.operators.mapping import check_mapping, clean_mapping
from touchline.operators.standardize import audit_lines, standardize_matches
from pyspark.sql import types as T

MAPPING = {"date": "day", "tournament": "event", "home_team": "hosts", "away_team": "guests"}
MAPPING |= {"home_score": "for_hosts", "away_score": "for_guests", "neutral": "elsewhere"}
COLUMNS = ["day", "event", "hosts", "for_hosts", "guests", "for_guests", "elsewhere", "referee"]
SCHEMA = ", ".join(f"{c} string" for c in COLUMNS)
SOURCE = [
    ("2023-08-05", "League", "Harbour Lions ", "4", " Mill Town", "1", "Y ", "Ann"),
    ("2023-08-06", "League", "Old Quarry", "0", "Rhone Valley", "0", "No", "Bo"),
]


@pytest.fixture
def source(spark):
    def build(**values):
        rows = [tuple(values.get(n, v) for n, v in zip(COLUMNS, SOURCE[0])), SOURCE[1]]
        return spark.createDataFrame(rows, SCHEMA)

    return build


def run(df, mapping=MAPPING):
    data, audit = standardize_matches(df, mapping)
    return data, audit.first()


def test_renames_trims_types_and_order(source):
    data, audit = run(source())
    assert data.columns == list(C.CONTRACT)
    assert [f.dataType for f in data.schema.fields] == [f.dataType for f in C.INTERIM_SCHEMA.fields]
    first = data.orderBy("date").first()
    assert first["home_team"] == "Harbour Lions" and first["date"] == date(2023, 8, 5)
    assert first["home_score"] == 4 and first["neutral"] is True and first["city"] is None
    assert audit["is_successful"] and audit["errors"] == []
    assert audit["added_columns"] == ["city", "country"] and audit["dropped_columns"] == ["referee"]
    assert audit["renamed_columns"]["hosts"] == "home_team"
    assert audit["input_rows"] == audit["output_rows"] == 2
    assert audit["type_conversions"] == [
        "Converted 'date' to datetime.",
        "Converted 'home_score' to nullable integer.",
        "Converted 'away_score' to nullable integer.",
        "Standardized 'neutral' to nullable boolean.",
    ]


def test_fractional_score_is_refused(source):
    data, audit = run(source(for_hosts="1.5"))
    assert audit["errors"][0] == "Column 'home_score' cannot be safely converted to integer scores."
    assert "Column 'home_score' must contain non-negative integer scores." in audit["errors"]
    assert "Converted 'home_score' to nullable integer." not in audit["type_conversions"]
    assert data.count() == 2


def test_bad_score_text_is_no_missing_value(source):
    _, audit = run(source(for_hosts="abc"))
    assert not any("missing values" in e for e in audit["errors"])


def test_high_fractional_score_still_warns(source):
    _, audit = run(source(for_hosts="25.5"))
    assert any("suspiciously large" in w for w in audit["warnings"])


def test_negative_score_is_refused(source):
    _, audit = run(source(for_guests="-1"))
    assert not audit["is_successful"] and any("non-negative integer scores" in e for e in audit["errors"])


def test_same_team_after_trim_is_refused(source):
    _, audit = run(source(guests=" Harbour Lions"))
    assert "home_team must not be equal to away_team." in audit["errors"]


def test_unknown_neutral_warns_with_the_count_only(source):
    data, audit = run(source(elsewhere="maybe"))
    assert audit["warnings"] == [
        "Column 'neutral' contains unknown values. 1 value(s) were converted to missing."
    ]
    assert audit["is_successful"] and data.filter("neutral IS NULL").count() == 1


def test_duplicates_warn(spark):
    _, audit = run(spark.createDataFrame([SOURCE[0], SOURCE[0]], SCHEMA))
    assert audit["warnings"] == ["Duplicate rows found in the dataset."]


def test_typed_input_passes(source):
    df = source().withColumn("for_hosts", F.lit(3)).withColumn("day", F.lit(date(2024, 5, 1)))
    data, audit = run(df)
    assert audit["is_successful"] and {r["home_score"] for r in data.collect()} == {3}


def test_mapping_problems_are_all_reported(source):
    broken = {"date": "day", "home_team": "hosts", "away_team": "hosts", "colour": "nowhere"}
    errors = check_mapping(source().columns, broken)
    assert errors == [
        "Mapping contains unknown target fields: colour.",
        "Mapping is missing required target fields: home_score, away_score, tournament.",
        "Mapping reuses the same source column for multiple target fields: hosts.",
        "Source column 'nowhere' for target 'colour' was not found.",
    ]
    data, audit = run(source(), broken)
    assert audit["errors"] == errors and not audit["is_successful"]
    assert audit["input_rows"] == 2 and audit["output_rows"] == 0 and data.count() == 0


def test_clean_mapping():
    assert clean_mapping({" date ": " Match_Date "}) == {"date": "match_date"}


def test_audit_lines_hold_no_row_values(source):
    lines = as_dicts(audit_lines(standardize_matches(source(hosts="Top Secret Club"), MAPPING)[1]))
    assert not any("Top Secret" in (line["value"] or "") for line in lines)
    assert {"section": "added_columns", "position": 2, "value": "country"} in lines
    assert {"section": "renamed_columns", "position": 1, "value": "day -> date"} in lines


def test_neutral_tokens(spark):
    tokens = [*C.NEUTRAL_TRUE, *C.NEUTRAL_FALSE, None, "unsure", " Y "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "i int, t string")
    got = [r["n"] for r in df.select("i", normalize_neutral(F.col("t")).alias("n")).orderBy("i").collect()]
    assert got == [True] * 5 + [False] * 5 + [None, None, True]


@pytest.mark.parametrize(
    ("text", "day"),
    [("2024-01-05", date(2024, 1, 5)), ("2024-1-5", date(2024, 1, 5)), (" 2024-01-05 ", date(2024, 1, 5)), ("2024", None),
     ("2024-13-01", None), ("2024-02-30", None), ("05/01/2024", None), ("not_a_date", None), (None, None)],
)
def test_dates(spark, text, day):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_date(F.col("t"), T.StringType())).first()[0] == day


def test_other_date_layouts_can_be_named(spark):
    df = spark.createDataFrame([("05/01/2024",)], "t string")
    layouts = ((r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"),)
    assert df.select(parse_date(F.col("t"), T.StringType(), layouts)).first()[0] == date(2024, 1, 5)


def test_strip_equals_python(spark):
    texts = ["", " ", "a", " a b\t", " a ", "\x1fa\x85", "　é　", "日本 ", "​a", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["s"] for r in df.select("i", strip(F.col("t")).alias("s")).orderBy("i").collect()]
    assert got == [t.strip() if t is not None else None for t in texts]


def test_missing_tokens_are_compared_before_trimming(spark):
    df = spark.createDataFrame([("NA",), (" NA ",), ("",), ("nan",), ("Nan",)], "t string")
    got = [r[0] for r in df.select(blank_to_null(F.col("t"))).collect()]
    assert got == [None, " NA ", None, None, "Nan"]

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import VALID, changed
from touchline.operators.quality import duplicate_rows, validate_matches, validation_summary

AS_OF = date(2025, 1, 1)


def found(df, **options):
    return {(r["rule_id"], r["column"]): r for r in validate_matches(df, AS_OF, **options).collect()}


def test_valid_rows_have_no_findings(valid):
    assert found(valid) == {}
    row = validation_summary(valid, AS_OF).first()
    assert row["is_valid"] and row["row_count"] == 2 and row["column_count"] == 9
    assert row["errors"] == [] and row["warnings"] == []


def test_missing_required_column_stops_the_rules(valid):
    lines = found(valid.drop("tournament", "away_team").withColumn("home_score", F.lit(-1)))
    assert list(lines) == [("V2", None)]
    assert lines[("V2", None)]["message"] == "Missing required columns: away_team, tournament."


def test_empty_frame(valid):
    row = validation_summary(valid.limit(0), AS_OF).first()
    assert not row["is_valid"] and row["errors"] == ["DataFrame is empty."]


def test_negative_score(make):
    lines = found(make([changed(VALID[0], home_score=-1), VALID[1]]))
    assert lines[("V5", "home_score")]["violations"] == 1 and ("V5", "away_score") not in lines


def test_fractional_score(valid):
    lines = found(valid.withColumn("away_score", F.lit(1.5)))
    assert lines[("V5", "away_score")]["violations"] == 2


@pytest.mark.parametrize(
    ("text", "good"),
    [("3", True), ("3.0", True), ("+3", True), ("3e0", True), (" 3 ", True), (".5", False), ("1d", False), ("1f", False),
     ("0x1", False), ("inf", False), ("NaN", False), ("abc", False), ("", False), ("-1", False), ("1.5", False)],
)
def test_score_text(valid, text, good):
    lines = found(valid.withColumn("home_score", F.lit(text)))
    assert (("V5", "home_score") not in lines) is good


def test_null_score_violates_both_rules(make):
    lines = found(make([changed(VALID[0], home_score=None), VALID[1]]))
    assert {("V3", "home_score"), ("V5", "home_score")} <= set(lines)


def test_not_a_number_is_a_bad_score(valid):
    lines = found(valid.withColumn("home_score", F.lit(float("nan"))))
    assert lines[("V5", "home_score")]["violations"] == 2


def test_same_team_after_trimming_is_case_sensitive(make):
    same = changed(VALID[0], away_team="  Harbour Lions　")
    other = changed(VALID[0], away_team="harbour lions")
    assert found(make([same]))[("V7", None)]["violations"] == 1
    assert ("V7", None) not in found(make([other]))


def test_blank_teams_are_not_the_same_team(make):
    lines = found(make([changed(VALID[0], home_team=" ", away_team="")]))
    assert ("V7", None) not in lines
    assert lines[("V4", None)]["message"].endswith("in columns: away_team, home_team.")


def test_null_date(make):
    lines = found(make([changed(VALID[0], date=None), VALID[1]]))
    assert {("V3", "date"), ("V9", "date")} <= set(lines)


def test_text_date_is_a_type_error_and_skips_date_rules(valid):
    lines = found(valid.withColumn("date", F.lit("2099-01-01")))
    assert ("V8", "date") in lines and ("V9", "date") not in lines and ("V10", "date") not in lines


def test_future_date_and_today(make):
    lines = found(make([changed(VALID[0], date="2099-01-01"), changed(VALID[1], date="2025-01-01")]))
    assert lines[("V10", "date")]["violations"] == 1
    assert lines[("V10", "date")]["severity"] == "warning"


def test_duplicates_treat_nulls_as_equal(make):
    row = changed(VALID[0], city=None)
    df = make([row, row, row, VALID[1]])
    assert found(df)[("V12", None)]["violations"] == 2
    assert duplicate_rows(df).first()[0] == 2
    assert ("V12", None) not in found(df, duplicates=False)


def test_missing_optional_columns(valid):
    lines = found(valid.drop("city", "country", "neutral"))
    assert lines[("V11", None)]["message"] == "Missing optional columns: city, country, neutral."


def test_neutral_text_is_narrower_than_normalisation(valid):
    known = valid.withColumn("neutral", F.lit(" YES "))
    odd = valid.withColumn("neutral", F.lit("neutral"))
    assert ("V13", "neutral") not in found(known)
    assert found(odd)[("V13", "neutral")]["violations"] == 2


def test_neutral_numbers(valid):
    assert ("V13", "neutral") not in found(valid.withColumn("neutral", F.lit(1)))
    assert ("V13", "neutral") in found(valid.withColumn("neutral", F.lit(2)))


def test_high_score(make):
    lines = found(make([changed(VALID[0], home_score=21), changed(VALID[1], away_score=20)]))
    assert ("V6", "home_score") in lines and ("V6", "away_score") not in lines


def test_errors_come_in_rule_order(make):
    row = validation_summary(make([changed(VALID[0], date=None, home_score=None, away_team="Harbour Lions")]), AS_OF).first()
    assert row["errors"] == [
        "Required column 'date' contains missing values.",
        "Required column 'home_score' contains missing values.",
        "Column 'home_score' must contain non-negative integer scores.",
        "home_team must not be equal to away_team.",
        "Column 'date' contains invalid or missing datetime values.",
    ]

"""The table of record facts: eleven (fact_name, fact_value, details) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import contract as C
from touchline.functions import labels
from touchline.functions.numeric import row_count
from touchline.functions.ordering import sort_few
from touchline.operators.enrich import as_fact


def _day(match: str) -> Column:
    return F.date_format(F.col(match)["match_date"], "yyyy-MM-dd")


def _text(match: str) -> Column:
    """'home h:a away'; NULL if a part is missing."""
    m = F.col(match)
    score = F.concat(m["home_score"].cast("string"), F.lit(":"), m["away_score"].cast("string"))
    return F.concat(m["home_team"], F.lit(" "), score, F.lit(" "), m["away_team"])


def _fact(name: str, value: Column, details: Column) -> Column:
    return F.struct(F.lit(name).alias("fact_name"), value.cast("string").alias("fact_value"), details.alias("details"))


def _matches_text(count: Column) -> Column:
    return F.concat(count.cast("string"), F.lit(" matches"))


_SETS = {"score": ["year", "home_score", "away_score"], "tournament": ["tournament"], "country": ["country"], "city": ["city"]}


def _counts(matches: DataFrame, min_year_matches: int) -> DataFrame:
    """One row with all that counts and plain extremes say, from one reading of the matches.

    One aggregate over grouping sets counts matches per (year, score), tournament, country and city; rows of a set are told apart
    by its grouping id. Its groups, far fewer than matches, are then summed per year and per score, and the best of each kind is kept.
    """
    keys = list(dict.fromkeys(c for names in _SETS.values() for c in names))
    day = F.col("match_date")
    named = matches.select(F.year("match_date").alias("year"), *[F.col(c) for c in keys if c != "year"], "match_date")
    groups = named.groupingSets([[F.col(c) for c in names] for names in _SETS.values()], *keys).agg(
        F.grouping_id().alias("set_id"), row_count().alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )
    ids = {kind: sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in names) for kind, names in _SETS.items()}
    is_score, dated = F.col("set_id") == ids["score"], F.col("year").isNotNull()
    goals, difference = labels.total_goals(), F.col("home_score") - F.col("away_score")

    def line(kind: str, key: Column, wanted: Column, pair: Column | None = None) -> Column:
        names = F.lit(kind).alias("kind"), key.cast("string").alias("key"), F.lit(None).cast("string") if pair is None else pair
        return F.when(wanted, F.struct(*names[:2], names[2].alias("pair")))

    pair = F.to_json(F.struct("home_score", "away_score"))  # tells scores apart of which one is missing
    lines = [line("year", F.col("year"), is_score & dated), line("score", labels.scoreline(), is_score, pair)]
    lines += [line(kind, F.col(kind), F.col("set_id") == ids[kind]) for kind in ("tournament", "country", "city")]
    per_key = groups.select(
        F.explode(F.array_compact(F.array(*lines))).alias("of"), "n", "first_day", "last_day",
        F.when(goals.isNotNull(), F.col("n") * goals).alias("goals"), F.when(goals.isNotNull(), F.col("n")).alias("scored"),
        F.when(dated, difference).alias("difference"), F.when(dated, goals).alias("total"),
    ).groupBy("of.kind", "of.key", "of.pair").agg(
        F.sum("n").alias("n"), F.sum("goals").alias("goals"), F.coalesce(F.sum("scored"), F.lit(0)).alias("scored"),
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"),
        F.max("difference").alias("home_margin"), F.min("difference").alias("away_margin"), F.max("total").alias("most_goals"),
    )
    year = F.col("kind") == "year"
    mean = F.try_divide(F.col("goals").cast("decimal(20,0)"), F.col("scored").cast("decimal(20,0)"))
    rounded = F.round(mean, 2).cast("decimal(20,2)").alias("mean")
    number = F.col("key").cast("int").alias("year")
    ranked = F.struct((-F.col("n")).alias("minus_n"), F.col("key").alias("value"))

    def top(kind: str) -> Column:
        """The commonest value that is not missing; a scoreline with a missing score counts like any text."""
        return F.min(F.when((F.col("kind") == kind) & F.col("key").isNotNull(), ranked)).alias(kind)

    plain = [F.min("first_day"), F.max("last_day"), F.max("home_margin"), F.min("away_margin"), F.max("most_goals")]
    names = ("first_day", "last_day", "home_margin", "away_margin", "most_goals")
    return per_key.agg(
        *[f.alias(n) for f, n in zip(plain, names)],
        F.max(F.when(year, F.struct("n", number))).alias("busiest"),
        F.max(F.when(year & (F.col("n") >= min_year_matches) & mean.isNotNull(), F.struct(rounded, "n", number))).alias("richest"),
        *[top(kind) for kind in ("tournament", "country", "city", "score")],
    )


def _extreme_matches(matches: DataFrame, extremes: Column) -> DataFrame:
    """Five extreme matches. Only the few that reach one of the plain extremes are looked at, to settle the ties.

    A struct compares field by field, so its leading fields are the sort keys and the rest is the payload.
    """
    matches = matches.filter(F.col("match_date").isNotNull())
    difference, total = F.col("home_score") - F.col("away_score"), labels.total_goals()
    day, home_score, away_score = F.col("match_date"), F.col("home_score"), F.col("away_score")
    reaching = (
        day.isin(extremes["first_day"], extremes["last_day"])
        | difference.isin(extremes["home_margin"], extremes["away_margin"])
        | (total == extremes["most_goals"])
    )
    last_key = [F.col("match_id")] if "match_id" in matches.columns else []
    shown = [F.col(c) for c in ("match_date", "home_team", "away_team", "home_score", "away_score")]

    def keyed(*keys: Column) -> Column:
        return F.struct(*[k.alias(f"k{i}") for i, k in enumerate((*keys, *last_key))], *shown)

    return matches.filter(reaching).agg(
        F.min(keyed(day)).alias("oldest"),
        F.max(keyed(day)).alias("latest"),
        F.min(F.when(labels.home_won(), keyed(-difference, -home_score, day))).alias("home"),
        F.min(F.when(labels.away_won(), keyed(difference, -away_score, day))).alias("away"),
        F.min(F.when(total.isNotNull(), keyed(-total, -labels.top_score(), day))).alias("most"),
    )


def interesting_facts(matches: DataFrame, min_year_matches: int = C.MIN_YEAR_MATCHES) -> DataFrame:
    """Facts that the data cannot answer (no such match or group) are left out.

    The matches are read twice: once for all counts, whose one row is taken at once, and once, when the result is asked for, for the
    matches that reach an extreme. As a subquery the counts would be planned and read again for every place that uses them.
    """
    matches = as_fact(matches)
    counts = _counts(matches, min_year_matches)
    counts = matches.sparkSession.createDataFrame([counts.first()], counts.schema)
    counted = counts.select(F.struct(*counts.columns).alias("c")).scalar()
    found = _extreme_matches(matches, counted).withColumn("counted", counted)

    def margin(match: str) -> Column:
        m = F.col(match)
        return F.concat(F.abs(m["home_score"] - m["away_score"]).cast("string"), F.lit("-goal margin"))

    def dated_text(match: str) -> Column:
        return F.concat(_day(match), F.lit(": "), _text(match))

    best = F.col("most")
    goals = F.concat((best["home_score"] + best["away_score"]).cast("string"), F.lit(" total goals"))
    busy, rich = F.col("counted.busiest"), F.col("counted.richest")
    per_match = F.concat(rich["mean"].cast("string"), F.lit(" goals per match across "), _matches_text(rich["n"]))

    def commonest(name: str, kind: str) -> Column:
        best = F.col(f"counted.{kind}")
        return _fact(name, best["value"], _matches_text(-best["minus_n"]))

    facts = [
        _fact("Oldest recorded match", _day("oldest"), _text("oldest")),
        _fact("Most recent recorded match", _day("latest"), _text("latest")),
        _fact("Most active year", busy["year"], _matches_text(busy["n"])),
        _fact(f"Highest-scoring year ({min_year_matches}+ matches)", rich["year"], per_match),
        commonest("Tournament with most matches", "tournament"),
        commonest("Country hosting the most matches", "country"),
        commonest("Most frequent host city", "city"),
        _fact("Biggest home win", margin("home"), dated_text("home")),
        _fact("Biggest away win", margin("away"), dated_text("away")),
        _fact("Highest-scoring single match", goals, dated_text("most")),
        commonest("Most common scoreline", "score"),
    ]
    rows = F.array(*[F.struct(F.lit(i).alias("position"), fact.alias("fact")) for i, fact in enumerate(facts)])
    lines = found.select(F.inline(rows)).select("position", "fact.*")
    return sort_few(lines.filter(F.col("fact_value").isNotNull()), "position").drop("position")

"""Lenient readers for dates, scores and the neutral flag.

Each one accepts a column that already has the right type, so a frame can pass through twice.
stripped says that the text is trimmed already.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.contract import DATE_FORMATS, NEUTRAL_FALSE, NEUTRAL_TRUE, NUMBER_PATTERN
from touchline.functions.text import strip


def is_date(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType))


def parse_date(value: Column, data_type: T.DataType, formats=DATE_FORMATS, stripped: bool = False) -> Column:
    """Date column; text in none of the accepted layouts becomes NULL.

    The shape comes first because a cast alone accepts a bare year. A layout of None is the ISO order,
    which a cast reads faster than a pattern.
    """
    if isinstance(data_type, T.DateType):
        return value
    if is_date(data_type):
        return value.cast("date")
    if not isinstance(data_type, T.StringType):
        return F.lit(None).cast("date")
    text = value if stripped else strip(value)

    def read(layout: str | None) -> Column:
        return F.try_to_date(text, layout) if layout else text.try_cast("date")

    return F.coalesce(*[F.when(text.rlike(shape), read(layout)) for shape, layout in formats])


def parse_number(value: Column, data_type: T.DataType, stripped: bool = False) -> Column:
    """Numeric column, or NULL where the text is no number.

    The pattern comes first because a cast alone accepts suffixes such as '1d'.
    """
    if isinstance(data_type, (T.IntegralType, T.DoubleType)):
        return value
    if isinstance(data_type, T.NumericType):
        return value.cast("double")
    if isinstance(data_type, T.NullType):
        return F.lit(None).cast("bigint")
    text = value.cast("string") if stripped else strip(value.cast("string"))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def is_fractional(number: Column) -> Column:
    """TRUE for a number that is not whole. Infinities and NaN leave no remainder of 0, so they count too."""
    return F.coalesce(number % 1 != 0, F.lit(False))


def whole(number: Column) -> Column:
    """BIGINT of a whole number, else NULL."""
    return F.when(number % 1 == 0, number).try_cast("bigint")


def parse_score(value: Column, data_type: T.DataType) -> Column:
    """Whole number as BIGINT; anything else becomes NULL and is counted by the quality rules."""
    if isinstance(data_type, T.IntegralType):
        return value.cast("bigint")
    return whole(parse_number(value, data_type))


def normalize_neutral(value: Column, data_type: T.DataType | None = None, stripped: bool = False) -> Column:
    """Three-valued flag from text; NULL and unknown text both become NULL."""
    if isinstance(data_type, T.BooleanType):
        return value
    text = F.lower(value.cast("string") if stripped else strip(value.cast("string")))
    return F.when(text.isin(*NEUTRAL_TRUE), F.lit(True)).when(text.isin(*NEUTRAL_FALSE), F.lit(False))

"""Text clean-up expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.contract import NA_TOKENS, WHITESPACE


_ASCII_WHITESPACE = "".join(c for c in WHITESPACE if c.isascii())


def strip(text: Column) -> Column:
    """Remove every Unicode blank from both ends; a plain SQL trim only removes spaces.

    The cost of a trim grows with its character set, so text without multi-byte characters
    is trimmed with the short set.
    """
    ascii_only = F.octet_length(text) == F.length(text)
    short, full = F.btrim(text, F.lit(_ASCII_WHITESPACE)), F.btrim(text, F.lit(WHITESPACE))
    return F.when(ascii_only, short).otherwise(full)


def blank_to_null(text: Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Turn missing-value tokens into NULL. The comparison is exact, so ' NA ' stays text."""
    return F.when(text.isin(*tokens), F.lit(None)).otherwise(text)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def ref(name: str) -> Column:
    """Reference a column whose name may hold dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip_strings(df: DataFrame) -> DataFrame:
    """Trim all string columns in one projection and leave the others untouched."""
    text = set(string_columns(df))
    return df.select(*[strip(ref(c)).alias(c) if c in text else ref(c) for c in df.columns])

"""Published outputs: standardised data and exported slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline import contract as C
from touchline.sources import files


def write_output(df: DataFrame, path: str, overwrite: bool = False, fmt: str = "parquet") -> None:
    """Write a folder in one piece: staged beside the target, then moved in. Refuses to replace unless told to."""
    try:
        files.publish(df.sparkSession, path, lambda staged: write_as(df, staged, fmt), overwrite)
    except FileExistsError as error:
        raise FileExistsError(C.MSG_OUTPUT_EXISTS.format(path)) from error


def write_as(df: DataFrame, path: str, fmt: str) -> None:
    if fmt == "csv":
        # By default the writer trims text; blanks belong to the data.
        keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        df.write.options(header=True, escape='"', emptyValue="", **keep).csv(path)
    elif fmt == "parquet":
        df.write.parquet(path)
    else:
        raise ValueError(f"Output format must be parquet or csv, got: {fmt}")


def export_slice(matches: DataFrame, path: str, overwrite: bool = False) -> None:
    """Save the nine contract columns of a slice as CSV with plain dates."""
    day = F.date_format("date", "yyyy-MM-dd").alias("date")
    write_output(matches.select(day, *C.CONTRACT[1:]), path, overwrite, fmt="csv")

"""The match contract: columns, types, thresholds, fixed tokens and message texts."""

from __future__ import annotations

from pyspark.sql import types as T

REQUIRED = ("date", "home_team", "away_team", "home_score", "away_score", "tournament")
OPTIONAL = ("city", "country", "neutral")
CONTRACT = REQUIRED + OPTIONAL
SCORES = ("home_score", "away_score")
TEXT_COLUMNS = ("home_team", "away_team", "tournament", "city", "country")

INTERIM_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("home_team", T.StringType()),
        T.StructField("away_team", T.StringType()),
        T.StructField("home_score", T.LongType()),
        T.StructField("away_score", T.LongType()),
        T.StructField("tournament", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("neutral", T.BooleanType()),
    ]
)

# What a load provides, in table order; match_id and loaded_at are assigned by the load itself.
LOAD_COLUMNS = (
    "match_date",
    "home_team",
    "away_team",
    "home_score",
    "away_score",
    "tournament",
    "city",
    "country",
    "neutral",
    "source_file",
)

TABLE_SCHEMA = T.StructType(
    [
        T.StructField("match_id", T.LongType()),
        T.StructField("match_date", T.DateType()),
        T.StructField("home_team", T.StringType()),
        T.StructField("away_team", T.StringType()),
        T.StructField("home_score", T.IntegerType()),
        T.StructField("away_score", T.IntegerType()),
        T.StructField("tournament", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("neutral", T.BooleanType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("source_file", T.StringType()),
    ]
)

# ---------------------------------------------------------------------------
# Fixed values. They decide results, so they are written out plainly.
# ---------------------------------------------------------------------------

SUSPICIOUS_SCORE = 20
BIG_WIN_MARGIN = 5
MIN_TEAM_MATCHES = 100
MIN_TOURNAMENT_MATCHES = 50
MIN_YEAR_MATCHES = 50

# Text that a CSV scan reads as a missing value, compared before trimming (the pandas read_csv defaults).
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Accepted when standardising the neutral flag.
NEUTRAL_TRUE = ("true", "1", "yes", "y", "neutral")
NEUTRAL_FALSE = ("false", "0", "no", "n", "home")
# Accepted by the data-quality rule on raw neutral text (narrower on purpose).
NEUTRAL_KNOWN = ("true", "false", "0", "1", "yes", "no")

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Whole or fractional decimal text, with an optional exponent.
NUMBER_PATTERN = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"

# Accepted date layouts: the text shape, then the pattern that parses it (None: year-month-day, maybe with a time, which is cut off).
DATE_FORMATS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", None),
    (r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$", None),
)

RESULTS = ("Home win", "Draw", "Away win")

# Labels for the three-valued neutral flag: (TRUE, FALSE, missing).
VENUE_REPORT = ("neutral", "non_neutral", "unknown")
VENUE_QUERY = ("true", "false", "null")
VENUE_VIEW = ("Neutral", "Non-neutral", "Unknown")

# Message texts; users match on them.
MSG_EMPTY = "DataFrame is empty."
MSG_MISSING_REQUIRED = "Missing required columns: {}."
MSG_NULLS = "Required column '{}' contains missing values."
MSG_BLANK_TEXT = "Empty strings found after trimming spaces in columns: "
MSG_BAD_SCORE = "Column '{}' must contain non-negative integer scores."
MSG_HIGH_SCORE = "Column '{}' contains suspiciously large scores above {}."
MSG_SAME_TEAM = "home_team must not be equal to away_team."
MSG_DATE_TYPE = "Column 'date' must be converted to datetime."
MSG_BAD_DATE = "Column 'date' contains invalid or missing datetime values."
MSG_FUTURE_DATE = "Some match dates are in the future."
MSG_MISSING_OPTIONAL = "Missing optional columns: {}."
MSG_DUPLICATES = "Duplicate rows found in the dataset."
MSG_UNKNOWN_NEUTRAL = "Column 'neutral' contains unknown values."
MSG_NEUTRAL_COUNT = " value(s) were converted to missing."
MSG_UNSAFE_SCORE = "Column '{}' cannot be safely converted to integer scores."
MSG_UNKNOWN_TARGETS = "Mapping contains unknown target fields: {}."
MSG_MISSING_TARGETS = "Mapping is missing required target fields: {}."
MSG_REUSED_SOURCES = "Mapping reuses the same source column for multiple target fields: {}."
MSG_SOURCE_ABSENT = "Source column '{}' for target '{}' was not found."
MSG_DID_DATE = "Converted 'date' to datetime."
MSG_DID_SCORE = "Converted '{}' to nullable integer."
MSG_DID_NEUTRAL = "Standardized 'neutral' to nullable boolean."
MSG_OUTPUT_EXISTS = "Output already exists: {}. Use overwrite to replace it."
MSG_SOURCE_LOADED = "Rows for source_file '{}' already exist in matches."
MSG_NOT_LOADABLE = "Standardized data is not valid for loading: "
MSG_TOO_MANY_FIELDS = "A line of the CSV file has more fields than the header."
MSG_OPEN_QUOTE = "A line of the CSV file has an unclosed quote. Read files with line breaks inside quotes with multi_line=True."
MSG_SPLITS_CHANGED = "The blocks of a CSV file are not those whose quotes were counted. Read the file again."
MSG_HEADERS_CLASH = "CSV headers agree after trimming and lower-casing: {}."
MSG_NO_SCRATCH = "Set spark.checkpoint.dir to a folder that all machines share, or pass a path."
MSG_NOT_UTF8 = "Could not read the CSV file as UTF-8. Please check the file encoding."

"""Export-format lists and writer dialects as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from desklake import vocabulary as V

# Strftime token -> date_format token; other tokens are refused.
DATE_TOKENS = {"%Y": "yyyy", "%y": "yy", "%m": "MM", "%b": "MMM", "%B": "MMMM", "%d": "dd", "%j": "DDD", "%H": "HH", "%I": "hh",
               "%p": "a", "%M": "mm", "%S": "ss", "%f": "SSSSSS"}
# Characters that mean something in a date_format pattern, and where a run of them is plain text of a strftime format.
PATTERN_SIGNS = r"A-Za-z\[\]{}#"
LITERALS = rf"((?:(?<=^|[^%{PATTERN_SIGNS}])|(?<=%[A-Za-z]))[{PATTERN_SIGNS}]+)"
# Six fields as they are spelled in to_char style.
TO_CHAR_TOKENS = {"YYYY": "yyyy", "HH24": "HH", "MI": "mm", "SS": "ss", "DD": "dd"}


def only_parquet() -> Column:
    return F.array(F.lit(V.PARQUET))


def formats_or_parquet(formats: Column) -> Column:
    """A missing or empty list means parquet."""
    return F.when(F.size(F.coalesce(formats, F.array().cast("array<string>"))) > 0, formats).otherwise(only_parquet())


def has_format(formats: Column, name: str) -> Column:
    return F.array_contains(formats, name)


def formats_text(formats: Column) -> Column:
    """Sorted, comma-joined list, for comparison and display."""
    return F.array_join(F.sort_array(formats), ",")


def date_pattern(python_or_to_char: Column) -> Column:
    """The date_format pattern for a stored date format: strftime where a % stands in it, else to_char spelling.

    Plain text of a strftime format is quoted, quotes are doubled and %% is a percent sign.
    """
    percent_sign = "\u0001"
    strftime = F.replace(F.replace(python_or_to_char, F.lit("%%"), F.lit(percent_sign)), F.lit("'"), F.lit("''"))
    strftime = F.regexp_replace(strftime, LITERALS, "'$1'")
    for token, field in DATE_TOKENS.items():
        strftime = F.replace(strftime, F.lit(token), F.lit(field))
    to_char = python_or_to_char
    for token, field in TO_CHAR_TOKENS.items():
        to_char = F.replace(to_char, F.lit(token), F.lit(field))
    return F.when(F.contains(python_or_to_char, F.lit("%")), F.replace(strftime, F.lit(percent_sign), F.lit("%"))).otherwise(to_char)


def valid_date_format(python_or_to_char: Column) -> Column:
    """Known strftime tokens and any plain text, or the six to_char fields and plain separators."""
    letters = "".join(token[1] for token in DATE_TOKENS)
    known = F.regexp_like(python_or_to_char, F.lit(rf"^(?:%[{letters}%]|[^%\x00-\x1f])*$"))
    fields = F.regexp_like(date_pattern(python_or_to_char), F.lit(r"^(?:yyyy|MM|dd|HH|mm|ss|[-/:. T_])+$"))
    return F.when(F.contains(python_or_to_char, F.lit("%")), known).otherwise(fields)

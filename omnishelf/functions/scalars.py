"""Scalar helpers, all built from native column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from omnishelf.functions.keys import as_column, uni_trim

# Patterns of the export formats.
SHEET_QUOTES = '^="?|"$'
NUMBER_SUFFIX = r" \(\d+\)$"
INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def blank_to_null(value: Column | str) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(uni_trim(value), F.lit(""))


def zero_to_null(value: Column | str) -> Column:
    """Apps write 0 for 'not rated'."""
    return F.nullif(as_column(value), F.lit(0.0))


def first_nonblank(*values: Column | str) -> Column:
    return F.coalesce(*[F.nullif(as_column(v).cast("string"), F.lit("")) for v in values])


def _guarded(text: Column, pattern: str, kind: str) -> Column:
    """A failing try_cast from text to a number costs an exception inside Spark, and exports are
    full of blanks. The pattern lets only parsable text through; overflow still gives NULL."""
    return F.when(text.rlike(pattern), text.try_cast(kind))


def safe_long(value: Column | str) -> Column:
    return _guarded(as_column(value), INTEGER_TEXT, "bigint")


def safe_double(value: Column | str) -> Column:
    return _guarded(as_column(value), NUMBER_TEXT, "double")


def safe_date(value: Column | str) -> Column:
    """Full dates only: Spark alone would also read '2024' as 1 January."""
    text = uni_trim(as_column(value).cast("string"))
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date"))


def safe_timestamp(value: Column | str) -> Column:
    return as_column(value).try_cast("timestamp")


def whole_number(value: Column | str) -> Column:
    """'4' and '4.0' give 4, '3.5' and text give NULL."""
    number = safe_double(uni_trim(value))
    whole = number.try_cast("bigint")
    return F.when(whole.cast("double") == number, whole)


def strip_sheet_quotes(value: Column | str) -> Column:
    """Undo the ="..." wrapper that keeps spreadsheets from reading an ISBN as a number."""
    return F.regexp_replace(as_column(value), SHEET_QUOTES, "")


def strip_number_suffix(value: Column | str) -> Column:
    """'Name (2)' is the second artist called 'Name' in a release catalogue."""
    return F.regexp_replace(as_column(value), NUMBER_SUFFIX, "")


def split_csv(value: Column | str) -> Column:
    return F.split(as_column(value), "[,]")


def split_json(value: Column | str) -> Column:
    """JSON array text as an array of its scalars as text; NULL when it is not an array. Nested
    objects and arrays are no scalars and are left out."""
    return F.filter(
        F.from_json(as_column(value), "array<string>"), lambda x: ~F.coalesce(x.rlike(r"^\s*[\[{]"), F.lit(False))
    )


def first_token(value: Column | str, separator: str = ",") -> Column:
    return F.get(F.split(as_column(value), f"[{separator}]"), F.lit(0))


def json_first(value: Column | str) -> Column:
    return F.get_json_object(as_column(value), "$[0]")


def has_text(value: Column | str, *needles: str) -> Column:
    """True when the lower-cased text contains one of the needles; NULL for NULL text."""
    text = F.lower(as_column(value))
    found = text.contains(needles[0])
    for needle in needles[1:]:
        found = found | text.contains(needle)
    return found


def label_from_flags(flags: dict[str, Column], separator: str = "_and_") -> Column:
    """'a_and_b' from the names whose flag is true, in the given order."""
    return F.concat_ws(separator, *[F.when(flag, F.lit(name)) for name, flag in flags.items()])

"""Match keys and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property. The one-argument trim of Spark
# strips U+0020 only; titles copied from web pages carry tabs and no-break spaces.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# How a NULL field and the field boundary look inside a surrogate key. Ids made by
# earlier warehouse runs stay valid only while both keep this form.
NULL_FIELD = "_dbt_utils_surrogate_key_null_"
FIELD_SEPARATOR = "-"
SURROGATE_KEY = "^[0-9a-f]{32}\\z"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def uni_trim(value: Column | str) -> Column:
    """Strip every kind of Unicode white space from both ends."""
    return F.trim(as_column(value), F.lit(WHITE_SPACE))


def norm_key(value: Column | str) -> Column:
    """The form in which titles and names are compared across sources."""
    return F.lower(uni_trim(value))


def key_text(*values: Column | str) -> Column:
    """The text whose digest is the surrogate key of the fields."""
    fields = [F.coalesce(as_column(v).cast("string"), F.lit(NULL_FIELD)) for v in values]
    return F.concat_ws(FIELD_SEPARATOR, *fields)


def surrogate_key(*values: Column | str) -> Column:
    """Hex MD5 over the fields in order; NULL fields count, so every row gets a key."""
    return F.md5(key_text(*values))


def packed_id(value: Column | str) -> Column:
    """An id as bytes, for columns that many rows take through a shuffle. A surrogate key takes half
    its text, other ids stay as they are behind them; either kind keeps its order."""
    text = as_column(value)
    digest = F.concat(F.lit(bytearray([0])), F.unhex(text))
    other = F.concat(F.lit(bytearray([1])), text.cast("binary"))
    return F.when(text.rlike(SURROGATE_KEY), digest).otherwise(other)


def unpacked_id(value: Column | str) -> Column:
    """The id that ``packed_id`` packed."""
    packed = as_column(value)
    kind, rest = F.substring(packed, 1, 1), F.substring(packed, 2, 2**31 - 1)
    return F.when(kind == F.lit(bytearray([0])), F.lower(F.hex(rest))).otherwise(rest.cast("string"))

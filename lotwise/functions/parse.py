"""Text and number parsing (column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
NUMBER_JUNK = r"[^0-9.]"
TRANSMISSION_SUFFIX = (
    r"(?i)\s*\d?-?\s*(speed|spd)?\s*(a/t|m/t|automatic|manual|cvt|auto)\.?$"
)
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# --- end of fixed values ----------------------------------------------------

# Every white-space character of Unicode, and the ASCII separators.
WHITE_SPACE = "".join(map(chr, (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
PRINTED = (0x21, 0x7E)  # ASCII characters that are printed, without the space
# What a transmission suffix can begin with; looked at first, so that other places of a text cost little.
_SUFFIX_START = r"(?i)(?=[\s\dacms-])"
_PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of any kind (``trim`` knows only spaces)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def strip_column(c: Column) -> Column:
    """As :func:`strip`, for a plain column (it is referred to several times).

    A text that begins and ends with printed ASCII is left as it is. ``btrim`` searches its list for every character
    it looks at and lists all characters of the text, which takes three times as long.
    """
    ends = [F.ascii(c), F.ascii(F.substring(c, -1, 1))]
    bare = ends[0].between(*PRINTED) & ends[1].between(*PRINTED)
    return F.when(bare, c).otherwise(strip(c))


def norm_column(c: Column) -> Column:
    """As :func:`norm_text`, for a plain column."""
    return F.lower(strip_column(c.cast("string")))


def norm_text(c: Column) -> Column:
    return F.lower(strip(c.cast("string")))


def key_text(c: Column) -> Column:
    """Lookup-key form of a text column: normalised, missing becomes the empty string."""
    return F.coalesce(norm_column(c), F.lit(""))


def finite(c: Column) -> Column:
    """NULL in place of NaN and the infinities."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def dirty_number(c: Column) -> Column:
    """Number with ``$``, commas, units and signs dropped; unparsable becomes NULL."""
    return F.regexp_replace(c.cast("string"), NUMBER_JUNK, "").try_cast("double")


def plain_number(c: Column) -> Column:
    """Strictly numeric text as double; anything else becomes NULL."""
    return stripped_number(strip(c.cast("string")))


def stripped_number(text: Column) -> Column:
    """As :func:`plain_number`, of a text without white space around it."""
    return F.when(text.rlike(_PLAIN_NUMBER), finite(text.try_cast("double")))


def strip_transmission(c: Column) -> Column:
    return strip(F.regexp_replace(c.cast("string"), _SUFFIX_START + TRANSMISSION_SUFFIX, ""))


def null_if_token(c: Column) -> Column:
    """NULL for the texts a CSV reader of the source data treats as missing."""
    return F.when(~c.isin(NULL_TOKENS), c)


def or_unknown(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown"))

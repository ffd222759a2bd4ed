"""Cleaning of single fields.

Blanks inside a field are what Spark's regex engine calls \\s, the ASCII ones: no-break spaces
stay. `strip` cuts the blanks of any script off the ends.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxlake.fixed_values import LINK, TRUE_SPELLINGS

UNKNOWN = "unknown"
ANY_BLANK = r"[\t-\r\x1c-\x1f\x85\p{Z}]+"


def squeeze(text: Column) -> Column:
    """Null becomes '', every run of blanks one space, no blanks at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{ANY_BLANK}|{ANY_BLANK}$", "")


def blank_to(text: Column, default: str | None = None) -> Column:
    """Squeezed text; blank or null text becomes the default (null unless given)."""
    return F.coalesce(F.nullif(squeeze(text), F.lit("")), F.lit(default))


def normalize_text(text: Column) -> Column:
    """Lower case, links removed, blanks squeezed."""
    without_links = F.regexp_replace(
        F.lower(F.coalesce(text, F.lit(""))), LINK, " ")
    return squeeze(without_links)


def non_negative(number: Column) -> Column:
    """Null and negative counts become 0."""
    return F.when(number >= 0, number).otherwise(F.lit(0))


def not_before(moment: Column, earliest: Column) -> Column:
    """The moment, but never earlier than `earliest`; a null moment becomes `earliest`."""
    return F.greatest(moment, earliest)


def delay_seconds(later: Column, earlier: Column) -> Column:
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def is_blank(text: Column) -> Column:
    return squeeze(text) == ""


def parse_bool(value: Column) -> Column:
    """Truth of a textual flag; anything but a known spelling of true is false."""
    return F.coalesce(
        F.lower(strip(value)).isin(*TRUE_SPELLINGS), F.lit(False))


def number_is_true(value: Column) -> Column:
    """Truth of a numeric flag: null and zero are false."""
    return F.coalesce(value != 0, F.lit(False))


def ratio(part: Column, whole: Column, digits: int) -> Column:
    """part / whole rounded half up; 0 where the whole is 0."""
    return F.round(F.when(whole > 0, part / whole).otherwise(F.lit(0.0)), digits)

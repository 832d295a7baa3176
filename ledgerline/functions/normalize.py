"""Column to column: locale numbers, placeholders, padding, canonical text, typed casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def empty_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def locale_decimal(c: Column) -> Column:
    """`1.234,56` as `1234.56`: every dot goes, the first comma becomes the dot."""
    return F.regexp_replace(F.regexp_replace(c, "[.]", ""), "^([^,]*),", "$1.")


def negative_to_null(c: Column) -> Column:
    return F.when(~c.startswith("-"), c)


def placeholder_date_to_null(c: Column) -> Column:
    return F.when(~c.isin("0", "00000000"), c)


def pad_code(c: Column, width: int) -> Column:
    """Zeros in front of shorter values, after a sign if there is one; longer values stay."""
    sign, digits = F.regexp_extract(c, "^([+-]?)", 1), F.regexp_replace(c, "^[+-]", "")
    padded = F.concat(sign, F.lpad(digits, F.lit(width) - F.length(sign), "0"))
    return F.when(F.length(c) < width, padded).otherwise(c)


def pad_exact(c: Column, digits: int, width: int) -> Column:
    """Zeros in front of values of exactly so many digits; others stay."""
    return F.when(c.rlike(f"^[0-9]{{{digits}}}\\z"), F.lpad(c, width, "0")).otherwise(c)


def backfill(c: Column, value: str) -> Column:
    return F.coalesce(c, F.lit(value))


def strip_nul(c: Column) -> Column:
    """Without NUL characters; texts that have none are passed on as they are."""
    return F.replace(c, F.lit("\u0000"), F.lit(""))


def composed(c: Column) -> Column:
    """A text in Unicode's composed form, NFC.

    Spark ships the library that does it (ICU, for collations) but no function, so it is
    called by name.  Texts without a character from U+0300 on are composed as they are.
    """
    made = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False))
    return F.when(c.rlike("[^\u0000-\u02ff]"), made).otherwise(c)


def canonical_text(c: Column) -> Column:
    """Composed (NFC), outer white space cut, inner runs of it as one space, lower case; null as empty."""
    return F.lower(F.trim(F.regexp_replace(composed(F.coalesce(c, F.lit(""))), "(?U)[\\s\\x1c-\\x1f]+", " ")))


def composite_key(*columns: Column) -> Column:
    """Concatenation that is null where a part is."""
    return F.concat(*columns)


def to_date_or_null(c: Column) -> Column:
    """yyyymmdd of exactly eight digits and a day that exists; else null.

    A cast of yyyy-mm-dd takes a fraction of the time of a formatter.
    """
    dashed = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    return F.when(c.rlike(r"^[0-9]{8}\z"), dashed.try_cast("date"))


def date_in_range(c: Column, as_of: str, first: str = "1900-01-01") -> Column:
    return F.when(c.between(F.lit(first).cast("date"), F.lit(as_of).cast("date")), c)


def to_double_or_null(c: Column) -> Column:
    return c.try_cast("double")


def to_int_or_null(c: Column) -> Column:
    return c.try_cast("int")

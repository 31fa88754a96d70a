"""Column expressions that normalise text, dates and numbers. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendspark.config import EID_PATTERN

_BLANKS = " \t\n\r\x0b\x0c"
_FLOAT_TEXT = r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(c, F.lit(_BLANKS))


def element_text(c: Column) -> Column:
    """Text of an XML element: absent or empty is NULL, anything else is trimmed."""
    return strip(F.nullif(c, F.lit("")))


def first_filled(*cs: Column) -> Column:
    """The first value that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])


def normalise_eid(c: Column) -> Column:
    return F.nullif(F.upper(strip(c)), F.lit(""))


def valid_eid(c: Column) -> Column:
    """True only for a well-formed Emirates ID; NULL is not valid."""
    return F.coalesce(c.rlike(EID_PATTERN), F.lit(False))


def compact_date_to_iso(c: Column) -> Column:
    """`DDMMYYYY` as an ISO date; whatever is not such a date passes through unchanged."""
    parsed = F.date_format(F.try_to_date(c, "ddMMyyyy"), "yyyy-MM-dd")
    return F.when(c.rlike("^[0-9]{8}$"), F.coalesce(parsed, c)).otherwise(c)


def birth_date_to_iso(c: Column) -> Column:
    """As `compact_date_to_iso`, with a missing value as the empty string."""
    return F.coalesce(compact_date_to_iso(c), F.lit(""))


def iso_date(c: Column) -> Column:
    """DATE from ISO text (extended, compact, or with a time part); NULL if it is not one."""
    extended = c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:?[0-9]{2}.*)?$")
    return F.when(extended, F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")).when(
        c.rlike("^[0-9]{8}$"), F.try_to_date(c, "yyyyMMdd")
    )


def float_or_zero(c: Column) -> Column:
    """DOUBLE from text; absent or malformed is 0."""
    return F.when(c.rlike(_FLOAT_TEXT), F.coalesce(c.try_cast("double"), F.lit(0.0))).otherwise(F.lit(0.0))


def int_or_null(c: Column) -> Column:
    """INT from text; absent, malformed or fractional is NULL."""
    return c.try_cast("int")


def compare_form(field: str, c: Column) -> Column:
    """The form in which two sources' values of one field are compared."""
    if field == "full_name":
        return F.upper(strip(c))
    if field == "email":
        return F.lower(strip(c))
    return strip(c)


def pii_token(c: Column) -> Column:
    """Deterministic token of a personal value; NULL stays NULL."""
    return F.concat(F.lit("tok_"), F.substring(F.sha2(F.lower(strip(c)), 256), 1, 16))


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Completed days from `earlier` to `later`, rounded down, also below zero."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    day = F.lit(86_400_000_000)
    return ((micros - F.pmod(micros, day)) / day).cast("int")


def whole_seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds from `earlier` to `later`, rounded toward zero."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    second = F.lit(1_000_000)
    return ((micros - micros % second) / second).cast("bigint")


def iso_timestamp(c: Column) -> Column:
    """ISO text of a timestamp with microseconds and UTC offset, independent of the session zone."""
    micros = F.unix_micros(c)
    utc = F.timestamp_micros(micros)
    return F.date_format(F.to_utc_timestamp(utc, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")

"""Scalar parsing of raw text columns (D1, D2, N1), all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: the instant pattern of the raw files, and the US number shape
# (optional minus, digits with grouping commas, optional fraction, optional exponent).
INSTANT_PATTERN = "yyyy-MM-dd'T'HH:mm:ssX"
INSTANT_PATTERN_COLON_OFFSET = "yyyy-MM-dd'T'HH:mm:ssXXX"
LENIENT_INSTANT = r"^(\d+)-(\d+)-(\d+)T(\d+):(\d+):(\d+)(Z|[+-]\d\d)"
US_NUMBER_PREFIX = r"^-?[0-9,]*(\.[0-9]*)?(E-?[0-9]+)?"


def _fail_or_null(raw: Column, parsed: Column, on_error: str, what: str) -> Column:
    if on_error == "null":
        return parsed
    if on_error != "fail":
        raise ValueError("on_error must be 'fail' or 'null'")
    return (F.when(raw.isNotNull() & parsed.isNull(),
                   F.raise_error(F.concat(F.lit(f"unparsable {what}: "), raw)))
            .otherwise(parsed))


def _lenient_instant(raw: Column) -> Column:
    """Fields may run over (month 13, 25 hours); what follows the offset's hours is ignored."""
    part = lambda k: F.regexp_extract(raw, LENIENT_INSTANT, k)
    number = lambda k: part(k).try_cast("bigint")
    day = F.add_months(F.make_date(number(1).cast("int"), F.lit(1), F.lit(1)), (number(2) - 1).cast("int"))
    offset = F.when(part(7) == "Z", F.lit(0)).otherwise(number(7) * 3600)
    seconds = (F.unix_date(day) + number(3) - 1) * 86400 + number(4) * 3600 + number(5) * 60 + number(6) - offset
    return F.when(raw.rlike(LENIENT_INSTANT), F.timestamp_seconds(seconds))


def parse_instant(raw: Column, on_error: str = "fail", lenient: bool = False) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ss`` plus an ISO offset (``Z``, ``-05``, ``-05:00``).

    The date pattern argument of the reference is ignored there too. A non-null
    value that does not parse fails the task (``on_error="fail"``, like the
    reference's parser exception) or becomes NULL (``"null"``). ``lenient`` also takes what
    the JDK's own parser takes: fields that run over into the next unit, and any
    text after the hours of the offset (``-05:30`` is then read as ``-05``).
    """
    parsed = _lenient_instant(raw) if lenient else F.coalesce(F.try_to_timestamp(raw, F.lit(INSTANT_PATTERN)),
                        F.try_to_timestamp(raw, F.lit(INSTANT_PATTERN_COLON_OFFSET)))
    return _fail_or_null(raw, parsed, on_error, "instant")


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since the epoch."""
    return F.unix_millis(ts)


def parse_us_number(raw: Column, on_error: str = "fail") -> Column:
    """US-locale number: grouping commas allowed, trailing text ignored.

    ``"1,234.5"`` -> 1234.5, ``"12abc"`` -> 12.0, ``"NaN"`` -> NaN. Text with no
    leading number fails (``on_error="fail"``) or gives NULL.
    """
    nan = F.trim(raw) == F.lit("NaN")
    head = F.regexp_replace(F.regexp_extract(raw, US_NUMBER_PREFIX, 0), ",", "")
    has_digit = head.rlike("[0-9]")
    parsed = (F.when(nan, F.lit(float("nan")))
              .when(has_digit, head.try_cast("double")))
    return _fail_or_null(raw, parsed, on_error, "number")

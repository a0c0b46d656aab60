"""Parsing helpers shared by the cleaners."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The strings a default pandas CSV read turns into "missing".
# Spark's CSV reader only maps the empty string, so the cleaners map these too.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Fixed value: the incident timestamp layout (month/day/year 12-hour clock AM/PM).
# Single-letter fields accept one or two digits, zero-padded or not, as a
# strptime-style parse does for every numeric field but the year.
INCIDENT_TS_FORMAT = "M/d/yyyy h:m:s a"

# A plain decimal literal (optionally signed, optional exponent). Guarding the
# cast with it keeps Java-style suffixes ("5f", "1d") and "NaN"/"Infinity" out:
# those are missing values for the reference's numeric coercion.
_NUMERIC_LITERAL = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"
_NUMBER_TEXT = rf"^ *{_NUMERIC_LITERAL} *$|^(?i)[+-]?inf(inity)?$"
_INTEGER_TEXT = r"^ *[+-]?[0-9]+ *$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_missing(c: Column | str) -> Column:
    """NULL for the missing-value tokens of a default pandas CSV read, else the string."""
    c = _col(c)
    return F.when(c.isin(MISSING_TOKENS), F.lit(None).cast("string")).otherwise(c)


def parse_event_ts(c: Column | str, fmt: str = INCIDENT_TS_FORMAT) -> Column:
    """String -> timestamp; anything that does not match ``fmt`` becomes NULL (never an error).

    As in a strptime-style parse, a space in the layout matches any run of
    whitespace: runs are collapsed first (leading or trailing whitespace still
    fails). Missing-value tokens cannot match the layout, so they are NULL too.
    A failed parse costs a caught exception inside the parser; when the layout
    ends with the AM/PM marker, text that does not end in AM/PM is answered NULL
    without trying. The input is referenced once, so an expensive producing
    expression is not repeated per check.
    """
    text = F.regexp_replace(_col(c), r"\s+", " ")
    parsed = F.try_to_timestamp(text, F.lit(fmt))
    if fmt.endswith(" a"):
        return F.when(F.upper(F.substring(text, -2, 2)).isin("AM", "PM"), parsed)
    return parsed


def event_year(ts: Column | str) -> Column:
    """Calendar year of a parsed timestamp as INT (NULL stays NULL)."""
    return F.year(_col(ts))


def to_number(c: Column | str) -> Column:
    """String -> DOUBLE like a coercing pandas parse; non-numeric -> NULL.

    Plain decimal literals may carry surrounding spaces; ``inf``/``infinity``
    (any case, optional sign, no spaces) are infinities; ``1,234``, ``5f``,
    ``1d``, ``nan`` and the missing-value tokens are NULL. One pattern decides,
    then the cast (which reads the infinities itself) converts.
    """
    c = _col(c)
    return F.when(c.rlike(_NUMBER_TEXT), F.trim(c).try_cast("double"))


def to_integer(c: Column | str, type_name: str = "bigint") -> Column:
    """String -> integer; integral decimals such as ``12.0`` are accepted, the rest is NULL."""
    c = _col(c)
    n = to_number(c)
    return (F.when(c.rlike(_INTEGER_TEXT), F.trim(c).try_cast(type_name))
             .when(n == F.floor(n), n.try_cast(type_name)))


def round_half_even_long(c: Column | str) -> Column:
    """Round to an integer with ties to even (2.5 -> 2, 3.5 -> 4); NULL, infinite or
    out-of-range values are NULL (a coercing integer conversion would raise)."""
    return F.bround(_col(c), 0).try_cast("bigint")

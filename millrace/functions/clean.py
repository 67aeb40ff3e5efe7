"""Field cleaning as pure ``Column`` expressions.

Every function takes a string column and returns a typed column; whatever does not parse becomes
NULL, never an error, so the expressions are safe under ANSI mode. Nothing here leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Unicode-aware strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

FLOAT_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
PLAIN_FLOAT_RE = r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$"
INT_RE = r"^[+-]?[0-9]+$"

# Dates outside the range of a 64-bit nanosecond clock, 1677-09-22 to 2262-04-11,
# count as unparseable.
DATE_RANGE_RE = (
    "^(1677:(0?9:(2[2-9]|30)|1[0-2]:[0-9]+)|16(7[89]|[89][0-9]):.*|1[7-9][0-9]{2}:.*"
    "|2[01][0-9]{2}:.*|22([0-5][0-9]|6[01]):.*|2262:(0?[1-3]:[0-9]+|0?4:(0?[1-9]|1[01])))$"
)

NAMED_RANGE_RE = (
    "^(16(7[89]|[89][0-9])|1[7-9][0-9]{2}|2[01][0-9]{2}|22([0-5][0-9]|6[01])):[A-Za-z]{3}:[0-9]+$"
)

MONTH_RE = (
    "(?i)(?:^|[^a-z])(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    "|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)(?:[^a-z]|$)"
)
MON = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"
TIME_RE = r"[ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?( ?[AaPp][Mm])?Z?$"

# Accepted shapes and how each rewrites to year:month:day. The colon keeps a rewritten value out of
# the shapes that follow. Two-part ambiguity is resolved month first; a first part above 12 can only
# be a day.
DATE_SHAPES = [
    (r"^([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})$", "$1:$2:$3"),
    (r"^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1:$2:$3"),
    (r"^(0?[1-9]|1[0-2])[-/.]([0-9]{1,2})[-/.]([0-9]{4}|[0-9]{2})$", "$3:$1:$2"),
    (r"^([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]([0-9]{4}|[0-9]{2})$", "$3:$2:$1"),
]
NAMED_DATE_SHAPES = [
    (rf"(?i)^([0-9]{{1,2}})[-/. ]{MON}[-/. ,]+([0-9]{{4}}|[0-9]{{2}})$", "$3:$2:$1"),
    (rf"(?i)^([0-9]{{4}})[-/. ]{MON}[-/. ]([0-9]{{1,2}})$", "$1:$2:$3"),
    (rf"(?i)^{MON}[ -]([0-9]{{1,2}})[ ,-]+([0-9]{{4}})$", "$3:$1:$2"),
]
DMY_SHAPES = [(r"^([0-9]{1,2})-([0-9]{1,2})-([0-9]{4}|[0-9]{2})$", "$3:$2:$1")]
NAMED_DMY_SHAPES = [(rf"(?i)^([0-9]{{1,2}})-{MON}-([0-9]{{4}}|[0-9]{{2}})$", "$3:$2:$1")]

# First year of the hundred that two-digit years fall into: fifty years before the run year.
CENTURY_FROM = 1976

# Fixed value: the same for day-month-year text.
DMY_CENTURY_FROM = 1951


def _strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def clean_text(c: Column) -> Column:
    """Strip; blank becomes NULL."""
    return F.nullif(_strip(c), F.lit(""))


def _rewrite(c: Column, shapes: list[tuple[str, str]], century_from: int) -> Column:
    """Text of one of the shapes as ``year:month:day`` with a four-digit year, one pass per shape."""
    for pattern, order in shapes:
        c = F.regexp_replace(c, pattern, order)
    late = "|".join(f"{y:02d}" for y in range(century_from % 100, 100))
    c = F.regexp_replace(c, f"^({late}):", f"{century_from // 100}$1:")
    return F.regexp_replace(c, "^([0-9]{2}):", f"{century_from // 100 + 1}$1:")


def _as_date(c: Column) -> Column:
    """Date of ``year:month:day``; any other text, and an impossible day, is NULL."""
    return F.translate(F.regexp_extract(c, DATE_RANGE_RE, 0), ":", "-").try_cast("date")


def _as_named_date(c: Column) -> Column:
    """Date of ``year:mon:day`` with a month name."""
    known = F.nullif(F.regexp_extract(c, NAMED_RANGE_RE, 0), F.lit(""))
    return F.try_to_timestamp(known, F.lit("y:MMM:d")).cast("date")


def _plain_iso(s: Column) -> Column:
    """Ten characters, dashes in their places, a year well inside the range: told without a pattern."""
    dashes = (F.substring(s, 5, 1) == "-") & (F.substring(s, 8, 1) == "-")
    return (F.length(s) == 10) & dashes & (s >= "1700") & (s < "2200")


def clean_date(c: Column, century_from: int = CENTURY_FROM) -> Column:
    """Date from any of the accepted shapes, time of day ignored.

    Shapes are told apart by pattern and the value is parsed once; ISO text takes a short path, that without blanks
    around it one without a strip.
    """
    s = _strip(c)
    dated = F.regexp_replace(s, TIME_RE, "")
    return (
        F.when(_plain_iso(c) & F.substring(c, 10, 1).between("0", "9"), c.try_cast("date"))
        .when(_plain_iso(s), s.try_cast("date"))
        .when(
            dated.rlike(MONTH_RE),
            _as_named_date(_rewrite(dated, NAMED_DATE_SHAPES, century_from)),
        )
        .otherwise(_as_date(_rewrite(dated, DATE_SHAPES, century_from)))
    )


def clean_date_dmy(c: Column) -> Column:
    """Dash-separated text is read strictly as day-month-year; other text goes to ``clean_date``.

    Four-digit-first text such as ``2025-01-05`` does not fit the rule and becomes NULL.
    """
    s = _strip(c)
    dashed = F.when(
        s.rlike(MONTH_RE), _as_named_date(_rewrite(s, NAMED_DMY_SHAPES, DMY_CENTURY_FROM))
    ).otherwise(_as_date(_rewrite(s, DMY_SHAPES, DMY_CENTURY_FROM)))
    return F.when(s.contains("-"), dashed).otherwise(clean_date(s))


def clean_numeric(c: Column) -> Column:
    """Double after dropping thousands commas. ``nan``, ``inf``, ``1_000`` and ``1d`` are NULL."""
    s = _strip(F.replace(c, F.lit(","), F.lit("")))
    return F.when(s.rlike(FLOAT_RE), s.try_cast("double"))


def clean_numeric_lossy(c: Column) -> Column:
    """Double after keeping only digits, dots and dashes: ``1e5`` is 15 and ``(12)`` is 12."""
    s = F.regexp_replace(c, r"[^0-9.\-]", "")
    return F.when(s.rlike(PLAIN_FLOAT_RE), s.try_cast("double"))


def clean_numeric_percent(c: Column) -> Column:
    """Double after dropping commas and percent signs; text without a dot must be an integer."""
    s = _strip(F.regexp_replace(c, "[,%]", ""))
    ok = F.when(s.contains("."), s.rlike(FLOAT_RE)).otherwise(s.rlike(INT_RE))
    return F.when(ok, s.try_cast("double"))


def clean_integer(c: Column) -> Column:
    """Long after dropping commas; ``12.0`` is NULL."""
    s = _strip(F.replace(c, F.lit(","), F.lit("")))
    return F.when(s.rlike(INT_RE), s.try_cast("bigint"))


def clean_flag(c: Column) -> Column:
    """``Y`` or ``N``; anything else, NULL included, is ``N``."""
    s = F.upper(_strip(c))
    return F.when(s.isin("Y", "N"), s).otherwise(F.lit("N"))


CLEANERS = {
    "string": clean_text,
    "date": clean_date,
    "date_dmy": clean_date_dmy,
    "double": clean_numeric,
    "double_lossy": clean_numeric_lossy,
    "double_percent": clean_numeric_percent,
    "bigint": clean_integer,
    "flag": clean_flag,
}

STORED_TYPES = {
    "string": "string",
    "date": "date",
    "date_dmy": "date",
    "double": "double",
    "double_lossy": "double",
    "double_percent": "double",
    "bigint": "bigint",
    "flag": "string",
}

"""Contact numbers and the text of a due-date alert."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The alert text and its length limit.
ALERT_TEXT = (
    "Dear %s, your SIP of ₹%s for %s will be processed on %s. "
    "Ensure sufficient funds in your bank account. - %s"
)
ALERT_LIMIT = 1000


def normalize_mobile(c: Column) -> Column:
    """Digits with country code 91, or NULL.

    The 13-digit rule keeps the last 12 digits of a number that starts with 0091.
    """
    digits = F.regexp_replace(c, "[^0-9]", "")
    size = F.length(digits)
    return (
        F.when(size == 10, F.concat(F.lit("91"), digits))
        .when((size == 12) & digits.startswith("91"), digits)
        .when((size == 13) & digits.startswith("0091"), F.substring(digits, 2, 12))
    )


def format_amount(c: Column) -> Column:
    """Thousands separators around the shortest decimal text of a double: 5000.0 -> ``5,000.0``.

    From 1e16 on in powers of ten, as in ``1.5e+16``; no amount raises.
    """
    exact = F.abs(c).try_cast("decimal(38,20)")
    whole = F.floor(exact).try_cast("bigint")
    fraction = F.rtrim(F.substring_index(exact.cast("string"), ".", -1), F.lit("0"))
    sign = F.when(c < 0, "-").otherwise("")
    plain = F.concat(
        sign,
        F.format_number(whole, 0),
        F.lit("."),
        F.when(fraction == "", "0").otherwise(fraction),
    )
    powers = F.regexp_replace(c.cast("string"), r"(\.0)?E", "e+")
    return (
        F.when(F.isnan(c), "nan")
        .when(F.abs(c) == float("inf"), F.concat(sign, F.lit("inf")))
        .when(F.abs(c) >= 1e16, powers)
        .otherwise(plain)
    )


def due_date_text(day: Column, target_date: Column) -> Column:
    """Unpadded day/month/year; the day is the plan's own, the rest comes from the target date."""
    return F.concat_ws(
        "/",
        day.cast("string"),
        F.month(target_date).cast("string"),
        F.year(target_date).cast("string"),
    )


def alert_message(
    name: Column, amount: Column, scheme: Column, due: Column, signature: str
) -> Column:
    """Rendered alert text, cut to the gateway limit; missing parts get their defaults.

    A missing or zero amount prints as a bare ``0``.
    """
    known = amount.isNotNull() & (amount != 0)
    text = F.format_string(
        ALERT_TEXT,
        F.coalesce(F.nullif(name, F.lit("")), F.lit("Investor")),
        F.when(known, format_amount(amount)).otherwise("0"),
        F.coalesce(scheme, F.lit("")),
        F.coalesce(due, F.lit("")),
        F.lit(signature),
    )
    return F.substring(text, 1, ALERT_LIMIT)

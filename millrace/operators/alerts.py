"""Plans due on a day and the alerts for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.contact import alert_message, due_date_text, normalize_mobile
from millrace.operators.skew import spread_join


def due_plans(
    plans: DataFrame,
    contacts: DataFrame,
    target_date: Column,
    row_id: list[str],
    key: str = "folio_no",
) -> DataFrame:
    """Active plans whose day of month is that of the target date and whose contact has a number.

    Active means started, not ended, not ceased, not paused on the target date. There is no roll at
    the month's end: a plan on day 31 is not due in a month of 30. Filters run before the join, and
    a folio with very many plans is split.
    """
    active = (
        (F.col("from_date") <= target_date)
        & (F.col("to_date").isNull() | (F.col("to_date") >= target_date))
        & (F.col("cease_date").isNull() | (F.col("cease_date") > target_date))
        & (
            F.col("pause_from").isNull()
            | (F.col("pause_from") > target_date)
            | (F.col("pause_to_d") < target_date)
        )
    )
    due = plans.where((F.col("period_day") == F.dayofmonth(target_date)) & active)
    reachable = contacts.where(F.col("mobile").isNotNull())
    return spread_join(due, reachable, [key], row_id, "inner")


def render_alerts(
    due: DataFrame, target_date: Column, signature: str, test_number: str | None = None
) -> DataFrame:
    """Due plans with normalised number, status, reason and text.

    ``test_number`` replaces every recipient. A number that does not normalise fails the alert.
    """
    number = normalize_mobile(F.col("mobile"))
    valid = number.isNotNull()
    text = alert_message(
        F.col("inv_name"),
        F.col("sip_amount"),
        F.col("scheme"),
        due_date_text(F.col("sip_date"), target_date),
        signature,
    )
    recipient = number if test_number is None else F.lit(test_number)
    return due.select(
        "*",
        F.when(valid, recipient).alias("recipient"),
        F.when(valid, "ready").otherwise("failed").alias("status"),
        F.when(~valid, "invalid_mobile").alias("reason"),
        F.when(valid, text).alias("message"),
    )


def alert_summary(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.count_if(F.col("status") == "ready").alias("success_count"),
        F.count_if(F.col("status") == "failed").alias("failure_count"),
        F.count(F.lit(1)).alias("total_investors"),
    )

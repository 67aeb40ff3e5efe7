"""Due-date alerts over the stored plan and investor tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.alerts import due_plans, render_alerts
from millrace.operators.dedup import keep_last
from millrace.plans.feed import FeedStore
from millrace.plans.registry import FEEDS

PLAN_ID = ["folio_no", "auto_trno", "from_date"]


def upcoming(store: FeedStore, run_date: str, days_before: int = 1) -> DataFrame:
    """Plans due ``days_before`` days after the run date, with the contact of their folio.

    The contact is that of the folio's latest report row with a number. The plan table carries no
    security id.
    """
    target = F.date_add(F.lit(run_date).cast("date"), days_before)
    plans = (
        store.table(FEEDS["wbr49"])
        .read()
        .select(
            *PLAN_ID,
            "pan",
            "inv_name",
            "scheme",
            F.lit(None).cast("string").alias("isin"),
            F.coalesce("auto_amoun", F.lit(0.0)).alias("sip_amount"),
            F.col("period_day").cast("int").alias("sip_date"),
            "period_day",
            "to_date",
            "cease_date",
            "pause_from",
            "pause_to_d",
        )
    )
    investors = store.table(FEEDS["wbr9"]).read().dropna(subset=["foliochk"])
    narrow = investors.select("foliochk", "rep_date", "product", "sch_name", "mobile_no", "email")
    latest = keep_last(
        narrow.where(F.col("mobile_no").isNotNull()), ["foliochk"], ["rep_date", "product", "sch_name"]
    )
    contacts = latest.select(
        F.col("foliochk").alias("folio_no"), F.col("mobile_no").alias("mobile"), "email"
    )
    return due_plans(plans, contacts, target, PLAN_ID).select(
        "pan", "inv_name", "folio_no", "scheme", "isin", "sip_amount", "sip_date", "mobile", "email"
    )


def reminders(
    store: FeedStore,
    run_date: str,
    signature: str,
    days_before: int = 1,
    test_number: str | None = None,
) -> DataFrame:
    """Alert rows with recipient, status, reason and text."""
    target = F.date_add(F.lit(run_date).cast("date"), days_before)
    return render_alerts(upcoming(store, run_date, days_before), target, signature, test_number)

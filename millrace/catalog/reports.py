"""Run reports with events as file rows, and alerts with orders as plans and customers as contacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import shapes as S
from millrace.catalog.base import query, table
from millrace.operators import alerts, report

# An event is a row of the file (event_type, day); its value decides what became of the row.
ACTION = """CASE WHEN value < 5 THEN 'insert' WHEN value < 10 THEN 'update' WHEN value < 15 THEN 'unchanged'
  WHEN value < 20 THEN 'duplicate' WHEN value < 25 THEN 'reject' ELSE 'insert' END"""


@query(
    "file_summary",
    f"""SELECT event_type AS feed, file, count(*) AS total_rows,
      count(*) FILTER (WHERE action = 'insert') AS inserted, count(*) FILTER (WHERE action = 'update') AS updated,
      count(*) FILTER (WHERE action = 'unchanged') AS unchanged,
      count(*) FILTER (WHERE action = 'duplicate') AS duplicates,
      count(*) FILTER (WHERE action = 'reject') AS failed
    FROM (SELECT event_type, CAST(ts AS DATE) AS file, {ACTION} AS action FROM events) GROUP BY 1, 2""",
)
def file_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_type AS feed", "CAST(ts AS DATE) AS file", f"{ACTION} AS action"
    )
    return report.file_summary(rows, ["feed", "file"])


# Files of the job: one per event type, day and user. A file fails when it holds an outlier.
FILES_SQL = """SELECT CAST(ts AS DATE) AS run_date, event_type AS feed,
    event_type || '-' || CAST(user_id AS VARCHAR) || '.csv' AS file, count(*) AS records,
    CASE WHEN max(value) > 60 THEN 'value out of range' END AS error
  FROM events GROUP BY 1, 2, 3"""


def job_files(spark, sf_dir):
    name = F.concat(F.col("event_type"), F.lit("-"), F.col("user_id").cast("string"), F.lit(".csv"))
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("ts").cast("date").alias("run_date"),
            F.col("event_type").alias("feed"),
            name.alias("file"),
        )
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.when(F.max("value") > 60, "value out of range").alias("error"),
        )
    )


@query(
    "job_summary",
    f"""SELECT run_date, CAST(sum(ok) AS BIGINT) AS success, CAST(sum(bad) AS BIGINT) AS failures,
      CAST(sum(ok + bad) AS BIGINT) AS total,
      string_agg(feed || ': ' || ok || ' ok, ' || bad || ' failed, ' || records || ' records', '; '
        ORDER BY feed || ': ' || ok || ' ok, ' || bad || ' failed, ' || records || ' records') AS details
    FROM (SELECT run_date, feed, count(*) FILTER (WHERE error IS NULL) AS ok,
      count(*) FILTER (WHERE error IS NOT NULL) AS bad, CAST(sum(records) AS BIGINT) AS records
      FROM ({FILES_SQL}) GROUP BY 1, 2) GROUP BY 1""",
)
def job_summary(spark, sf_dir):
    return report.job_summary(job_files(spark, sf_dir))


@query(
    "job_details",
    f"""SELECT run_date, feed, CASE WHEN error IS NULL THEN file || ' - ' || records || ' records -> ' || feed
      ELSE file || ' - Error: ' || error END AS line FROM ({FILES_SQL})""",
)
def job_details(spark, sf_dir):
    line = report.detail_line(F.col("file"), F.col("records"), F.col("feed"), F.col("error"))
    return job_files(spark, sf_dir).select("run_date", "feed", line.alias("line"))


TARGET_DATE = "2000-03-15"
SIGNATURE = "Your adviser"
PLANS = {
    "plan_id": "o_orderkey",
    "folio_no": "CAST(o_custkey AS STRING)",
    "scheme": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END",
    "sip_amount": "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 13 = 1 THEN 0.0 ELSE o_totalprice END",
    "sip_date": "CAST(day(o_orderdate) AS INT)",
    "period_day": "CAST(day(o_orderdate) AS INT)",
    "from_date": "CAST(o_orderdate AS DATE)",
    "to_date": "CASE WHEN o_orderstatus = 'F' THEN DATE '2000-01-31' END",
    "cease_date": "CASE WHEN o_orderkey % 17 = 0 THEN DATE '1999-06-30' END",
    "pause_from": "CASE WHEN o_orderkey % 19 = 0 THEN DATE '2000-02-01' END",
    "pause_to_d": "CASE WHEN o_orderkey % 19 = 0 THEN DATE '2000-04-01' END",
}
CONTACTS = {
    "folio_no": "CAST(c_custkey AS STRING)",
    "inv_name": "CASE WHEN c_custkey % 12 = 0 THEN '' ELSE c_name END",
    "mobile": S.MOBILE_TEXT,
}
DUE_SQL = f"""SELECT p.*, c.inv_name, c.mobile FROM ({S.select_sql(PLANS, "orders")}) p
  JOIN ({S.select_sql(CONTACTS, "customer")}) c ON p.folio_no = c.folio_no
  WHERE c.mobile IS NOT NULL AND p.period_day = 15 AND p.from_date <= DATE '{TARGET_DATE}'
    AND (p.to_date IS NULL OR p.to_date >= DATE '{TARGET_DATE}')
    AND (p.cease_date IS NULL OR p.cease_date > DATE '{TARGET_DATE}')
    AND NOT (p.pause_from IS NOT NULL AND p.pause_from <= DATE '{TARGET_DATE}' AND p.pause_to_d >= DATE '{TARGET_DATE}')"""


def due(spark, sf_dir):
    target = F.date_add(F.lit("2000-03-14").cast("date"), 1)
    plans = S.shaped(spark, sf_dir, "orders", PLANS)
    contacts = S.shaped(spark, sf_dir, "customer", CONTACTS)
    return alerts.due_plans(plans, contacts, target, ["plan_id"])


def rendered(spark, sf_dir):
    target = F.lit(TARGET_DATE).cast("date")
    return alerts.render_alerts(due(spark, sf_dir), target, SIGNATURE)


@query(
    "sip_due",
    f"""SELECT plan_id, folio_no, inv_name, scheme, CAST(sip_amount AS DOUBLE) AS sip_amount,
    sip_date, mobile FROM ({DUE_SQL})""",
)
def sip_due(spark, sf_dir):
    return due(spark, sf_dir).select(
        "plan_id",
        "folio_no",
        "inv_name",
        "scheme",
        F.col("sip_amount").cast("double").alias("sip_amount"),
        "sip_date",
        "mobile",
    )


DIGITS = "regexp_replace(mobile, '[^0-9]', '', 'g')"
NUMBER_SQL = f"""CASE WHEN length({DIGITS}) = 10 THEN '91' || {DIGITS}
  WHEN length({DIGITS}) = 12 AND left({DIGITS}, 2) = '91' THEN {DIGITS}
  WHEN length({DIGITS}) = 13 AND left({DIGITS}, 4) = '0091' THEN right({DIGITS}, 12) END"""
ALERT_SQL = f"SELECT *, {NUMBER_SQL} AS number FROM ({DUE_SQL})"


@query(
    "alert_validate",
    f"""SELECT plan_id, number AS recipient, CASE WHEN number IS NULL THEN 'failed' ELSE 'ready' END AS status,
      CASE WHEN number IS NULL THEN 'invalid_mobile' END AS reason FROM ({ALERT_SQL})""",
)
def alert_validate(spark, sf_dir):
    return rendered(spark, sf_dir).select("plan_id", "recipient", "status", "reason")


CENTS = "CAST(CAST(sip_amount AS DECIMAL(18,2)) AS VARCHAR)"
AMOUNT_SQL = f"""CASE WHEN sip_amount IS NULL OR sip_amount = 0 THEN '0'
  ELSE format('{{:,}}', CAST(floor(sip_amount) AS BIGINT)) || '.' || substr(split_part({CENTS}, '.', 2), 1, 1)
    || CASE WHEN right({CENTS}, 1) = '0' THEN '' ELSE right({CENTS}, 1) END END"""


@query(
    "alert_message",
    f"""SELECT plan_id, 'Dear ' || coalesce(nullif(inv_name, ''), 'Investor') || ', your SIP of ₹' || {AMOUNT_SQL}
      || ' for ' || coalesce(scheme, '') || ' will be processed on 15/3/2000. '
      || 'Ensure sufficient funds in your bank account. - {SIGNATURE}' AS message,
      '910000000000' AS recipient FROM ({ALERT_SQL}) WHERE number IS NOT NULL""",
)
def alert_message(spark, sf_dir):
    """Rendered in test mode: one number receives everything."""
    target = F.lit(TARGET_DATE).cast("date")
    sent = alerts.render_alerts(due(spark, sf_dir), target, SIGNATURE, test_number="910000000000")
    return sent.where(F.col("status") == "ready").select("plan_id", "message", "recipient")


@query(
    "alert_summary",
    f"""SELECT count(number) AS success_count, count(*) - count(number) AS failure_count,
      count(*) AS total_investors FROM ({ALERT_SQL})""",
)
def alert_summary(spark, sf_dir):
    return alerts.alert_summary(rendered(spark, sf_dir))

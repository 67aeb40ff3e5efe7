"""The cleaned transaction feed and its target, as frames, for the merge queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import shapes as S
from millrace.operators.dedup import keep_first
from millrace.operators.schema import conform

FEED_KINDS = {
    "folio_no": "string",
    "trxnno": "string",
    "traddate": "date",
    "amount": "double",
    "remarks": "string",
    "status": "string",
}
KEYS = ["folio_no", "trxnno"]
ORDER = ["row_ord"]


def feed_rows(spark: SparkSession, sf_dir: str, day: str = "2024-02-01") -> DataFrame:
    raw = S.shaped(spark, sf_dir, "orders", S.FEED_COLUMNS)
    stamp = F.lit(day).cast("date")
    return conform(raw, FEED_KINDS, keep=("row_ord",)).select(
        "*", F.lit("day2.csv").alias("file_path"), stamp.alias("created_on"), stamp.alias("updated_on")
    )


def unique_feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(feed_rows(spark, sf_dir), KEYS, ORDER)


def target_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.shaped(spark, sf_dir, "orders", S.TARGET_COLUMNS)


# First row per key, NULL keys equal, as SQL.
UNIQUE_FEED_SQL = f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY folio_no, trxnno ORDER BY row_ord) AS rn
  FROM ({S.CLEAN_FEED_SQL})) WHERE rn = 1"""

ALL_COLUMNS = list(S.TARGET_COLUMNS)


def merge_sql(update: list[str], source: str = UNIQUE_FEED_SQL, target: str = S.TARGET_SQL) -> str:
    """Upsert of a feed into the target, stated as update, untouched and insert branches."""
    cols = ", ".join(ALL_COLUMNS)
    changed = ", ".join((f"s.{c}" if c in update else f"t.{c}") + f" AS {c}" for c in ALL_COLUMNS)
    return f"""WITH s AS ({source}), t AS ({target})
      SELECT {changed} FROM t JOIN s ON t.folio_no = s.folio_no AND t.trxnno = s.trxnno
      UNION ALL SELECT {cols} FROM t WHERE NOT EXISTS
        (SELECT 1 FROM s WHERE t.folio_no = s.folio_no AND t.trxnno = s.trxnno)
      UNION ALL SELECT {cols} FROM s WHERE NOT EXISTS
        (SELECT 1 FROM t WHERE t.folio_no = s.folio_no AND t.trxnno = s.trxnno)"""

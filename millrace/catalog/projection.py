"""Conforming tables to target schemas, and column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.catalog import shapes as S
from millrace.catalog.base import query, table
from millrace.catalog.feedrows import FEED_KINDS
from millrace.operators.profile import cardinality_profile, column_sketches, merged_profile
from millrace.operators.schema import (
    conform,
    conform_dynamic,
    dynamic_kinds,
    narrow_floats,
    rename_all,
)
from millrace.session import scratch_path


@query(
    "conform_schema",
    f"""SELECT o_orderkey AS row_ord, nullif(trim({S.FOLIO_TEXT}), '') AS folio_no,
      nullif(trim({S.TRXN_TEXT}), '') AS trxnno, CAST(o_orderdate AS DATE) AS traddate,
      CASE WHEN o_orderkey % 5 IN (0, 1) THEN NULL WHEN o_orderkey % 5 = 2
        THEN CAST('1' || CAST(o_totalprice AS VARCHAR) AS DOUBLE) ELSE o_totalprice END AS amount,
      CAST(NULL AS VARCHAR) AS remarks, CAST(NULL AS VARCHAR) AS status FROM orders""",
)
def conform_schema(spark, sf_dir):
    """Headers in another style, one under a name with an extra underscore, two absent."""
    raw = S.shaped(
        spark,
        sf_dir,
        "orders",
        {
            "row_ord": "o_orderkey",
            "`FOLIO_NO`": S.FOLIO_TEXT,
            "`Trxn_No`": S.TRXN_TEXT,
            "`TradDate`": S.ISO,
            "`AMOUNT`": S.AMOUNT_TEXT,
            "`SL_NO`": "o_orderkey",
        },
    )
    return conform(rename_all(raw), FEED_KINDS, keep=("row_ord",))


CATALOG = (
    "id bigint, folio_no string, trad_date date, amount double, tax_status double, city string, "
    "file_path string, created_at timestamp, updated_at timestamp"
)


@query(
    "conform_dynamic",
    f"""SELECT o_orderkey AS row_ord, nullif(trim({S.FOLIO_TEXT}), '') AS folio_no,
      CAST(o_orderdate AS DATE) AS trad_date,
      CASE WHEN o_orderkey % 5 IN (0, 1) THEN NULL WHEN o_orderkey % 5 = 2
        THEN CAST('1' || CAST(o_totalprice AS VARCHAR) AS DOUBLE) ELSE o_totalprice END AS amount,
      CAST(NULL AS DOUBLE) AS tax_status, CAST(NULL AS VARCHAR) AS city FROM orders""",
)
def conform_to_catalog(spark, sf_dir):
    """Columns found by containing names, typed by keyword; a text code in a tax column is lost."""
    raw = S.shaped(
        spark,
        sf_dir,
        "orders",
        {
            "row_ord": "o_orderkey",
            "old_folio_no": S.FOLIO_TEXT,
            "trad_date_1": S.ISO,
            "total_amount": S.AMOUNT_TEXT,
            "tax_status": "o_orderstatus",
        },
    )
    return conform_dynamic(raw, dynamic_kinds(StructType.fromDDL(CATALOG)), keep=("row_ord",))


@query(
    "narrow_float",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS price,
      CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS discount FROM lineitem""",
)
def narrow_float(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount"
    )
    return narrow_floats(lines).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_extendedprice").cast("double").alias("price"),
        F.col("l_discount").cast("double").alias("discount"),
    )


def profile_sql() -> str:
    one = """SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values,
      count(DISTINCT {c}) / count(*) AS ratio, count(DISTINCT {c}) / count(*) < 0.5 AS low FROM part"""
    return " UNION ALL ".join(one.format(c=c) for c in ("p_name", "p_brand", "p_type"))


@query(
    "profile_cardinality",
    f"SELECT column_name, distinct_values, ratio, CASE WHEN low THEN 'Y' ELSE 'N' END AS low FROM ({profile_sql()})",
)
def profile_cardinality(spark, sf_dir):
    profile = cardinality_profile(table(spark, sf_dir, "part"))
    return profile.withColumn("low", F.when(F.col("low"), "Y").otherwise("N"))


PROFILED = "'n' || (o_custkey % 701) AS name, o_orderstatus AS status, nullif(o_orderpriority, '5-LOW') AS priority"


def merge_profile_sql() -> str:
    one = "SELECT '{c}' AS column_name, count(*) AS n_rows, count(DISTINCT {c}) AS distinct_values, 'Y' AS same, 'Y' AS near FROM orders"
    return " UNION ALL ".join(one.format(c=c) for c in ("name", "status", "priority")).replace("FROM orders", f"FROM (SELECT {PROFILED} FROM orders)")


@query("profile_merge", merge_profile_sql())
def profile_merge(spark, sf_dir):
    """Sketches of many files, stored and united, against one sketch of all rows and the exact profile."""
    path = scratch_path(spark, "sketches")
    shown = PROFILED.replace("(o_custkey % 701)", "CAST(o_custkey % 701 AS STRING)")
    rows = table(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey % 13 AS INT) AS file", *shown.split(", ", 2)[:2], shown.split(", ", 2)[2])
    column_sketches(rows, ["file"]).write.parquet(path)
    many = merged_profile(spark.read.parquet(path)).select("column_name", F.col("rows").alias("n_rows"), F.col("distinct_values").alias("m"))
    once = cardinality_profile(rows, exact=False).select("column_name", F.col("distinct_values").alias("o"))
    exact = cardinality_profile(rows).select("column_name", "distinct_values")
    near = F.abs(F.col("m") - F.col("distinct_values")) <= 0.05 * F.col("distinct_values")
    yes = lambda c: F.when(c, "Y").otherwise("N")
    joined = many.join(once, "column_name").join(exact, "column_name")
    return joined.select("column_name", "n_rows", "distinct_values", yes(F.col("m") == F.col("o")).alias("same"), yes(near).alias("near"))

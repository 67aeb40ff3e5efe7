"""In-file duplicates on line items: (order, line) repeats, and some keys are NULL."""

from __future__ import annotations


from millrace.catalog import shapes as S
from millrace.catalog.base import query
from millrace.operators import dedup
from millrace.operators.filters import complete_key

KEYS = ["folio", "line"]
ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice"]
LINES = {
    **{c: c for c in ORDER},
    "folio": "CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_orderkey END",
    "line": "l_linenumber",
    "l_quantity": "l_quantity",
    "l_returnflag": "l_returnflag",
}
OUT = ["folio", "line", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]
OUT_SQL = ", ".join(OUT)
UP = ", ".join(ORDER)
DOWN = ", ".join(f"{c} DESC" for c in ORDER)
LINES_SQL = S.select_sql(LINES, "lineitem")


def ranked(order: str, keep: str) -> str:
    return f"""SELECT {OUT_SQL} FROM (SELECT *, row_number() OVER
      (PARTITION BY folio, line ORDER BY {order}) AS rn FROM ({LINES_SQL})) WHERE rn {keep}"""


def lines(spark, sf_dir):
    return S.shaped(spark, sf_dir, "lineitem", LINES)


@query("dedup_keep_first", ranked(UP, "= 1"))
def dedup_keep_first(spark, sf_dir):
    df = lines(spark, sf_dir).select(*dict.fromkeys([*OUT, *ORDER]))
    return dedup.keep_first(df, KEYS, ORDER).select(OUT)


@query("dedup_keep_last", ranked(DOWN, "= 1"))
def dedup_keep_last(spark, sf_dir):
    df = lines(spark, sf_dir).select(*dict.fromkeys([*OUT, *ORDER]))
    return dedup.keep_last(df, KEYS, ORDER).select(OUT)


@query("dedup_rejects", ranked(UP, "> 1"))
def dedup_rejects(spark, sf_dir):
    return dedup.rejects(lines(spark, sf_dir), KEYS, ORDER).select(OUT)


@query(
    "dup_group_members",
    f"""SELECT {OUT_SQL} FROM (SELECT *, count(*) OVER (PARTITION BY folio, line) AS n
    FROM ({LINES_SQL})) WHERE n > 1""",
)
def dup_group_members(spark, sf_dir):
    return dedup.group_members(lines(spark, sf_dir), KEYS, ORDER).select(OUT)


@query(
    "filter_complete_key",
    f"SELECT {OUT_SQL} FROM ({LINES_SQL}) WHERE folio IS NOT NULL AND line IS NOT NULL",
)
def filter_complete_key(spark, sf_dir):
    return complete_key(lines(spark, sf_dir), KEYS).select(OUT)



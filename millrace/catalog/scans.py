"""Sources: tables written as feed files to the shared folder and read back as strings."""

from __future__ import annotations

import struct

from pyspark.sql import functions as F

from millrace.catalog import shapes as S
from millrace.catalog.base import query, table
from millrace.functions.clean import clean_date, clean_integer, clean_numeric, clean_text
from millrace.operators.filters import has_extension, received_on
from millrace.operators.schema import add_lineage
from millrace.operators.report import base_name
from millrace.session import scratch_path
from millrace.sources import dbf
from millrace.sources.text import list_files, listed_by_extension, read_csv_strings, union_parts, write_csv


# Cells with quotes, separators and line breaks.
AWKWARD = """CASE c_custkey % 4 WHEN 0 THEN 'a "' || c_name || '", b' WHEN 1 THEN 'x' || chr(10) || c_name
  WHEN 2 THEN c_mktsegment || ',' ELSE c_name END"""


def with_awkward_text(customers):
    return customers.selectExpr("*", f"{AWKWARD} AS note")


@query(
    "scan_csv_strings",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
      CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment, {AWKWARD} AS note FROM customer""",
)
def scan_csv_strings(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_csv(with_awkward_text(table(spark, sf_dir, "customer")), path)
    return read_csv_strings(spark, path)


@query(
    "scan_csv_typed",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
      nullif(trim({S.FOLIO_TEXT}), '') AS folio FROM orders""",
)
def scan_csv_typed(spark, sf_dir):
    path = scratch_path(spark, "csv")
    raw = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        f"{S.ISO} AS o_orderdate",
        f"{S.FOLIO_TEXT} AS folio",
    )
    write_csv(raw, path)
    rows = read_csv_strings(spark, path)
    return rows.select(
        clean_integer(F.col("o_orderkey")).alias("o_orderkey"),
        clean_integer(F.col("o_custkey")).alias("o_custkey"),
        clean_text(F.col("o_orderstatus")).alias("o_orderstatus"),
        clean_numeric(F.col("o_totalprice")).alias("o_totalprice"),
        clean_date(F.col("o_orderdate")).alias("o_orderdate"),
        clean_text(F.col("folio")).alias("folio"),
    )


@query(
    "scan_csv_ragged",
    """SELECT CAST(o_orderkey AS VARCHAR) AS k, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS s,
      CASE WHEN o_orderkey % 3 = 2 THEN CAST(o_orderkey AS VARCHAR) || ',' || o_orderstatus || ',"a,b",c' END AS surplus FROM orders""",
)
def scan_csv_ragged(spark, sf_dir):
    """Lines with one cell, with the two of the header, and with four."""
    path = scratch_path(spark, "csv")
    key = "CAST(o_orderkey AS STRING)"
    line = f"""CASE o_orderkey % 3 WHEN 0 THEN {key} WHEN 1 THEN {key} || ',' || o_orderstatus
      ELSE {key} || ',' || o_orderstatus || ',"a,b",c' END"""
    body = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{line} AS value")
    # One header above the lines of every file.
    heads = body.select(F.spark_partition_id().alias("p")).distinct().selectExpr("p", "-1L AS k", "'k,s' AS value")
    rows = body.select(F.spark_partition_id().alias("p"), F.col("o_orderkey").alias("k"), "value").union(heads)
    rows.repartition("p").sortWithinPartitions("p", "k").drop("k").write.partitionBy("p").text(path)
    names = [r["path"] for r in list_files(spark, path).select("path").collect()]
    return read_csv_strings(spark, names, surplus="surplus")


SHEETS = ("F", "O", "P")


@query(
    "multi_part_union",
    """SELECT * EXCLUDE (rn, pos, k) FROM (SELECT *, row_number() OVER (PARTITION BY scheme_code, plan_name, plan_type
        ORDER BY pos DESC, k DESC) AS rn
      FROM (SELECT CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS pos, o_orderkey AS k,
        'S' || CAST(o_custkey % 997 AS VARCHAR) AS scheme_code, o_orderpriority AS plan_name,
        'T' || CAST(o_custkey % 3 AS VARCHAR) AS plan_type, CAST(o_totalprice AS VARCHAR) AS price,
        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS fund_code FROM orders))
    WHERE rn = 1""",
)
def multi_part_union(spark, sf_dir):
    """Sheets are the orders of one status; the last sheet lacks a column."""
    orders = table(spark, sf_dir, "orders")
    parts = []
    for pos, status in enumerate(SHEETS):
        columns = [
            f"{pos} AS pos",
            "o_orderkey AS k",
            "o_orderkey AS `SL NO`",
            "'S' || CAST(o_custkey % 997 AS STRING) AS `Scheme Code`",
            "o_orderpriority AS `Plan-Name`",
            "'T' || CAST(o_custkey % 3 AS STRING) AS `PLAN TYPE`",
            "CAST(o_totalprice AS STRING) AS Price",
        ]
        if status != "P":
            columns.append("CAST(o_custkey AS STRING) AS `Fund Code`")
        parts.append(orders.where(F.col("o_orderstatus") == status).selectExpr(*columns))
    united = union_parts(parts, ["scheme_code", "plan_name", "plan_type"], ["pos", "k"])
    return united.select("scheme_code", "plan_name", "plan_type", "price", "fund_code")


# A table of every kind of field the format has, from orders: (name, kind, width, decimals, flags) and the bytes of a
# cell. Numbers in binary stand lowest byte first.
def little(value: str, size: int) -> str:
    digits = f"lpad(hex({value}), {2 * size}, '0')"
    return f"unhex({' || '.join(f'substr({digits}, {2 * k - 1}, 2)' for k in range(size, 0, -1))})"


def plain(text: str) -> str:
    return f"CAST({text} AS BINARY)"


NOTE = "substr(o_orderpriority, 1, CAST(1 + o_orderkey % 8 AS INT))"
DBF_FIELDS = [
    ("OKEY", "N", 12, 0, 0, plain("lpad(CAST(o_orderkey AS STRING), 12, ' ')")),
    ("STATUS", "C", 4, 0, 0, plain("rpad(o_orderstatus, 4, ' ')")),
    ("PRICE", "F", 14, 2, 0, plain("lpad(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING), 14, ' ')")),
    ("ODATE", "D", 8, 0, 0, plain("date_format(o_orderdate, 'yyyyMMdd')")),
    ("DONE", "L", 1, 0, 0, plain("element_at(array('T', 'n', '?'), CAST(1 + o_orderkey % 3 AS INT))")),
    ("CUST", "I", 4, 0, 0, little("CAST(o_custkey AS INT)", 4)),
    ("RATE", "B", 8, 0, 0, "unhex(element_at(array('000000000000E03F', '000000000000F83F', '00000000000000C0'), CAST(1 + o_orderkey % 3 AS INT)))"),
    ("STAMP", "T", 8, 0, 0, f"{little('CAST(2440588 + datediff(o_orderdate, DATE_FROM_UNIX_DATE(0)) AS INT)', 4)} || {little('CAST(o_orderkey % 86400 * 1000 AS INT)', 4)}"),
    ("MONEY", "Y", 8, 0, 0, little("CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 10000 AS BIGINT)", 8)),
    ("NOTE", "V", 10, 0, 2, f"{plain(f"rpad({NOTE}, 9, ' ')")} || {little(f'length({NOTE})', 1)}"),
    ("_NullFlags", "0", 1, 0, 0, "CASE WHEN o_orderkey % 11 = 0 THEN X'03' ELSE X'01' END"),
]


def write_dbf(rows, path: str, files: int = 8) -> None:
    """Tables of ``DBF_FIELDS`` as files of bytes: a text sink that ends each line with the mark of a live record, which
    stands before the record in the format. The count in the header is stale."""
    size = 1 + sum(f[2] for f in DBF_FIELDS)
    head = struct.pack("<BBBBIHH", 0x30, 125, 1, 1, 0, 32 + 32 * len(DBF_FIELDS) + 1, size).ljust(32, b"\0")
    for label, kind, width, decimals, flags, _ in DBF_FIELDS:
        head += struct.pack("<11scIBBB", label.encode(), kind.encode(), 0, width, decimals, flags).ljust(32, b"\0")
    records = rows.selectExpr(f"o_orderkey % {files} AS k", "o_orderkey AS n", f"CAST({' || '.join(f[5] for f in DBF_FIELDS)} AS STRING) AS value")
    headers = rows.sparkSession.range(files).selectExpr("id AS k", "-1L AS n", f"CAST(X'{(head + b'\r').hex()}' AS STRING) AS value")
    both = headers.union(records).repartition(files, "k").sortWithinPartitions("k", "n")
    both.select("k", "value").write.option("lineSep", " ").partitionBy("k").text(path)


@query(
    "scan_dbf",
    """SELECT CAST(o_orderkey AS VARCHAR) AS OKEY, o_orderstatus AS STATUS, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS PRICE,
      strftime(o_orderdate, '%Y%m%d') AS ODATE, ['True', 'False', NULL][1 + o_orderkey % 3] AS DONE, CAST(o_custkey AS VARCHAR) AS CUST,
      ['0.5', '1.5', '-2.0'][1 + o_orderkey % 3] AS RATE,
      strftime(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') || '.000' AS STAMP,
      CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS VARCHAR) AS MONEY,
      CASE WHEN o_orderkey % 11 <> 0 THEN substr(o_orderpriority, 1, 1 + o_orderkey % 8) END AS NOTE FROM orders""",
)
def scan_dbf(spark, sf_dir):
    """Every kind of field, in several tables, cut into many ranges."""
    path = scratch_path(spark, "dbf")
    write_dbf(table(spark, sf_dir, "orders"), path)
    paths = [r["path"] for r in list_files(spark, path, "*.txt").select("path").toLocalIterator()]
    rows = dbf.read_tables(spark, paths, range_bytes=1 << 20)
    return rows.select("OKEY", "STATUS", "PRICE", "ODATE", "DONE", "CUST", "RATE", "STAMP", "MONEY", "NOTE")


@query(
    "files_by_format",
    f"""SELECT p_partkey, path, CASE WHEN regexp_matches(lower(path), '[.](csv|dbf)$')
        THEN lower(regexp_extract(path, '[.]([^./]+)$', 1)) END AS format,
      CASE WHEN regexp_matches(lower(path), '[.](csv|dbf)$') THEN 'accepted' ELSE 'unsupported' END AS status
    FROM (SELECT p_partkey, {S.PATH_TEXT} AS path FROM part)""",
)
def files_by_format(spark, sf_dir):
    files = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{S.PATH_TEXT} AS path")
    return listed_by_extension(files, (".csv", ".dbf"))


@query(
    "filter_extension",
    f"""SELECT p_partkey, path FROM (SELECT p_partkey, {S.PATH_TEXT} AS path FROM part)
    WHERE regexp_matches(lower(path), '[.](xlsx|xls|csv)$')""",
)
def filter_extension(spark, sf_dir):
    files = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{S.PATH_TEXT} AS path")
    return files.where(has_extension(F.col("path")))


@query(
    "filter_today",
    """SELECT event_id, event_type, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06'""",
)
def filter_today(spark, sf_dir):
    events = table(spark, sf_dir, "events").where(received_on(F.col("ts"), "2024-01-05"))
    return events.select("event_id", "event_type", "value")


@query(
    "add_lineage",
    """SELECT o_orderkey, 'orders.parquet' AS file_path, DATE '2024-02-01' AS created_at,
      DATE '2024-02-01' AS updated_at FROM orders""",
)
def lineage(spark, sf_dir):
    stamped = add_lineage(table(spark, sf_dir, "orders"), "2024-02-01 06:00:00")
    return stamped.select(
        "o_orderkey",
        base_name(F.col("file_path")).alias("file_path"),
        F.col("created_at").cast("date").alias("created_at"),
        F.col("updated_at").cast("date").alias("updated_at"),
    )

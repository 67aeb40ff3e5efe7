"""Raw feed text made from the test tables.

The expressions are plain SQL that both engines read alike; every row of a table is used. Variants
of a value are picked by key so that each cleaning rule meets valid, odd and broken text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.catalog.base import table

BALANCE = "CAST(c_acctbal AS STRING)"

NAME_TEXT = """CASE c_custkey % 6
  WHEN 0 THEN '  ' || c_name || ' '
  WHEN 1 THEN ''
  WHEN 2 THEN '   '
  WHEN 3 THEN chr(160) || c_name || chr(9)
  WHEN 4 THEN NULL
  ELSE c_name END"""

NUMBER_TEXT = f"""CASE c_custkey % 14
  WHEN 0 THEN substr({BALANCE}, 1, 1) || ',' || substr({BALANCE}, 2)
  WHEN 1 THEN ' ' || {BALANCE} || ' '
  WHEN 2 THEN ''
  WHEN 3 THEN 'N/A'
  WHEN 4 THEN {BALANCE} || '%'
  WHEN 5 THEN CAST(c_custkey AS STRING) || 'e2'
  WHEN 6 THEN '.' || CAST(c_custkey AS STRING)
  WHEN 7 THEN '(' || {BALANCE} || ')'
  WHEN 8 THEN CAST(c_custkey AS STRING) || '-'
  WHEN 9 THEN '1_' || CAST(c_custkey AS STRING)
  WHEN 10 THEN 'nan'
  WHEN 11 THEN CAST(c_custkey AS STRING) || ','
  WHEN 12 THEN NULL
  ELSE {BALANCE} || ' CR' END"""

INTEGER_TEXT = f"""CASE c_custkey % 6
  WHEN 0 THEN ' ' || CAST(c_custkey AS STRING)
  WHEN 1 THEN '1,' || lpad(CAST(c_custkey AS STRING), 9, '0')
  WHEN 2 THEN CAST(c_custkey AS STRING) || '.0'
  WHEN 3 THEN '-' || CAST(c_custkey AS STRING)
  WHEN 4 THEN {BALANCE}
  ELSE 'x' END"""

PERCENT_TEXT = f"""CASE c_custkey % 7
  WHEN 0 THEN {BALANCE} || '%'
  WHEN 1 THEN '1,' || lpad(CAST(c_custkey AS STRING), 9, '0')
  WHEN 2 THEN CAST(c_custkey AS STRING) || ' %'
  WHEN 3 THEN CAST(c_custkey AS STRING) || 'e5'
  WHEN 4 THEN CAST(c_custkey AS STRING) || '.5e1'
  WHEN 5 THEN 'x'
  ELSE {BALANCE} END"""

FLAG_TEXT = """CASE c_custkey % 5
  WHEN 0 THEN 'y' WHEN 1 THEN ' N ' WHEN 2 THEN 'yes' WHEN 3 THEN NULL ELSE 'Y' END"""

MOBILE_TEXT = """CASE c_custkey % 8
  WHEN 0 THEN lpad(CAST(c_custkey AS STRING), 10, '9')
  WHEN 1 THEN '+91 ' || lpad(CAST(c_custkey AS STRING), 5, '8') || '-' || lpad(CAST(c_custkey AS STRING), 5, '7')
  WHEN 2 THEN '12' || lpad(CAST(c_custkey AS STRING), 10, '6')
  WHEN 3 THEN '0091' || lpad(CAST(c_custkey AS STRING), 9, '5')
  WHEN 4 THEN '0091' || lpad(CAST(c_custkey AS STRING), 10, '4')
  WHEN 5 THEN CAST(c_custkey AS STRING)
  WHEN 6 THEN NULL
  ELSE '91' || lpad(CAST(c_custkey AS STRING), 10, '3') END"""

YEAR = "CAST(year(o_orderdate) AS STRING)"
MONTH = "CAST(month(o_orderdate) AS STRING)"
DAY = "CAST(day(o_orderdate) AS STRING)"
MM = f"lpad({MONTH}, 2, '0')"
DD = f"lpad({DAY}, 2, '0')"
MON = "substr('JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC', 3 * CAST(month(o_orderdate) AS INTEGER) - 2, 3)"
ISO = f"{YEAR} || '-' || {MM} || '-' || {DD}"

DATE_TEXT = f"""CASE o_orderkey % 14
  WHEN 0 THEN {ISO}
  WHEN 1 THEN {DD} || '-' || {MM} || '-' || substr({YEAR}, 3, 2)
  WHEN 2 THEN {DD} || '/' || {MM} || '/' || {YEAR}
  WHEN 3 THEN {YEAR} || {MM} || {DD}
  WHEN 4 THEN {DD} || '-' || {MON} || '-' || {YEAR}
  WHEN 5 THEN 'x'
  WHEN 6 THEN ' '
  WHEN 7 THEN {ISO} || ' 13:45:10'
  WHEN 8 THEN {YEAR} || '-02-30'
  WHEN 9 THEN {YEAR} || '-' || {MONTH} || '-' || {DAY}
  WHEN 10 THEN ' ' || {MM} || '/' || {DD} || '/' || {YEAR} || ' '
  WHEN 11 THEN {MONTH} || '/' || {DAY} || '/' || substr({YEAR}, 3, 2)
  WHEN 12 THEN NULL
  ELSE {DAY} || '.' || {MONTH} || '.' || {YEAR} END"""

DMY_TEXT = f"""CASE o_orderkey % 8
  WHEN 0 THEN {DD} || '-' || {MM} || '-' || {YEAR}
  WHEN 1 THEN {DD} || '-' || {MM} || '-' || substr({YEAR}, 3, 2)
  WHEN 2 THEN {ISO}
  WHEN 3 THEN {DD} || '-' || {MM}
  WHEN 4 THEN ' ' || {DAY} || '-' || {MONTH} || '-' || {YEAR}
  WHEN 5 THEN {DD} || '/' || {MM} || '/' || {YEAR}
  WHEN 6 THEN {DD} || '-' || {MON} || '-' || substr({YEAR}, 3, 2)
  ELSE {DD} || '-13-' || {YEAR} END"""

HEADER_TEXT = """CASE p_partkey % 6
  WHEN 0 THEN ' ' || p_name || '  ' || p_type
  WHEN 1 THEN chr(9) || replace(p_name, ' ', chr(160)) || p_brand || chr(9)
  WHEN 2 THEN upper(replace(p_name, ' ', '_')) || '_' || CAST(p_size AS STRING) || 'H'
  WHEN 3 THEN p_type || '-' || p_name
  WHEN 4 THEN p_brand || ' ' || p_type || 'Date'
  ELSE lower(p_type) || 'Amount ' || p_brand END"""

# One pseudo feed file per part: its header names as a list.
HEADER_LIST = """CASE p_partkey % 5
  WHEN 0 THEN 'folio_no|' || lower(p_type) || '|amount'
  WHEN 1 THEN 'old_folio_no|trx|' || replace(p_name, ' ', '_')
  WHEN 2 THEN 'AMOUNT_INR|' || replace(p_name, ' ', '_') || '|folio'
  WHEN 3 THEN lower(p_type) || '|trxnno|date_of_trade|amount'
  ELSE replace(p_name, ' ', '|') || '|total_amount|trad' END"""

SUBJECT_TEXT = """CASE p_partkey % 14
  WHEN 0 THEN 'Daily WBR22 ' || p_name
  WHEN 1 THEN 'wbr2c: ' || p_name
  WHEN 2 THEN p_brand || '-WBR49'
  WHEN 3 THEN 'x wbr5 ' || p_type
  WHEN 4 THEN 'Feed WBR9C ' || p_name
  WHEN 5 THEN 'Feed wbr9 ' || p_name
  WHEN 6 THEN 'wbr2 ' || p_name
  WHEN 7 THEN 'R_WBR77_' || p_brand
  WHEN 8 THEN 'WBCUM ' || p_name
  WHEN 9 THEN 'wbtrn/' || p_type
  WHEN 10 THEN 'wbmst ' || p_name
  WHEN 11 THEN 'Kf WBBROK ' || p_name
  WHEN 12 THEN 'wbr2 and wbcum ' || p_name
  ELSE p_name || ' ' || p_type END"""

PATH_TEXT = """CASE p_partkey % 6
  WHEN 0 THEN '/in/' || replace(p_name, ' ', '_') || '.XLSX'
  WHEN 1 THEN '/in/' || p_brand || '.csv'
  WHEN 2 THEN '/in/' || p_type || '.dbf'
  WHEN 3 THEN '/in/' || p_type || '.xls'
  WHEN 4 THEN '/in/' || p_brand || '.zip'
  ELSE '/in/' || p_brand || '.csv.bak' END"""

# The message around each page: an archive link, a "click here" anchor, a field table, the page.
BODY_TEXT = """'<p>Report https://mailback' || CAST(page_id % 30 AS STRING)
  || '.camsonline.com/r/' || CAST(page_id AS STRING) || '.zip" and https://MAILBACK.camsonline.com/again.ZIP</p>'
  || '<table class="kv"><tr><td>File Type</td><td> ' || CASE WHEN page_id % 3 = 0 THEN 'dbf' ELSE 'Csv' END
  || ' </td></tr><tr><td>Url</td><td><b>' || replace(url, '&', '&amp;') || '</b></td><td>extra</td></tr>'
  || '<tr><td>alone</td></tr><tr><td>Url</td><td>' || CAST(page_id AS STRING) || '</td></tr></table>'
  || CASE WHEN page_id % 4 = 0 THEN '' ELSE '<a class="b" href="' || replace(url, '&', '&amp;') || '">please Click HERE now</a>' END
  || html"""

# Transaction feed from orders. Every tenth order repeats its predecessor's key, odd keys are new to
# the target, some keys are blank.
ORDER_KEY = "(CASE WHEN o_orderkey % 10 = 3 THEN o_orderkey - 1 ELSE o_orderkey END)"
FOLIO_TEXT = f"""CASE WHEN o_custkey % 40 = 0 THEN ' '
  WHEN {ORDER_KEY} % 2 = 1 THEN ' N' || CAST({ORDER_KEY} AS STRING)
  ELSE CAST({ORDER_KEY} AS STRING) || ' ' END"""
TRXN_TEXT = f"'T' || CAST({ORDER_KEY} % 7 AS STRING)"
AMOUNT_TEXT = """CASE o_orderkey % 5
  WHEN 0 THEN '' WHEN 1 THEN 'n.a.' WHEN 2 THEN '1,' || CAST(o_totalprice AS STRING)
  ELSE CAST(o_totalprice AS STRING) END"""
REMARK_TEXT = "CASE WHEN o_orderkey % 3 = 0 THEN '  ' ELSE ' ' || o_orderpriority END"

FEED_COLUMNS = {
    "row_ord": "o_orderkey",
    "folio_no": FOLIO_TEXT,
    "trxnno": TRXN_TEXT,
    "traddate": ISO,
    "amount": AMOUNT_TEXT,
    "remarks": REMARK_TEXT,
    "status": "o_orderstatus",
}
TARGET_COLUMNS = {
    "folio_no": "CAST(o_orderkey AS STRING)",
    "trxnno": "'T' || CAST(o_orderkey % 7 AS STRING)",
    "traddate": "CAST(o_orderdate AS DATE)",
    "amount": "o_totalprice",
    "remarks": "o_orderpriority",
    "status": "o_orderstatus",
    "file_path": "'seed.csv'",
    "created_on": "DATE '2024-01-01'",
    "updated_on": "DATE '2024-01-01'",
}


def shaped(spark: SparkSession, sf_dir: str, name: str, columns: dict[str, str]) -> DataFrame:
    return table(spark, sf_dir, name).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def select_sql(columns: dict[str, str], name: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {name}"


# The cleaned feed, as SQL: strip, blank to NULL, commas out of numbers.
CLEAN_FEED_SQL = f"""SELECT row_ord, nullif(trim(folio_no), '') AS folio_no, nullif(trim(trxnno), '') AS trxnno,
  try_cast(traddate AS DATE) AS traddate,
  CASE WHEN regexp_matches(trim(replace(amount, ',', '')), '^[0-9]+[.]?[0-9]*$')
    THEN try_cast(trim(replace(amount, ',', '')) AS DOUBLE) END AS amount,
  nullif(trim(remarks), '') AS remarks, nullif(trim(status), '') AS status,
  'day2.csv' AS file_path, DATE '2024-02-01' AS created_on, DATE '2024-02-01' AS updated_on
  FROM ({select_sql(FEED_COLUMNS, 'orders')})"""
TARGET_SQL = select_sql(TARGET_COLUMNS, "orders")

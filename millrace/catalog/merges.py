"""Merge policies, matching and validation on orders, customers and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import shapes as S
from millrace.catalog.base import query, table
from millrace.catalog.feedrows import (
    ALL_COLUMNS,
    KEYS,
    ORDER,
    UNIQUE_FEED_SQL,
    feed_rows,
    merge_sql,
    target_rows,
    unique_feed_rows,
)
from millrace.functions.clean import clean_numeric, clean_text
from millrace.operators import ledger, match, merge, report
from millrace.operators.dedup import keep_first
from millrace.operators.position import POSITION, land, land_in_order
from millrace.operators.validate import split_valid

PARTIAL = ["amount", "traddate", "remarks", "updated_on"]
FULL = [c for c in ALL_COLUMNS if c not in (*KEYS, "created_on")]

MATCH = "t.folio_no = s.folio_no AND t.trxnno = s.trxnno"
PAIR = f"s AS ({S.CLEAN_FEED_SQL}), t AS ({S.TARGET_SQL})"


@query("merge_upsert_partial", merge_sql(PARTIAL))
def merge_upsert_partial(spark, sf_dir):
    source, target = unique_feed_rows(spark, sf_dir), target_rows(spark, sf_dir)
    return merge.upsert(target, source, KEYS, PARTIAL, ORDER).snapshot


@query("merge_upsert_full", merge_sql(FULL))
def merge_upsert_full(spark, sf_dir):
    source, target = unique_feed_rows(spark, sf_dir), target_rows(spark, sf_dir)
    return merge.upsert(target, source, KEYS, FULL, ORDER).snapshot


@query(
    "merge_action_report",
    f"""WITH s AS ({UNIQUE_FEED_SQL}), t AS ({S.TARGET_SQL})
    SELECT row_ord, folio_no, trxnno, amount, file_path, CASE WHEN EXISTS
      (SELECT 1 FROM t WHERE {MATCH}) THEN 'update' ELSE 'insert' END AS action FROM s""",
)
def merge_action_report(spark, sf_dir):
    source, target = unique_feed_rows(spark, sf_dir), target_rows(spark, sf_dir)
    actions = merge.upsert(target, source, KEYS, PARTIAL, ORDER).actions
    return actions.select(
        "row_ord",
        "folio_no",
        "trxnno",
        "amount",
        report.base_name(F.col("file_path")).alias("file_path"),
        "action",
    )


COLUMNS_SQL = ", ".join(ALL_COLUMNS)


@query(
    "merge_append",
    f"SELECT {COLUMNS_SQL} FROM ({S.TARGET_SQL}) UNION ALL SELECT {COLUMNS_SQL} FROM ({S.CLEAN_FEED_SQL})",
)
def merge_append(spark, sf_dir):
    return merge.append(target_rows(spark, sf_dir), feed_rows(spark, sf_dir)).snapshot


# Keys chosen from the candidates a table has: here both exist, in the second form one is missing.
CANDIDATES = ["folio_no", "trxnno", "accountno"]
DYNAMIC_UPDATE = [c for c in ALL_COLUMNS if c not in (*KEYS, "file_path", "created_on")]
LAST_FEED_SQL = f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY folio_no, trxnno ORDER BY row_ord DESC) AS rn
  FROM ({S.CLEAN_FEED_SQL})) WHERE rn = 1 OR folio_no IS NULL OR trxnno IS NULL"""
NO_KEY_SQL = f"SELECT {COLUMNS_SQL} FROM ({S.TARGET_SQL}) UNION ALL SELECT {COLUMNS_SQL} FROM ({S.CLEAN_FEED_SQL})"


@query(
    "merge_dynamic_key",
    f"SELECT 'keyed' AS form, * FROM ({merge_sql(DYNAMIC_UPDATE, LAST_FEED_SQL)}) "
    f"UNION ALL SELECT 'append', * FROM ({NO_KEY_SQL})",
)
def merge_dynamic_key(spark, sf_dir):
    source, target = feed_rows(spark, sf_dir), target_rows(spark, sf_dir)
    fixed = ("file_path", "created_on")
    keyed = merge.dynamic_key(target, source, CANDIDATES, ORDER, fixed).snapshot
    plain = merge.dynamic_key(target, source, ["accountno", "trxnno"], ORDER, fixed).snapshot
    return keyed.select(F.lit("keyed").alias("form"), *ALL_COLUMNS).unionByName(
        plain.select(F.lit("append").alias("form"), *ALL_COLUMNS)
    )


@query(
    "merge_declared_key",
    f"""SELECT 'declared' AS form, * FROM ({merge_sql(FULL)})
    UNION ALL SELECT 'append', {COLUMNS_SQL} FROM ({S.TARGET_SQL})
    UNION ALL SELECT 'append', {COLUMNS_SQL} FROM ({UNIQUE_FEED_SQL})""",
)
def merge_declared_key(spark, sf_dir):
    source, target = unique_feed_rows(spark, sf_dir), target_rows(spark, sf_dir)
    yes = merge.declared_key(target, source, KEYS, FULL, ORDER, declared=True).snapshot
    no = merge.declared_key(target, source, KEYS, FULL, ORDER, declared=False).snapshot
    return yes.select(F.lit("declared").alias("form"), *ALL_COLUMNS).unionByName(
        no.select(F.lit("append").alias("form"), *ALL_COLUMNS)
    )


@query(
    "match_existing",
    f"WITH {PAIR} SELECT row_ord, folio_no, trxnno FROM s WHERE EXISTS (SELECT 1 FROM t WHERE {MATCH})",
)
def match_existing(spark, sf_dir):
    rows = match.existing_rows(feed_rows(spark, sf_dir), target_rows(spark, sf_dir), KEYS, ORDER)
    return rows.select("row_ord", *KEYS)


@query(
    "match_new",
    f"WITH {PAIR} SELECT row_ord, folio_no, trxnno FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {MATCH})",
)
def match_new(spark, sf_dir):
    rows = match.new_rows(feed_rows(spark, sf_dir), target_rows(spark, sf_dir), KEYS, ORDER)
    return rows.select("row_ord", *KEYS)


# Change detection: every fourth order differs in one tracked column; blanked values differ as NULL.
TRACKED = ["td_trno", "td_trdt", "td_amt"]
TRN_SOURCE = {
    "row_ord": "o_orderkey",
    "unqno": f"""CASE WHEN o_custkey % 40 = 0 THEN NULL
      WHEN o_orderkey % 5 = 4 THEN 'N' || CAST({S.ORDER_KEY} AS STRING)
      ELSE 'U' || CAST({S.ORDER_KEY} AS STRING) END""",
    "td_trno": "CASE WHEN o_orderkey % 8 = 5 THEN NULL ELSE o_orderstatus END",
    "td_trdt": "CAST(o_orderdate AS DATE)",
    "td_amt": "CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 1 ELSE o_totalprice END",
    "invname": "'new ' || o_orderpriority",
    "file_path": "'day2.csv'",
    "created_on": "DATE '2024-02-01'",
    "updated_on": "DATE '2024-02-01'",
}
TRN_TARGET = {
    "unqno": "'U' || CAST(o_orderkey AS STRING)",
    "td_trno": "CASE WHEN o_orderkey % 16 = 13 THEN NULL ELSE o_orderstatus END",
    "td_trdt": "CAST(o_orderdate AS DATE)",
    "td_amt": "o_totalprice",
    "invname": "o_orderpriority",
    "file_path": "'seed.csv'",
    "created_on": "DATE '2024-01-01'",
    "updated_on": "DATE '2024-01-01'",
}
JUDGED_SQL = f"""SELECT s.*, CASE WHEN t.unqno IS NULL THEN 'new'
    WHEN s.td_trno IS DISTINCT FROM t.td_trno OR s.td_trdt IS DISTINCT FROM t.td_trdt
      OR s.td_amt IS DISTINCT FROM t.td_amt THEN 'changed' ELSE 'unchanged' END AS change
  FROM ({S.select_sql(TRN_SOURCE, "orders")}) s
  LEFT JOIN ({S.select_sql(TRN_TARGET, "orders")}) t ON s.unqno = t.unqno"""


@query("classify_changes", f"SELECT row_ord, unqno, change FROM ({JUDGED_SQL})")
def classify_changes(spark, sf_dir):
    source = S.shaped(spark, sf_dir, "orders", TRN_SOURCE)
    target = S.shaped(spark, sf_dir, "orders", TRN_TARGET)
    judged = match.classify_changes(source, target, ["unqno"], TRACKED, ORDER)
    return judged.select("row_ord", "unqno", "change")


TRN_COLUMNS = ", ".join(TRN_TARGET)
TRN_UPDATE = [c for c in TRN_TARGET if c not in ("unqno", "created_on")]


@query(
    "merge_if_changed",
    f"""WITH j AS ({JUDGED_SQL}), t AS ({S.select_sql(TRN_TARGET, "orders")}),
    w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unqno ORDER BY row_ord DESC) AS rn
      FROM j WHERE change = 'changed') WHERE rn = 1)
    SELECT {TRN_COLUMNS} FROM j WHERE change = 'new'
    UNION ALL SELECT {", ".join(f"w.{c}" if c in TRN_UPDATE else f"t.{c}" for c in TRN_TARGET)}
      FROM t JOIN w ON t.unqno = w.unqno
    UNION ALL SELECT {TRN_COLUMNS} FROM t WHERE unqno NOT IN (SELECT unqno FROM w)""",
)
def merge_if_changed(spark, sf_dir):
    source = S.shaped(spark, sf_dir, "orders", TRN_SOURCE)
    target = S.shaped(spark, sf_dir, "orders", TRN_TARGET)
    return merge.if_changed(target, source, ["unqno"], TRACKED, TRN_UPDATE, ORDER).snapshot


# Contact-only merge: customers in files, one file already stored.
CUST_KEY = "(CASE WHEN c_custkey % 10 = 3 THEN c_custkey - 1 ELSE c_custkey END)"
AUM_SOURCE = {
    "row_ord": "c_custkey",
    "brok": "CASE WHEN c_nationkey = 7 THEN NULL ELSE 'B' || CAST(c_nationkey % 3 AS STRING) END",
    "folio": f"""CASE WHEN c_custkey % 4 = 1 THEN 'N' ELSE 'F' END || CAST({CUST_KEY} AS STRING)""",
    "inv_name": "lower(c_name)",
    "mobile": "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'm' || CAST(c_custkey AS STRING) END",
    "units": "c_acctbal + 1",
    "file_path": "'f' || CAST(c_custkey % 5 AS STRING)",
    "created_on": "DATE '2024-02-01'",
    "updated_on": "DATE '2024-02-01'",
}
AUM_TARGET = {
    "brok": "'B' || CAST(c_nationkey % 3 AS STRING)",
    "folio": "'F' || CAST(c_custkey AS STRING)",
    "inv_name": "c_name",
    "mobile": "'old'",
    "units": "c_acctbal",
    "file_path": "CASE WHEN c_nationkey = 3 THEN 'f0' ELSE 'seed.csv' END",
    "created_on": "DATE '2024-01-01'",
    "updated_on": "DATE '2024-01-01'",
}
AUM_COLUMNS = ", ".join(AUM_TARGET)
CONTACT = ["inv_name", "mobile", "updated_on"]


@query(
    "merge_contact_only",
    f"""WITH t AS ({S.select_sql(AUM_TARGET, "customer")}),
    s AS (SELECT * FROM ({S.select_sql(AUM_SOURCE, "customer")})
      WHERE file_path NOT IN (SELECT file_path FROM t)),
    w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY brok, folio ORDER BY row_ord DESC) AS rn
      FROM s) WHERE rn = 1)
    SELECT {", ".join(f"CASE WHEN w.folio IS NULL THEN t.{c} ELSE w.{c} END AS {c}" if c in CONTACT else f"t.{c}" for c in AUM_TARGET)}
      FROM t LEFT JOIN w ON t.brok = w.brok AND t.folio = w.folio
    UNION ALL SELECT {AUM_COLUMNS} FROM s WHERE NOT EXISTS
      (SELECT 1 FROM t WHERE t.brok = s.brok AND t.folio = s.folio)""",
)
def merge_contact_only(spark, sf_dir):
    source = S.shaped(spark, sf_dir, "customer", AUM_SOURCE)
    target = S.shaped(spark, sf_dir, "customer", AUM_TARGET)
    return merge.contact_only(target, source, ["brok", "folio"], CONTACT, ORDER).snapshot


# Last-wins merge: line items repeat their (order, line) key, so the order of rows matters. The
# target holds one row per key; keys of four in five orders are moved out of the source's range.
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice"]
LINE_SOURCE = {
    **{c: c for c in LINE_ORDER},
    "folio": "CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_orderkey END",
    "line": "l_linenumber",
    "quantity": "l_quantity",
    "price": "l_extendedprice",
    "file_path": "'f-' || l_returnflag",
    "created_on": "DATE '2024-02-01'",
    "updated_on": "DATE '2024-02-01'",
}
LINE_TARGET = {
    **{c: c for c in LINE_ORDER},
    "folio": "CASE WHEN l_orderkey % 5 = 0 THEN l_orderkey ELSE l_orderkey + 1000000000000 END",
    "line": "l_linenumber",
    "quantity": "l_quantity * 2",
    "price": "l_extendedprice * 2",
    "file_path": "'seed.csv'",
    "created_on": "DATE '2024-01-01'",
    "updated_on": "DATE '2024-01-01'",
}
LINE_COLUMNS = ["folio", "line", "quantity", "price", "file_path", "created_on", "updated_on"]
LINE_SQL_ORDER = ", ".join(LINE_ORDER)
LINE_TARGET_SQL = f"""SELECT {", ".join(LINE_COLUMNS)} FROM (SELECT *, row_number() OVER
  (PARTITION BY folio, line ORDER BY {LINE_SQL_ORDER}) AS rn
  FROM ({S.select_sql(LINE_TARGET, "lineitem")})) WHERE rn = 1"""


@query(
    "merge_last_wins",
    f"""WITH t AS ({LINE_TARGET_SQL}), s AS ({S.select_sql(LINE_SOURCE, "lineitem")}),
    n AS (SELECT *, row_number() OVER (PARTITION BY folio, line ORDER BY {LINE_SQL_ORDER}) AS up,
      row_number() OVER (PARTITION BY folio, line
        ORDER BY {", ".join(c + " DESC" for c in LINE_ORDER)}) AS down FROM s WHERE folio IS NOT NULL),
    k AS (SELECT l.folio, l.line, l.quantity, l.price, f.file_path, f.created_on, f.updated_on
      FROM n l JOIN n f ON l.folio = f.folio AND l.line = f.line AND l.down = 1 AND f.up = 1)
    SELECT t.folio, t.line, coalesce(k.quantity, t.quantity) AS quantity, coalesce(k.price, t.price) AS price,
      t.file_path, t.created_on, t.updated_on FROM t LEFT JOIN k ON t.folio = k.folio AND t.line = k.line
    UNION ALL SELECT * FROM k WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.folio = k.folio AND t.line = k.line)
    UNION ALL SELECT {", ".join(LINE_COLUMNS)} FROM s WHERE folio IS NULL""",
)
def merge_last_wins(spark, sf_dir):
    source = S.shaped(spark, sf_dir, "lineitem", LINE_SOURCE)
    seed = S.shaped(spark, sf_dir, "lineitem", LINE_TARGET)
    target = land(keep_first(seed, ["folio", "line"], LINE_ORDER).select(LINE_COLUMNS), "target")
    return merge.last_wins(
        target,
        land_in_order(source, LINE_ORDER, "lines"),
        ["folio", "line"],
        ["quantity", "price"],
        ["file_path", "created_on", "updated_on"],
        [POSITION],
    ).snapshot


@query(
    "split_valid_reject",
    f"""SELECT c_custkey, CASE WHEN nm IS NULL THEN 'reject' WHEN num IS NULL AND trim(raw) <> '' THEN 'reject'
        ELSE 'valid' END AS outcome,
      CASE WHEN nm IS NULL THEN 'missing name' WHEN num IS NULL AND trim(raw) <> '' THEN 'bad balance' END AS reason
    FROM (SELECT c_custkey, nullif(trim(nm, ' ' || chr(9) || chr(160)), '') AS nm, raw,
      CASE WHEN regexp_matches(trim(replace(raw, ',', '')), '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$')
        THEN 1 END AS num
      FROM (SELECT c_custkey, {S.NAME_TEXT} AS nm, {S.NUMBER_TEXT} AS raw FROM customer))""",
)
def split_valid_reject(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", f"{S.NAME_TEXT} AS raw_name", f"{S.NUMBER_TEXT} AS raw_balance"
    )
    cleaned = raw.select(
        "*",
        clean_text(F.col("raw_name")).alias("name"),
        clean_numeric(F.col("raw_balance")).alias("balance"),
    )
    valid, bad = split_valid(cleaned, ["name"], {"balance": "raw_balance"})
    none = F.lit(None).cast("string").alias("reason")
    return valid.select("c_custkey", F.lit("valid").alias("outcome"), none).unionByName(
        bad.select("c_custkey", F.lit("reject").alias("outcome"), "reason")
    )


# Ledger: documents are files, their content hash is the key, and labelled documents were seen before:
# completed when of good quality, failed otherwise.
LEDGER_SQL = """SELECT md5(d.text) AS file_hash, d.lang AS table_name,
  CASE WHEN max(l.quality) = 1 THEN 'COMPLETED' ELSE 'FAILED' END AS status, min(d.doc_id) AS first_doc
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2"""


def document_files(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5("text").alias("file_hash"), F.col("lang").alias("table_name"), "source", "n_chars"
    )


def stored_ledger(spark, sf_dir):
    seen = document_files(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    return seen.groupBy("file_hash", "table_name").agg(
        F.when(F.max("quality") == 1, ledger.COMPLETED).otherwise("FAILED").alias("status"),
        F.min("doc_id").alias("first_doc"),
    )


@query(
    "ledger_filter",
    f"""WITH done AS (SELECT * FROM ({LEDGER_SQL}) WHERE status = 'COMPLETED')
    SELECT doc_id, file_hash, table_name, source || '_' || table_name AS ledger_key FROM (
      SELECT doc_id, md5(text) AS file_hash, lang AS table_name, source,
        row_number() OVER (PARTITION BY md5(text), lang ORDER BY doc_id) AS rn FROM documents) f
    WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM done d
      WHERE d.file_hash = f.file_hash AND d.table_name = f.table_name)""",
)
def ledger_filter(spark, sf_dir):
    from millrace.functions.extract import ledger_key

    fresh = ledger.unprocessed(
        document_files(spark, sf_dir), stored_ledger(spark, sf_dir), ["doc_id"]
    )
    return fresh.select(
        "doc_id",
        "file_hash",
        "table_name",
        ledger_key(F.col("source"), F.col("table_name")).alias("ledger_key"),
    )


@query(
    "ledger_upsert",
    """WITH t AS (SELECT md5(d.text) AS file_hash, min(d.lang) AS table_name, 'doc' || CAST(min(d.doc_id) AS VARCHAR) AS source_file,
      CAST(max(d.n_chars) AS BIGINT) AS total_records,
      CASE WHEN max(l.quality) = 1 THEN 'COMPLETED' ELSE 'FAILED' END AS status,
      DATE '2024-01-01' AS processed_at, DATE '2024-01-01' AS created_at
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1),
    s AS (SELECT * FROM (SELECT md5(text) AS file_hash, lang AS table_name, 'doc' || CAST(doc_id AS VARCHAR) AS source_file,
      n_chars AS total_records, 'COMPLETED' AS status, DATE '2024-02-01' AS processed_at, DATE '2024-02-01' AS created_at,
      row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1)
    SELECT s.file_hash, s.table_name, s.source_file, s.total_records, s.status, s.processed_at,
      coalesce(t.created_at, s.created_at) AS created_at FROM s LEFT JOIN t ON s.file_hash = t.file_hash""",
)
def ledger_upsert(spark, sf_dir):
    files = document_files(spark, sf_dir)
    seen = files.join(table(spark, sf_dir, "labels"), "doc_id")
    old, new = F.lit("2024-01-01").cast("date"), F.lit("2024-02-01").cast("date")
    stored = seen.groupBy("file_hash").agg(
        F.min("table_name").alias("table_name"),
        F.concat(F.lit("doc"), F.min("doc_id").cast("string")).alias("source_file"),
        F.max("n_chars").alias("total_records"),
        F.when(F.max("quality") == 1, ledger.COMPLETED).otherwise("FAILED").alias("status"),
        old.alias("processed_at"),
        old.alias("created_at"),
    )
    entries = keep_first(files, ["file_hash"], ["doc_id"]).select(
        "doc_id",
        "file_hash",
        "table_name",
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("source_file"),
        F.col("n_chars").alias("total_records"),
        F.lit(ledger.COMPLETED).alias("status"),
        new.alias("processed_at"),
        new.alias("created_at"),
    )
    return ledger.record(stored, entries, ["doc_id"]).snapshot

"""Scalar functions over raw text of the test tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.catalog import shapes as S
from millrace.catalog.base import query, table
from millrace.functions import clean, contact, extract, names, routing

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160)"
FLOAT = "'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"


def over(name: str, key: str, raw: str, fn, sql: str, source: str):
    """A query that applies one function to one raw text column of a whole table."""

    @query(name, f"SELECT {key}, {sql} AS cleaned FROM (SELECT {key}, {raw} AS raw FROM {source})")
    def run(spark, sf_dir):
        df = table(spark, sf_dir, source).selectExpr(key, f"{raw} AS raw")
        return df.select(key, fn(F.col("raw")).alias("cleaned"))

    return run


def customers(name: str, raw: str, fn, sql: str):
    return over(name, "c_custkey", raw, fn, sql, "customer")


STRIPPED = f"trim(raw, {BLANKS})"
NO_COMMA = f"trim(replace(raw, ',', ''), {BLANKS})"
LOSSY = "regexp_replace(raw, '[^0-9.-]', '', 'g')"
NO_PERCENT = f"trim(regexp_replace(raw, '[,%]', '', 'g'), {BLANKS})"

customers("clean_text", S.NAME_TEXT, clean.clean_text, f"nullif({STRIPPED}, '')")
customers(
    "clean_numeric",
    S.NUMBER_TEXT,
    clean.clean_numeric,
    f"CASE WHEN regexp_matches({NO_COMMA}, {FLOAT}) THEN try_cast({NO_COMMA} AS DOUBLE) END",
)
customers(
    "clean_numeric_lossy",
    S.NUMBER_TEXT,
    clean.clean_numeric_lossy,
    f"CASE WHEN regexp_matches({LOSSY}, '^-?([0-9]+[.]?[0-9]*|[.][0-9]+)$') THEN try_cast({LOSSY} AS DOUBLE) END",
)
customers(
    "clean_numeric_percent",
    S.PERCENT_TEXT,
    clean.clean_numeric_percent,
    f"""CASE WHEN contains({NO_PERCENT}, '.') AND regexp_matches({NO_PERCENT}, {FLOAT})
      THEN try_cast({NO_PERCENT} AS DOUBLE)
      WHEN regexp_matches({NO_PERCENT}, '^[+-]?[0-9]+$') THEN try_cast({NO_PERCENT} AS DOUBLE) END""",
)
customers(
    "clean_integer",
    S.INTEGER_TEXT,
    clean.clean_integer,
    f"CASE WHEN regexp_matches({NO_COMMA}, '^[+-]?[0-9]+$') THEN try_cast({NO_COMMA} AS BIGINT) END",
)
customers(
    "clean_flag",
    S.FLAG_TEXT,
    clean.clean_flag,
    "CASE WHEN upper(trim(raw)) IN ('Y', 'N') THEN upper(trim(raw)) ELSE 'N' END",
)
DIGITS = "regexp_replace(raw, '[^0-9]', '', 'g')"
customers(
    "normalize_mobile",
    S.MOBILE_TEXT,
    contact.normalize_mobile,
    f"""CASE WHEN length({DIGITS}) = 10 THEN '91' || {DIGITS}
      WHEN length({DIGITS}) = 12 AND left({DIGITS}, 2) = '91' THEN {DIGITS}
      WHEN length({DIGITS}) = 13 AND left({DIGITS}, 4) = '0091' THEN right({DIGITS}, 12) END""",
)

# A two-digit year of the test data (1995 to 2001) belongs to 19yy from 76 on.
LONG_YEAR = """regexp_replace(regexp_replace(s, '^([0-9]{1,2}[-/][0-9]{1,2}[-/])([789][0-9])$', '\\1' || '19' || '\\2'),
  '^([0-9]{1,2}[-/][0-9]{1,2}[-/])([0-9]{2})$', '\\1' || '20' || '\\2')"""
GENERAL_DATE = f"""CAST(CASE
  WHEN regexp_matches(s, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') THEN try_strptime(s, '%Y-%m-%d')
  WHEN regexp_matches(s, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} ') THEN try_strptime(s, '%Y-%m-%d %H:%M:%S')
  WHEN regexp_matches(s, '^[0-9]{{8}}$') THEN try_strptime(s, '%Y%m%d')
  WHEN regexp_matches(s, '[A-Z]') THEN try_strptime(s, '%d-%b-%Y')
  ELSE coalesce(try_strptime(replace(replace({LONG_YEAR}, '/', '-'), '.', '-'), '%m-%d-%Y'),
                try_strptime(replace(replace({LONG_YEAR}, '/', '-'), '.', '-'), '%d-%m-%Y')) END AS DATE)"""


@query(
    "clean_date",
    f"SELECT o_orderkey, {GENERAL_DATE} AS cleaned "
    f"FROM (SELECT o_orderkey, trim({S.DATE_TEXT}) AS s FROM orders)",
)
def clean_date(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{S.DATE_TEXT} AS raw")
    return df.select("o_orderkey", clean.clean_date(F.col("raw")).alias("cleaned"))


@query(
    "clean_date_dmy",
    f"""SELECT o_orderkey, CAST(CASE
      WHEN contains(s, '/') THEN coalesce(try_strptime(s, '%m/%d/%Y'), try_strptime(s, '%d/%m/%Y'))
      WHEN len(string_split(s, '-')) <> 3 OR length(split_part(s, '-', 1)) > 2 THEN NULL
      WHEN regexp_matches(s, '[A-Z]') THEN try_strptime(full_year, '%d-%b-%Y')
      ELSE try_strptime(full_year, '%d-%m-%Y') END AS DATE) AS cleaned
    FROM (SELECT o_orderkey, s, CASE WHEN length(split_part(s, '-', 3)) = 2
        THEN split_part(s, '-', 1) || '-' || split_part(s, '-', 2) || '-'
          || CASE WHEN split_part(s, '-', 3) <= '50' THEN '20' ELSE '19' END || split_part(s, '-', 3)
        ELSE s END AS full_year
      FROM (SELECT o_orderkey, trim({S.DMY_TEXT}) AS s FROM orders))""",
)
def clean_date_dmy(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{S.DMY_TEXT} AS raw")
    return df.select("o_orderkey", clean.clean_date_dmy(F.col("raw")).alias("cleaned"))


@query(
    "format_amount",
    """SELECT o_orderkey, regexp_replace(format('{:,}', CAST(floor(abs(v)) AS BIGINT)), '^', sign)
      || '.' || split_part(CAST(CAST(abs(v) AS DECIMAL(18,2)) AS VARCHAR), '.', 2)[1:1]
      || CASE WHEN right(CAST(CAST(abs(v) AS DECIMAL(18,2)) AS VARCHAR), 1) = '0' THEN ''
           ELSE right(CAST(CAST(abs(v) AS DECIMAL(18,2)) AS VARCHAR), 1) END AS amount_text
    FROM (SELECT o_orderkey, v, CASE WHEN v < 0 THEN '-' ELSE '' END AS sign
      FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN -o_totalprice WHEN 1 THEN floor(o_totalprice)
        WHEN 2 THEN floor(o_totalprice) * 1000 ELSE o_totalprice END AS v FROM orders))""",
)
def format_amount(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        """CAST(CASE o_orderkey % 4 WHEN 0 THEN -o_totalprice WHEN 1 THEN floor(o_totalprice)
             WHEN 2 THEN floor(o_totalprice) * 1000 ELSE o_totalprice END AS DOUBLE) AS v""",
    )
    return df.select("o_orderkey", contact.format_amount(F.col("v")).alias("amount_text"))


@query(
    "alert_due_date",
    """SELECT o_orderkey, day(o_orderdate) || '/' || month(o_orderdate + INTERVAL 1 DAY) || '/'
      || year(o_orderdate + INTERVAL 1 DAY) AS due FROM orders""",
)
def alert_due_date(spark, sf_dir):
    target = F.date_add(F.col("o_orderdate").cast("date"), 1)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", contact.due_date_text(F.dayofmonth("o_orderdate"), target).alias("due")
    )


@query("content_hash", "SELECT doc_id, md5(text) AS file_hash, n_chars FROM documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(F.col("text")).alias("file_hash"), "n_chars"
    )


def header_names(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr("p_partkey", f"{S.HEADER_TEXT} AS header")


HEADERS_SQL = f"SELECT p_partkey, {S.HEADER_TEXT} AS header FROM part"


@query(
    "snake_case_names",
    f"""SELECT p_partkey, header, lower(regexp_replace(regexp_replace(trim(header, chr(9) || ' ' || chr(160)), '[\t \\x{{A0}}]+', '_', 'g'),
      '([a-z0-9])([A-Z])', '\\1_\\2', 'g')) AS name FROM ({HEADERS_SQL})""",
)
def snake_case_names(spark, sf_dir):
    return header_names(spark, sf_dir).select(
        "p_partkey", "header", names.snake_case_col(F.col("header")).alias("name")
    )


@query(
    "normalize_names_b",
    f"SELECT p_partkey, header, replace(replace(lower(trim(header, chr(9) || ' ' || chr(160))), ' ', '_'), '-', '_') AS name FROM ({HEADERS_SQL})",
)
def normalize_names_b(spark, sf_dir):
    return header_names(spark, sf_dir).select(
        "p_partkey", "header", names.plain_name_col(F.col("header")).alias("name")
    )


@query(
    "keyword_type_infer",
    f"""SELECT p_partkey, name, CASE
      WHEN contains(name, 'date') OR contains(name, 'dt') OR contains(name, 'sys_regn_d') THEN 'date'
      WHEN regexp_matches(name, 'amount|price|units|perc|comm|tax|stt|load|charg|amt|duty') THEN 'double'
      ELSE 'string' END AS kind
    FROM (SELECT p_partkey, replace(replace(lower(trim(header, chr(9) || ' ' || chr(160))), ' ', '_'), '-', '_') AS name FROM ({HEADERS_SQL}))""",
)
def keyword_type_infer(spark, sf_dir):
    named = header_names(spark, sf_dir).select(
        "p_partkey", names.plain_name_col(F.col("header")).alias("name")
    )
    return named.select("p_partkey", "name", names.kind_by_keyword_col(F.col("name")).alias("kind"))


TARGETS = ("folio_no", "trxnno", "trad_date", "amount")


@query(
    "fuzzy_column_map",
    f"""WITH files AS (SELECT p_partkey, string_split({S.HEADER_LIST}, '|') AS headers FROM part)
    SELECT p_partkey, target, CASE WHEN list_contains(headers, target) THEN target
      ELSE [h for h in headers if contains(lower(h), target) OR contains(target, lower(h))][1] END AS source
    FROM files, (VALUES {", ".join(f"('{t}')" for t in TARGETS)}) AS t(target)""",
)
def fuzzy_column_map(spark, sf_dir):
    files = table(spark, sf_dir, "part").select(
        "p_partkey", F.split(F.expr(S.HEADER_LIST), r"\|").alias("headers")
    )
    targets = F.array(*[F.lit(t) for t in TARGETS])
    return files.select("p_partkey", "headers", F.explode(targets).alias("target")).select(
        "p_partkey",
        "target",
        names.match_column_col(F.col("target"), F.col("headers")).alias("source"),
    )


def route_sql() -> str:
    lines = [
        f"WHEN contains(lower(subject), '{code}') THEN '{target}'"
        for code, target in routing.by_length(routing.ROUTES)
    ]
    return f"""SELECT p_partkey, subject, CASE {" ".join(lines)} END AS table_name
      FROM (SELECT p_partkey, {S.SUBJECT_TEXT} AS subject FROM part)"""


@query("route_feed", route_sql())
def route_feed(spark, sf_dir):
    df = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{S.SUBJECT_TEXT} AS subject")
    return df.select("p_partkey", "subject", routing.route_col(F.col("subject")).alias("table_name"))


def bodies(spark, sf_dir):
    return table(spark, sf_dir, "pages").selectExpr("page_id", "url", f"{S.BODY_TEXT} AS body")


BODIES_SQL = f"SELECT page_id, url, {S.BODY_TEXT} AS body FROM pages"
ANCHOR_SQL = """CASE WHEN regexp_matches(body, 'click here', 'i')
  THEN replace(regexp_extract(body, '<a class="b" href="([^"]*)">please', 1), '&amp;', '&') END"""


@query(
    "extract_links",
    f"""SELECT DISTINCT page_id, link FROM (
      SELECT page_id, unnest(regexp_extract_all(body, 'https://mailback[0-9]*[.]camsonline[.]com/[^\\s"<>]+[.]zip', 0, 'i')) AS link
      FROM ({BODIES_SQL}) UNION ALL
      SELECT page_id, {ANCHOR_SQL} FROM ({BODIES_SQL})) WHERE link IS NOT NULL""",
)
def extract_links(spark, sf_dir):
    links = F.explode(extract.message_links(F.col("body"))).alias("link")
    return bodies(spark, sf_dir).select("page_id", links)


@query(
    "extract_anchor_href",
    f"SELECT page_id, {ANCHOR_SQL} AS href FROM ({BODIES_SQL})",
)
def extract_anchor_href(spark, sf_dir):
    return bodies(spark, sf_dir).select(
        "page_id", extract.click_here_href(F.col("body")).alias("href")
    )


@query(
    "html_kv_table",
    """SELECT page_id, 'File Type' AS field, CASE WHEN page_id % 3 = 0 THEN 'dbf' ELSE 'Csv' END AS value,
      CASE WHEN page_id % 3 = 0 THEN 'DBF' ELSE 'CSV' END AS file_type FROM pages
    UNION ALL SELECT page_id, 'Url', CAST(page_id AS VARCHAR),
      CASE WHEN page_id % 3 = 0 THEN 'DBF' ELSE 'CSV' END FROM pages""",
)
def html_kv_table(spark, sf_dir):
    parsed = bodies(spark, sf_dir).select("page_id", extract.html_fields(F.col("body")).alias("m"))
    return parsed.select(
        "page_id",
        F.explode("m").alias("field", "value"),
        extract.field(F.col("m"), "File Type").alias("file_type"),
    )


@query(
    "classify_source",
    """SELECT page_id, CASE WHEN contains(lower(link), 'kfintech') THEN 'kfintech' ELSE 'cams' END AS source
    FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'https://KFintech.example/' || url ELSE url END AS link FROM pages)""",
)
def classify_source(spark, sf_dir):
    link: Column = F.expr(
        "CASE WHEN page_id % 3 = 0 THEN 'https://KFintech.example/' || url ELSE url END"
    )
    return table(spark, sf_dir, "pages").select("page_id", extract.source_class(link).alias("source"))

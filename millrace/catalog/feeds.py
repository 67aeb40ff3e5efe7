"""Every registered feed end to end: two waves of raw text through staging, in-file rule and merge.

Each feed gets its raw text from one test table. The first wave meets an empty target, the second one
repeats some keys, changes values and brings new keys. A wave is one file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.base import query, table
from millrace.operators.position import land, no_rows
from millrace.plans.feed import plan_feed, stage
from millrace.plans.registry import FEEDS

DAYS = {1: "2024-01-01", 2: "2024-02-01"}

CLEANED = {
    "string": "nullif(trim({0}), '')",
    "double": "try_cast(nullif(trim(replace({0}, ',', '')), '') AS DOUBLE)",
    "date": "try_cast({0} AS DATE)",
    "dmy": "CAST(try_strptime(trim({0}), '%d-%m-%Y') AS DATE)",
    "flag": "CASE WHEN upper(trim({0})) IN ('Y', 'N') THEN upper(trim({0})) ELSE 'N' END",
    "bigint": "try_cast(trim({0}) AS BIGINT)",
}


@dataclass(frozen=True)
class Shape:
    """Raw text of a feed: column -> (kind, header, SQL expression with the wave as ``{w}``)."""

    code: str
    table: str
    seq: str
    columns: dict[str, tuple[str, str, str]]
    keys: tuple[str, ...]
    changed: tuple[str, ...] = ()

    def raw(self, spark, sf_dir: str, wave: int) -> DataFrame:
        cells = [f"{e.format(w=wave)} AS `{h}`" for _, h, e in self.columns.values()]
        return table(spark, sf_dir, self.table).selectExpr(
            *cells,
            f"'/in/w{wave}.csv' AS file_path",
            "CAST(0 AS BIGINT) AS row_block",
            f"{self.seq} AS row_seq",
        )

    def sql(self, wave: int) -> str:
        cells = [f"{CLEANED[k].format('(' + e.format(w=wave) + ')')} AS {c}" for c, (k, _, e) in self.columns.items()]
        return f"""SELECT {", ".join(cells)}, '/in/w{wave}.csv' AS file_path, DATE '{DAYS[wave]}' AS created_at,
          DATE '{DAYS[wave]}' AS updated_at, {self.seq} AS seq FROM {self.table}"""

    @property
    def out(self) -> list[str]:
        return [*self.columns, "file_path", "created_at", "updated_at"]


def run_waves(shape: Shape, spark, sf_dir: str) -> DataFrame:
    spec = FEEDS[shape.code]
    target = no_rows(spark, spec.schema)
    for wave, day in DAYS.items():
        staged = stage(spec, shape.raw(spark, sf_dir, wave), f"{day} 06:00:00")
        plan = plan_feed(spec, land(staged, "landed"), target)
        target = land(plan.result.snapshot, "landed") if wave == 1 else plan.result.snapshot
    return target.select(
        *shape.columns,
        "file_path",
        F.col("created_at").cast("date").alias("created_at"),
        F.col("updated_at").cast("date").alias("updated_at"),
    )


def ranked(source: str, keys: tuple[str, ...], order: str) -> str:
    """One row per key, NULL keys equal."""
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER
      (PARTITION BY {", ".join(keys)} ORDER BY {order}) AS rn FROM ({source})) WHERE rn = 1"""


def complete(keys: tuple[str, ...]) -> str:
    return " AND ".join(f"{k} IS NOT NULL" for k in keys)


def same(keys: tuple[str, ...]) -> str:
    return " AND ".join(f"t.{k} = s.{k}" for k in keys)


def upsert_sql(shape: Shape, target: str, source: str, inserted: str | None = None) -> str:
    """Target with the changed columns of matching source rows, plus new rows of ``inserted``."""
    cells = ", ".join(
        f"CASE WHEN s.seq IS NULL THEN t.{c} ELSE s.{c} END AS {c}" if c in shape.changed else f"t.{c}"
        for c in shape.out
    )
    return f"""SELECT {cells} FROM ({target}) t LEFT JOIN ({source}) s ON {same(shape.keys)}
      UNION ALL SELECT {", ".join(shape.out)} FROM ({inserted or source}) s
      WHERE NOT EXISTS (SELECT 1 FROM ({target}) t WHERE {same(shape.keys)})"""


def first_sql(shape: Shape) -> str:
    waves = {w: ranked(shape.sql(w), shape.keys, "seq") for w in DAYS}
    return upsert_sql(shape, waves[1], waves[2])


def last_sql(shape: Shape) -> str:
    """Complete keys only, last row each."""
    waves = {
        w: ranked(f"SELECT * FROM ({shape.sql(w)}) WHERE {complete(shape.keys)}", shape.keys, "seq DESC")
        for w in DAYS
    }
    return upsert_sql(shape, waves[1], waves[2])


def reduced_sql(shape: Shape) -> str:
    """Last row of complete keys, all rows of incomplete ones."""

    def wave(w: int) -> str:
        source = shape.sql(w)
        return f"""{ranked(f"SELECT * FROM ({source}) WHERE {complete(shape.keys)}", shape.keys, "seq DESC")}
          UNION ALL SELECT * FROM ({source}) WHERE NOT ({complete(shape.keys)})"""

    return upsert_sql(shape, wave(1), wave(2))


def copies_sql(shape: Shape) -> str:
    """All copies inserted; matches take the changed columns of the last copy."""
    source = shape.sql(2)
    last = ranked(f"SELECT * FROM ({source}) WHERE {complete(shape.keys)}", shape.keys, "seq DESC")
    return upsert_sql(shape, shape.sql(1), last, inserted=source)


def tracked_sql(shape: Shape) -> str:
    """As ``copies_sql``, but only copies that differ in a tracked column from the stored row."""
    source, target = shape.sql(2), shape.sql(1)
    differs = " OR ".join(f"s.{c} IS DISTINCT FROM o.{c}" for c in FEEDS[shape.code].tracked)
    stored = f"""SELECT unqno, max({{td_trno: td_trno, td_trdt: td_trdt, td_amt: td_amt}}) AS m
      FROM ({target}) GROUP BY 1"""
    old = f"SELECT unqno, m.td_trno AS td_trno, m.td_trdt AS td_trdt, m.td_amt AS td_amt FROM ({stored})"
    changed = f"SELECT s.* FROM ({source}) s JOIN ({old}) o ON s.unqno = o.unqno WHERE {differs}"
    return upsert_sql(shape, target, ranked(changed, shape.keys, "seq DESC"), inserted=source)


def append_sql(shape: Shape) -> str:
    out = ", ".join(shape.out)
    return f"SELECT {out} FROM ({shape.sql(1)}) UNION ALL SELECT {out} FROM ({shape.sql(2)})"


# Keys made from a table: every tenth row repeats the key before it, in the second wave a third of the
# keys is new; some rows have a blank key.
def key_text(key: str, blank: str) -> str:
    base = f"(CASE WHEN {key} % 10 = 3 THEN {key} - 1 ELSE {key} END)"
    return (
        f"CASE WHEN {blank} THEN ' ' WHEN {{w}} = 2 AND {base} % 3 = 0 THEN ' N' || CAST({base} AS STRING) "
        f"ELSE CAST({base} AS STRING) || ' ' END"
    )


ORDER_KEY_TEXT = key_text("o_orderkey", "o_custkey % 40 = 0")
CUSTOMER_KEY_TEXT = key_text("c_custkey", "c_nationkey = 24")
PART_KEY_TEXT = key_text("p_partkey", "p_size = 50")

# A date that repeats along with the key: it comes from the key, not from the row.
BASE_ORDER = "(CASE WHEN o_orderkey % 10 = 3 THEN o_orderkey - 1 ELSE o_orderkey END)"
KEY_DATE = f"'2020-' || lpad(CAST({BASE_ORDER} % 12 + 1 AS STRING), 2, '0') || '-15'"
KEY_DATE_DMY = f"'15-' || lpad(CAST({BASE_ORDER} % 12 + 1 AS STRING), 2, '0') || '-2020'"
BASE_CUSTOMER = "(CASE WHEN c_custkey % 10 = 3 THEN c_custkey - 1 ELSE c_custkey END)"
CUSTOMER_DATE = f"'2020-' || lpad(CAST({BASE_CUSTOMER} % 12 + 1 AS STRING), 2, '0') || '-28'"

PRICE = "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_totalprice AS STRING) || '{w}' END"
BALANCE = "CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE CAST(c_acctbal AS STRING) || '{w}' END"
ALL = object()


def shape(code, source, seq, columns, keys, changed):
    """``changed`` of ALL means every column outside the key but ``created_at``."""
    if changed is ALL:
        changed = [c for c in [*columns, "file_path", "updated_at"] if c not in keys]
    return Shape(code, source, seq, columns, tuple(keys), tuple(changed))


def register(name: str, s: Shape, sql: str) -> None:
    query(name, sql)(lambda spark, sf_dir: run_waves(s, spark, sf_dir))


register(
    "feed_wbr2c",
    s := shape(
        "wbr2c",
        "orders",
        "o_orderkey",
        {
            "folio_no": ("string", "FOLIO_NO", ORDER_KEY_TEXT),
            "trxnno": ("string", "TrxnNo", f"'T' || CAST({BASE_ORDER} % 7 AS STRING)"),
            "traddate": ("date", "TRADDATE", KEY_DATE),
            "amount": ("double", "Amount", PRICE),
            "remarks": ("string", " Remarks ", "o_orderpriority || '{w}'"),
            "te_15h": ("string", "TE_15H", "o_orderstatus || '{w}'"),
        },
        ["folio_no", "trxnno", "traddate"],
        ["amount", "remarks", "updated_at"],
    ),
    first_sql(s),
)
register(
    "feed_wbr9",
    s := shape(
        "wbr9",
        "customer",
        "c_custkey",
        {
            "foliochk": ("string", "FOLIOCHK", CUSTOMER_KEY_TEXT),
            "product": ("string", "PRODUCT", "'P'"),
            "sch_name": ("string", "SCH_NAME", "'Growth'"),
            "rep_date": ("date", "REP_DATE", CUSTOMER_DATE),
            "inv_name": ("string", "INV_NAME", "c_name || ' {w}'"),
            "clos_bal": ("double", "CLOS_BAL", BALANCE),
            "occupation": ("string", "OCCUPATION", "c_mktsegment || ' {w}'"),
        },
        ["foliochk", "product", "sch_name", "rep_date"],
        ["inv_name", "clos_bal", "updated_at", "file_path"],
    ),
    first_sql(s),
)
register(
    "feed_wbr9c",
    s := shape(
        "wbr9c",
        "customer",
        "c_custkey",
        {
            "foliochk": ("string", "FOLIOCHK", CUSTOMER_KEY_TEXT),
            "amc_code": ("string", "AMC_CODE", "'A'"),
            "product_co": ("string", "PRODUCT_CO", "'P'"),
            "pan_pekrn": ("string", "PAN_PEKRN", "'PAN' || CAST(c_nationkey AS STRING) || '{w}'"),
            "clos_bal": ("double", "CLOS_BAL", BALANCE),
        },
        ["foliochk", "amc_code", "product_co"],
        ["pan_pekrn", "updated_at"],
    ),
    first_sql(s),
)
register(
    "feed_wbr49",
    s := shape(
        "wbr49",
        "orders",
        "o_orderkey",
        {
            "folio_no": ("string", "FOLIO_NO", ORDER_KEY_TEXT),
            "auto_trno": ("double", "AUTO_TRNO", f"CAST({BASE_ORDER} % 9 AS STRING)"),
            "from_date": ("date", "FROM_DATE", KEY_DATE),
            "auto_amoun": ("double", "AUTO_AMOUN", PRICE),
            "scheme": ("string", "SCHEME", "o_orderpriority || ' {w}'"),
        },
        ["folio_no", "auto_trno", "from_date"],
        ALL,
    ),
    first_sql(s),
)
register(
    "feed_wbr5",
    s := shape(
        "wbr5",
        "orders",
        "o_orderkey",
        {
            "folio_no": ("string", "FOLIO_NO", ORDER_KEY_TEXT),
            "ref_no": ("string", "REF_NO", f"'R' || CAST({BASE_ORDER} % 9 AS STRING)"),
            "to_date": ("dmy", "TO_DATE", KEY_DATE_DMY),
            "amount": ("double", "AMOUNT", PRICE),
            "city": ("string", "CITY", "o_orderpriority || ' {w}'"),
        },
        ["folio_no", "ref_no", "to_date"],
        ALL,
    ),
    first_sql(s),
)
register(
    "feed_wbcum",
    s := shape(
        "wbcum",
        "customer",
        "c_custkey",
        {
            "acno": ("string", "ACNO", CUSTOMER_KEY_TEXT),
            "scheme": ("string", "SCHEME", "'S'"),
            "todate": ("date", "TODATE", CUSTOMER_DATE),
            "balunits": ("double", "BALUNITS", BALANCE),
            "invname": ("string", "INVNAME", "c_name || ' {w}'"),
        },
        ["acno", "scheme", "todate"],
        ["balunits", "updated_at"],
    ),
    first_sql(s),
)
register(
    "feed_scheme",
    s := shape(
        "scheme",
        "part",
        "p_partkey",
        {
            "scheme_code": ("string", "Scheme Code", PART_KEY_TEXT),
            "plan_name": ("string", "Plan-Name", "'Plan'"),
            "plan_type": ("string", "PLAN TYPE", "'Growth'"),
            "fund_code": ("string", "Fund Code", "p_brand || ' {w}'"),
            "pur_allowed": ("flag", "Pur Allowed", "CASE p_partkey % 3 WHEN 0 THEN 'y' WHEN 1 THEN ' N' ELSE 'yes' END"),
        },
        ["scheme_code", "plan_name", "plan_type"],
        ALL,
    ),
    last_sql(s),
)
register(
    "feed_wbr22",
    s := shape(
        "wbr22",
        "customer",
        "c_custkey",
        {
            "brok_dlr_c": ("string", "BROK_DLR_C", "'B'"),
            "folio": ("string", "FOLIO", CUSTOMER_KEY_TEXT),
            "scheme_nam": ("string", "SCHEME_NAM", "'S'"),
            "asset_date": ("date", "ASSET_DATE", CUSTOMER_DATE),
            "inv_name": ("string", "INV_NAME", "c_name || ' {w}'"),
            "mobile": ("string", "MOBILE", "CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'm{w}' END"),
            "units": ("double", "UNITS", BALANCE),
        },
        ["brok_dlr_c", "folio", "scheme_nam", "asset_date"],
        ["inv_name", "mobile", "updated_at"],
    ),
    copies_sql(s),
)
register(
    "feed_wbtrn",
    s := shape(
        "wbtrn",
        "orders",
        "o_orderkey",
        {
            "unqno": ("string", "UNQNO", ORDER_KEY_TEXT),
            "td_trno": ("string", "TD_TRNO", f"'T' || CAST({BASE_ORDER} AS STRING)"),
            "td_trdt": ("date", "TD_TRDT", KEY_DATE),
            "td_amt": (
                "double",
                "TD_AMT",
                f"CASE WHEN {{w}} = 2 AND o_orderkey % 4 = 0 THEN CAST(o_totalprice AS STRING) || '9' "
                f"ELSE CAST(o_totalprice AS STRING) END",
            ),
            "invname": ("string", "INVNAME", "o_orderpriority || ' {w}'"),
        },
        ["unqno"],
        ALL,
    ),
    tracked_sql(s),
)
register(
    "feed_wbbrok",
    s := shape(
        "wbbrok",
        "orders",
        "o_orderkey",
        {
            "prcode": ("string", "PRCODE", "'P'"),
            "accountno": ("string", "ACCOUNTNO", ORDER_KEY_TEXT),
            "trno": ("string", "TRNO", "'T'"),
            "fromdate": ("date", "FROMDATE", KEY_DATE),
            "brokerage": ("double", "BROKERAGE", PRICE),
        },
        ["prcode", "accountno", "trno", "fromdate"],
        ["brokerage", "updated_at"],
    ),
    reduced_sql(s),
)
register(
    "feed_wbr2",
    s := shape(
        "wbr2",
        "orders",
        "o_orderkey",
        {
            "amc_code": ("string", "AMC_CODE", "'A'"),
            "folio_no": ("string", "FOLIO_NO", ORDER_KEY_TEXT),
            "trxnno": ("string", "TRXNNO", "'T'"),
            "traddate": ("date", "TRADDATE", KEY_DATE),
            "amount": ("double", "AMOUNT", PRICE),
            "remarks": ("string", "REMARKS", "o_orderpriority || ' {w}'"),
        },
        ["amc_code", "folio_no", "trxnno", "traddate"],
        ["amount", "remarks"],
    ),
    reduced_sql(s),
)
register(
    "feed_wbr77",
    s := shape(
        "wbr77",
        "orders",
        "o_orderkey",
        {
            "folio_no": ("string", "FOLIO_NO", ORDER_KEY_TEXT),
            "trade_date": ("string", "TRADE_DATE", KEY_DATE),
            "brkage_amt": ("double", "BRKAGE_AMT", PRICE),
            "seq_no": ("bigint", "SEQ_NO", "CASE WHEN o_orderkey % 3 = 0 THEN '12.0' ELSE CAST(o_orderkey AS STRING) END"),
        },
        [],
        [],
    ),
    append_sql(s).replace(
        CLEANED["bigint"].format("(CASE WHEN o_orderkey % 3 = 0 THEN '12.0' ELSE CAST(o_orderkey AS STRING) END)"),
        "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey AS BIGINT) END",
    ),
)
register(
    "feed_wbmst",
    s := shape(
        "wbmst",
        "customer",
        "c_custkey",
        {
            "acno": ("string", "ACNO", CUSTOMER_KEY_TEXT),
            "dob": ("date", "DOB", CUSTOMER_DATE),
            "kyc1flag": ("string", "KYC1FLAG", "CASE WHEN c_custkey % 2 = 0 THEN 'Y' ELSE '' END"),
            "invname": ("string", "INVNAME", "c_name || ' {w}'"),
        },
        [],
        [],
    ),
    append_sql(s),
)


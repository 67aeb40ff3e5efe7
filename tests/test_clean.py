"""Cleaning functions on edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import clean, contact, extract, names, routing

D = dt.date


def column(spark, fn, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["r"] for r in rows.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


CASES = {
    clean.clean_text: {
        None: None, "": None, "   ": None, "\t": None, " ": None, " a b ": "a b", " x ": "x",
    },
    clean.clean_numeric: {
        "1,234.50": 1234.5, " 5 ": 5.0, ".5": 0.5, "5.": 5.0, "1e3": 1000.0, "-2": -2.0, "N/A": None,
        "-": None, "1_000": None, "nan": None, "inf": None, "1d": None, "": None, None: None,
    },
    clean.clean_numeric_lossy: {
        "1e5": 15.0, "(12)": 12.0, "12-": None, "1,234.50 CR": 1234.5, "-": None, None: None,
    },
    clean.clean_numeric_percent: {
        "12%": 12.0, "1,200": 1200.0, "1.5%": 1.5, "1e5": None, "x": None, "": None,
    },
    clean.clean_integer: {"12": 12, "1,200": 1200, "12.0": None, "-3": -3, "x": None},
    clean.clean_flag: {"y": "Y", " N ": "N", "yes": "N", None: "N", "": "N"},
    clean.clean_date: {
        "2025-01-05": D(2025, 1, 5), "2025-1-5": D(2025, 1, 5), "05/06/2025": D(2025, 5, 6),
        "25/06/2025": D(2025, 6, 25), "20250105": D(2025, 1, 5), "05-JAN-2025": D(2025, 1, 5),
        "5 Jan 2025": D(2025, 1, 5), "January 5, 2025": D(2025, 1, 5), "2025-02-30": None,
        "1/2/25": D(2025, 1, 2), "1/2/95": D(1995, 1, 2), "2025-01-05 13:45": D(2025, 1, 5),
        "2025-01-05T13:45:00Z": D(2025, 1, 5), "x": None, "": None, None: None, "1600-01-01": None,
        "9999-12-31": None, "13/13/2025": None, "05-JANTEMBER-2025": None, "today": None,
    },
    clean.clean_date_dmy: {
        "05-01-25": D(2025, 1, 5), "05-01-75": D(1975, 1, 5), "05-01-2025": D(2025, 1, 5),
        "2025-01-05": None, "05-01": None, "05-JAN-51": D(1951, 1, 5), "05/06/2025": D(2025, 5, 6),
        "31-02-2025": None,
    },
    contact.normalize_mobile: {
        "9876543210": "919876543210", "+91 98765-43210": "919876543210", "119876543210": None,
        "0091987654321": "091987654321", "00919876543210": None, "12": None, None: None,
    },
}


@pytest.mark.parametrize("fn", CASES, ids=lambda f: f.__name__)
def test_cleaning(spark, fn):
    cases = CASES[fn]
    assert dict(zip(cases, column(spark, fn, list(cases)))) == cases


def test_two_digit_years_follow_the_run_year(spark):
    by_year = lambda c: clean.clean_date(c, century_from=1946)
    assert column(spark, by_year, ["1/2/45", "1/2/46"]) == [D(2045, 1, 2), D(1946, 1, 2)]


def test_amount_text_prints_like_a_shortest_float(spark):
    values = [5000.0, 1234.5, 0.0, -0.5, 12345678.9, 123456789012345.6, 999999.99, 0.1]
    assert column(spark, contact.format_amount, values, "double") == [f"{v:,}" for v in values]


def test_message_defaults_and_limit(spark):
    rows = spark.createDataFrame(
        [("A", 5000.0, "S"), ("", 0.0, None), (None, None, "x" * 2000)], "n string, a double, s string"
    )
    text = contact.alert_message(F.col("n"), F.col("a"), F.col("s"), F.lit("5/1/2025"), "Me")
    got = [r[0] for r in rows.select(text).collect()]
    assert got[0].startswith("Dear A, your SIP of ₹5,000.0 for S will be processed on 5/1/2025. ")
    assert got[1].startswith("Dear Investor, your SIP of ₹0 for  will be")
    assert got[1].endswith(" - Me")
    assert len(got[2]) == 1000


@pytest.mark.parametrize(
    "raw, snake, plain",
    [
        ("TE_15H", "te_15_h", "te_15h"),
        ("KYC1FLAG", "kyc1_flag", "kyc1flag"),
        ("TradDate", "trad_date", "traddate"),
        (" Inv  Name", "inv_name", "inv__name"),
        ("FOLIO_NO", "folio_no", "folio_no"),
        ("Plan-Name", "plan-name", "plan_name"),
    ],
)
def test_header_forms_agree_in_both_worlds(spark, raw, snake, plain):
    assert (names.snake_case(raw), names.plain_name(raw)) == (snake, plain)
    assert column(spark, names.snake_case_col, [raw]) == [snake]
    assert column(spark, names.plain_name_col, [raw]) == [plain]


def test_column_match_and_type_choice(spark):
    headers = ["old_folio_no", "FOLIO", "amount"]
    for target in ("folio_no", "amount", "amount_inr", "city"):
        rows = spark.createDataFrame([(target, headers)], "t string, h array<string>")
        got = rows.select(names.match_column_col(F.col("t"), F.col("h"))).first()[0]
        assert got == names.match_column(target, headers)
    assert names.match_column("folio_no", headers) == "old_folio_no"
    kinds = ["traddate", "tax_status", "igst_amoun", "brokperc", "city"]
    assert column(spark, names.kind_by_keyword_col, kinds) == [names.kind_by_keyword(k) for k in kinds]
    assert names.kind_by_keyword("tax_status") == "double"


def test_longest_code_wins(spark):
    subjects = ["x WBR2C y", "wbr22", "wbr2", "WBR9c", "none", "wbr2 and wbcum"]
    expected = [
        "cam_inv_wbr2c", "cam_aum_wbr22", "cam_investor_trxn_wbr2", "cam_investor_kyc_status_wbr9c",
        None, "kfintech_client_aum",
    ]
    assert column(spark, routing.route_col, subjects) == expected


def test_message_body(spark):
    body = (
        "<table class='x'><tr><td>File Type</td><td> dbf </td></tr><TR><td>A&amp;B</td><td>1</td></TR>"
        "<tr><td>only</td></tr><tr><td>A&amp;B</td><td><b> 9 </b></td><td>z</td></tr></table>"
        "<table><tr><td>File Type</td><td>second</td></tr></table>"
        "https://mailback12.CAMSonline.com/a/b.zip <a href='u?a=1&amp;b=2'>\n<b>Click HERE</b></a>"
    )
    rows = spark.createDataFrame([(body,), ("plain",)], "b string")
    fields = extract.html_fields(F.col("b"))
    got = rows.select(
        fields.alias("f"),
        extract.message_links(F.col("b")).alias("l"),
        extract.field(fields, "File Type").alias("t"),
    ).collect()
    assert got[0]["f"] == {"File Type": "dbf", "A&B": "9"}
    assert got[0]["l"] == ["https://mailback12.CAMSonline.com/a/b.zip", "u?a=1&b=2"]
    assert got[0]["t"] == "DBF"
    assert (got[1]["f"], got[1]["l"], got[1]["t"]) == ({}, [], "")

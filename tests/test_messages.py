"""Messages to the files they announce."""

from millrace.plans.messages import announced, first_claims, run_messages

BODY = '<p>https://mailback7.camsonline.com/a.zip https://MAILBACK.camsonline.com/b.ZIP https://mailback7.camsonline.com/a.zip</p>'
ANCHOR = '<table><tr><td>File Type</td><td>csvwh</td></tr></table><a class="x" href="https://scan.KFintech.example/q?a=1&amp;b=2">Please Click Here</a>'


def frame(spark, rows):
    return spark.createDataFrame(rows, "message_id long, received string, subject string, body string").selectExpr(
        "message_id", "CAST(received AS TIMESTAMP_NTZ) AS received", "subject", "body", "'x' AS kind", "1 AS fields"
    )


ROWS = [
    (2, "2024-06-01 09:00:00", "WBR2C today", BODY),
    (1, "2024-06-01 10:00:00", "WBR2C today", BODY + ANCHOR),
    (3, None, "WBR2C today", BODY),
    (4, "2024-06-01 23:59:59", None, ANCHOR),
    (5, "2024-06-02 00:00:00", "wbtrn", ANCHOR),
    (6, "2024-06-01 12:00:00", "no body", None),
    (None, None, None, None),
]


def test_links_fields_and_keys(spark):
    attached = spark.createDataFrame([(2, "X.ZIP"), (2, "x.pdf"), (6, "y.zip"), (None, "z.zip"), (9, "w.zip")], "message_id long, filename string")
    got = announced(frame(spark, ROWS), attached).collect()
    one = next(r for r in got if r["message_id"] == 1 and r["source"] == "kfintech")
    assert (one["location"], one["file_type"], one["code"], one["table_name"]) == ("https://scan.KFintech.example/q?a=1&b=2", "CSVWH", "wbr2c", "cam_inv_wbr2c")
    assert one["file_key"] == "WBR2C today_https://scan.KFintech.example/q?a=1&b=2" and one["fields"] == {"File Type": "csvwh"}
    assert sorted(r["file_key"] for r in got if r["kind"] == "attachment") == ["X.ZIP_WBR2C today", "y.zip_no body"]
    assert len([r for r in got if r["message_id"] == 2]) == 3
    first = {r["file_key"]: r["message_id"] for r in first_claims(announced(frame(spark, ROWS))).collect()}
    assert first["WBR2C today_https://mailback7.camsonline.com/a.zip"] == 2 and len(first) == 5


def test_runs_take_each_key_once(spark, folder):
    run = lambda ids, day, name: sorted(r["message_id"] for r in run_messages(spark, frame(spark, [r for r in ROWS if r[0] in ids]), folder, name, day=day).collect())
    assert run({1, 2, 4, 5, 6}, "2024-06-01", "r1") == [1, 2, 2, 4]
    assert run({1, 2, 4, 5, 6}, "2024-06-01", "r2") == []
    assert run(set(), "2024-06-01", "r1") == [1, 2, 2, 4]  # started again under its id
    assert run({3, 5}, None, "r3") == [5]

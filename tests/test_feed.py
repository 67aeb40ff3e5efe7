"""Whole runs over files: routing, headers, replay, failure before the commit, streaming."""

import os
import shutil

import pytest

from millrace.functions.names import kind_by_keyword
from millrace.plans import feed as feed_module
from millrace.plans import schemas
from millrace.plans.feed import FeedStore, run_feed
from millrace.plans.job import job_report, run_job
from millrace.plans.registry import FEEDS
from millrace.plans.reminders import reminders
from millrace.sources import dbf
from millrace.sources.snapshot import SnapshotTable
from millrace.sources.text import read_csv_strings
from millrace.streaming.ingest import ingest_feed

T1, T2 = "2024-06-01 00:00:00", "2024-06-02 00:00:00"


def put(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def stored(spark, root, code, *cols):
    df = FeedStore(spark, root).table(FEEDS[code]).read()
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture()
def inbox(folder):
    put(
        f"{folder}/in/x wbr2c/a.csv",
        'FOLIO_NO,TrxnNo,TRADDATE,Amount,TE_15H\n1,T1,2024-01-05,"1,000.5",k\n'
        " 1 ,T1,05-JAN-2024,2,k\n2,T2,2024-02-01,5,\n,T3,2024-02-01,5,\n",
    )
    put(
        f"{folder}/in/x wbr2c/b.csv",
        "Amount,FOLIO_NO,TrxnNo,TRADDATE,REMARKS\n77,1,T1,2024-01-05,hey\n9,3,T9,2024-03-01,\n",
    )
    put(
        f"{folder}/in/scheme/s.csv",
        "Sl No,Scheme Code,Plan-Name,Plan Type,Pur Allowed,Catg ID\n1,S1,P,G,y,5\n2,S1 ,P,G,n,6\n3,,P,G,n,6\n",
    )
    put(f"{folder}/in/wbtrn/t.csv", "UNQNO,TD_TRNO,TD_AMT,INVNAME\nu1,1,5,a\nu2,1,6,b\n")
    put(f"{folder}/in/readme.txt", "x")
    return f"{folder}/in"


def test_job_merges_reports_and_replays(spark, folder, inbox):
    root = f"{folder}/store"
    results, summary = run_job(spark, inbox, root, T1)
    assert {r.feed: r.status for r in results} == {c: "success" for c in ("scheme", "wbr2c", "wbtrn")}
    counts = {r["source_file"]: r.asDict() for r in summary.collect()}
    assert (counts["a.csv"]["total_rows"], counts["a.csv"]["duplicates"]) == (4, 1)
    assert (counts["b.csv"]["inserted"], counts["b.csv"]["updated"]) == (1, 1)
    assert (counts["s.csv"]["duplicates"], counts["s.csv"]["failed"]) == (1, 1)
    # The second file updates what the first one inserted; other columns stay with the first.
    assert stored(spark, root, "wbr2c", "folio_no", "trxnno", "amount", "remarks", "te_15h") == sorted(
        [
            ("1", "T1", 77.0, "hey", "k"),
            ("2", "T2", 5.0, None, None),
            ("3", "T9", 9.0, None, None),
            (None, "T3", 5.0, None, None),
        ],
        key=repr,
    )
    assert stored(spark, root, "scheme", "scheme_code", "pur_allowed", "sip_allowed", "catg_id") == [
        ("S1", "N", "N", 6.0)
    ]
    assert (counts["readme.txt"]["status"], counts["readme.txt"]["feed"]) == ("unsupported", None)
    report = job_report(summary).first()
    assert (report["success"], report["failures"], report["total"]) == (4, 0, 4)
    assert "wbr2c: 2 ok, 0 failed, 6 records" in report["details"]
    lost = spark.read.parquet(f"{root}/rejects")
    raw = lost.where("feed = 'wbr2c'").select("raw").first()[0]
    assert '"FOLIO_NO":" 1 "' in raw and '"TRADDATE":"05-JAN-2024"' in raw

    again, _ = run_job(spark, inbox, root, T2)
    assert {(r.status, r.detail) for r in again} == {("skipped", "file_already_processed")}

    shutil.copy(f"{inbox}/wbtrn/t.csv", f"{inbox}/wbtrn/copy.csv")
    put(f"{inbox}/wbtrn/t2.csv", "UNQNO,TD_TRNO,TD_AMT,INVNAME\nu1,1,5,zz\nu2,1,7,yy\nu3,1,1,c\n")
    run_job(spark, inbox, root, T2)
    assert stored(spark, root, "wbtrn", "unqno", "td_amt", "invname") == [
        ("u1", 5.0, "a"),
        ("u2", 7.0, "yy"),
        ("u3", 1.0, "c"),
    ]


def test_a_run_that_dies_before_the_commit_changes_nothing(spark, folder, monkeypatch):
    root, path = f"{folder}/store", put(f"{folder}/in/t.csv", "FOLIO_NO,TRADE_DATE\n1,x\n2,y\n")
    spec = FEEDS["wbr77"]

    def die(self, rows, run_id):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "append", die)
        with pytest.raises(RuntimeError):
            run_feed(spark, spec, [path], root, T1)
    assert stored(spark, root, "wbr77", "folio_no") == []
    assert run_feed(spark, spec, [path], root, T1).status == "success"
    assert run_feed(spark, spec, [path], root, T1).status == "skipped"
    assert stored(spark, root, "wbr77", "folio_no") == [("1",), ("2",)]


def test_only_touched_partitions_are_rewritten(spark, folder):
    root = f"{folder}/store"
    head = "ACNO,SCHEME,TODATE,BALUNITS\n"
    first = put(f"{folder}/a.csv", head + "1,S,2024-01-05,1\n2,S,2024-02-05,2\n3,S,,3\n")
    second = put(f"{folder}/b.csv", head + "2,S,2024-02-05,20\n")
    run_feed(spark, FEEDS["wbcum"], [first], root, T1)
    table = FeedStore(spark, root).table(FEEDS["wbcum"])
    before = dict(table._current())
    run_feed(spark, FEEDS["wbcum"], [second], root, T2)
    after = dict(table._current())
    assert {p for p in after if after[p] != before.get(p)} == {"2024-02"}
    assert stored(spark, root, "wbcum", "acno", "balunits") == [("1", 1.0), ("2", 20.0), ("3", 3.0)]


@pytest.mark.parametrize("small", [True, False])
def test_join_strategy_does_not_change_the_result(spark, folder, monkeypatch, small):
    monkeypatch.setattr(feed_module, "SMALL_BATCH_BYTES", 1 << 30 if small else 0)
    root = f"{folder}/store"
    head = "FOLIOCHK,AMC_CODE,PRODUCT_CO,CITY,EMAIL\n"
    for i, rows in enumerate(["1,A,P,x,e1\n2,A,P,x,e1\n,A,P,x,e1\n", "2,A,P,y,e2\n3,A,P,y,e2\n,A,P,y,e2\n"]):
        run_feed(spark, FEEDS["wbr9c"], [put(f"{folder}/{i}.csv", head + rows)], root, T1)
    assert stored(spark, root, "wbr9c", "foliochk", "city", "email") == sorted(
        [("1", "x", "e1"), ("2", "y", "e1"), ("3", "y", "e2"), (None, "x", "e1"), (None, "y", "e2")],
        key=repr,
    )


def test_stream_takes_new_files_once(spark, folder):
    root, inbox = f"{folder}/store", f"{folder}/in"
    put(f"{inbox}/a.csv", "FOLIO_NO,SEQ_NO\n1,5\n")
    args = (spark, FEEDS["wbr77"], inbox, root)
    ingest_feed(*args, f"{folder}/cp", T1).awaitTermination()
    put(f"{inbox}/b.csv", "FOLIO_NO,SEQ_NO\n2,12.0\n")
    put(f"{inbox}/a_again.csv", "FOLIO_NO,SEQ_NO\n1,5\n")
    ingest_feed(*args, f"{folder}/cp", T2).awaitTermination()
    # A stream that lost its checkpoint sees all files again.
    ingest_feed(*args, f"{folder}/cp2", T2).awaitTermination()
    assert stored(spark, root, "wbr77", "folio_no", "seq_no") == [("1", 5), ("2", None)]


def test_csv_files_with_different_headers(spark, folder):
    put(f"{folder}/in/a.csv", "x,y\n1,2\n")
    put(f"{folder}/in/b.csv", "y,z\n3,007\n")
    rows = read_csv_strings(spark, f"{folder}/in").select("x", "y", "z").collect()
    assert sorted((tuple(r) for r in rows), key=repr) == [("1", "2", None), (None, "3", "007")]


def test_csv_names_quotes_and_line_breaks(spark, folder):
    put(f"{folder}/in/a b.csv", 'x,X,,y\n1,2,3,"say ""hi"", you"\n"l1\nl2",5,6,7\n')
    put(f"{folder}/in/c.csv", "y\n8\n")
    df = read_csv_strings(spark, f"{folder}/in", with_position=True)
    assert df.columns[:4] == ["x", "X.1", "unnamed: 2", "y"]
    rows = df.orderBy("file_path", "row_block", "row_seq").collect()
    assert [tuple(r)[:4] for r in rows] == [
        ("1", "2", "3", 'say "hi", you'),
        ("l1\nl2", "5", "6", "7"),
        (None, None, None, "8"),
    ]


def dbf_bytes(fields, records):
    import struct

    size = 1 + sum(w for _, _, w in fields)
    head = struct.pack("<BBBBIHH", 3, 125, 1, 1, len(records), 33 + 32 * len(fields), size).ljust(32, b"\0")
    for name, kind, width in fields:
        head += struct.pack("<11scIBB", name, kind, 0, width, 0).ljust(32, b"\0")
    return head + b"\r" + b"".join(records) + b"\x1a"


def test_dbf_types_deleted_records_and_ranges(spark, folder):
    fields = [(b"NAME", b"C", 6), (b"AMT", b"N", 8), (b"DAY", b"D", 8), (b"OK", b"L", 1), (b"NO", b"I", 4), (b"MEMO", b"M", 2)]
    live = b" " + "Zoë   ".encode("latin1") + b"   12.50" + b"20240105" + b"T" + (7).to_bytes(4, "little") + b"  "
    gone = b"*" + live[1:]
    blank = b" " + b"      " + b"        " + b"        " + b"?" + (0).to_bytes(4, "little") + b"  "
    os.makedirs(f"{folder}/t")
    with open(f"{folder}/t/x.DBF", "wb") as f:
        f.write(dbf_bytes(fields, [live, gone, blank, live]))
    dbf.register(spark)
    df = spark.read.format("dbf").option("rangeBytes", 60).load(f"{folder}/t")
    assert df.rdd.getNumPartitions() > 1
    rows = df.orderBy("row_ord").drop("file_path").collect()
    assert [tuple(r) for r in rows] == [
        ("Zoë", "12.50", "20240105", "True", "7", None, 0),
        ("", None, None, None, "0", None, 2),
        ("Zoë", "12.50", "20240105", "True", "7", None, 3),
    ]


def test_registry_is_consistent():
    assert len(FEEDS) == 13
    sizes = {"wbr2c": 66, "wbr9": 96, "wbr9c": 93, "wbr49": 44, "wbr5": 27, "wbcum": 37, "scheme": 30,
             "wbr22": 16, "wbtrn": 82, "wbr77": 108, "wbmst": 123}
    assert {c: len(FEEDS[c].kinds) for c in sizes} == sizes
    assert {c: len(FEEDS[c].update_columns) for c in ("wbr49", "wbr5", "scheme")} == {
        "wbr49": 43, "wbr5": 26, "scheme": 29
    }
    assert all(k in s.kinds for s in FEEDS.values() for k in s.keys)
    listed = schemas.WBR2
    assert listed == {n: kind_by_keyword(n) for n in listed}


def test_dynamic_feed_follows_the_catalog(spark):
    schema = spark.createDataFrame(
        [], "id bigint, prcode string, accountno string, paymentdt date, cnav double, file_path string"
    ).schema
    spec = FEEDS["wbbrok"].for_catalog(schema)
    assert spec.kinds == {"prcode": "string", "accountno": "string", "paymentdt": "date", "cnav": "double"}
    assert spec.merge_keys == ["prcode", "accountno"]


def test_reminders_from_stored_tables(spark, folder):
    root = f"{folder}/store"
    plans = (
        "FOLIO_NO,AUTO_TRNO,FROM_DATE,TO_DATE,CEASE_DATE,PERIOD_DAY,AUTO_AMOUN,INV_NAME,SCHEME\n"
        "1,10,2024-01-01,2030-01-01,,15,5000,Asha,Growth\n"  # due
        "1,11,2024-01-01,2030-01-01,,16,5000,Asha,Growth\n"  # other day
        "1,12,2024-01-01,2024-02-01,,15,5000,Asha,Growth\n"  # ended
        "2,13,2024-01-01,,2024-03-01,15,5000,B,Growth\n"  # ceased
        "3,14,2024-01-01,,,15,0,,Debt\n"  # bad number
        "4,15,2024-01-01,,,15,1,D,Debt\n"  # no contact
    )
    investors = (
        "FOLIOCHK,PRODUCT,SCH_NAME,REP_DATE,MOBILE_NO\n1,P,S,2024-01-01,1\n1,P,S,2024-05-01,9876543210\n"
        "2,P,S,2024-05-01,9876543210\n3,P,S,2024-05-01,12\n4,P,S,2024-05-01,\n"
    )
    run_feed(spark, FEEDS["wbr49"], [put(f"{folder}/p.csv", plans)], root, T1)
    run_feed(spark, FEEDS["wbr9"], [put(f"{folder}/i.csv", investors)], root, T1)
    rows = reminders(FeedStore(spark, root), "2024-06-14", "Me").orderBy("folio_no").collect()
    assert [(r["folio_no"], r["status"], r["recipient"], r["reason"]) for r in rows] == [
        ("1", "ready", "919876543210", None),
        ("3", "failed", None, "invalid_mobile"),
    ]
    assert rows[0]["message"].startswith(
        "Dear Asha, your SIP of ₹5,000.0 for Growth will be processed on 15/6/2024."
    )


def ledger_rows(spark, root, code):
    return [(r["status"], r["total_records"], str(r["created_at"])[:10]) for r in FeedStore(spark, root).ledger(FEEDS[code]).collect()]


def test_a_claim_of_a_dead_run_is_taken_over(spark, folder, monkeypatch):
    root, path = f"{folder}/store", put(f"{folder}/in/t.csv", "FOLIO_NO,TRADE_DATE\n1,x\n2,y\n")
    spec = FEEDS["wbr77"]

    def die(self, rows, run_id):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "append", die)
        with pytest.raises(RuntimeError):
            run_feed(spark, spec, [path], root, T1)
    assert ledger_rows(spark, root, "wbr77") == [("CLAIMED", 0, "2024-06-01")]
    assert run_feed(spark, spec, [path], root, T2).status == "success"
    assert ledger_rows(spark, root, "wbr77") == [("COMPLETED", 2, "2024-06-01")]


def test_a_run_that_dies_after_the_commit_is_known(spark, folder, monkeypatch):
    root, path = f"{folder}/store", put(f"{folder}/in/t.csv", "FOLIO_NO,TRADE_DATE\n1,x\n2,y\n")
    spec, record = FEEDS["wbr77"], FeedStore.record

    def claims_only(self, spec, entries):
        if entries.first()["status"] != "CLAIMED":
            raise RuntimeError("lost")
        record(self, spec, entries)

    with monkeypatch.context() as m:
        m.setattr(FeedStore, "record", claims_only)
        with pytest.raises(RuntimeError):
            run_feed(spark, spec, [path], root, T1)
    assert run_feed(spark, spec, [path], root, T2).status == "skipped"
    assert stored(spark, root, "wbr77", "folio_no") == [("1",), ("2",)]


def test_added_entries_are_upserts(spark):
    from millrace.operators import ledger

    rows = [("h1", "t", "a", 0, "CLAIMED", 1), ("h1", "t", "b", 2, "COMPLETED", 2), ("h2", "t", "c", 0, "CLAIMED", 2), ("h1", "t", "d", 3, "CLAIMED", 3)]
    stamp = "timestamp_seconds({0})"
    events = spark.createDataFrame(rows, "file_hash string, table_name string, source_file string, total_records bigint, status string, recorded_at bigint")
    events = events.selectExpr("*", stamp.format("recorded_at") + " AS processed_at", stamp.format("recorded_at") + " AS created_at")
    table = events.where("false").drop("recorded_at")
    for k in (1, 2, 3):
        table = ledger.record(table, events.where(f"recorded_at = {k}").drop("recorded_at"), ["source_file"]).snapshot
    assert sorted(map(str, ledger.current(events).select(table.columns).collect())) == sorted(map(str, table.collect()))


def test_rows_the_target_refuses(spark, folder):
    from dataclasses import replace

    root = f"{folder}/store"
    path = put(f"{folder}/in/a.csv", "FOLIO_NO,TrxnNo,TRADDATE,Amount,Remarks\n1,T1,2024-01-05,1,ok\n,T2,2024-01-05,2,x\n3,T3,2024-01-05,99999.996,x\n4,T4,2024-01-05,,toolong\n5,T5,2024-01-05,99999.994,\n")
    spec = replace(FEEDS["wbr2c"], limits="folio_no string NOT NULL, amount decimal(7,2), remarks varchar(3)")
    summary = run_feed(spark, spec, [path], root, T1).summary.first()
    assert (summary["inserted"], summary["failed"], summary["total_rows"]) == (2, 3, 5)
    assert stored(spark, root, "wbr2c", "folio_no") == [("1",), ("5",)]
    reasons = {r["reason"] for r in spark.read.parquet(f"{root}/rejects").collect()}
    assert reasons == {"missing folio_no", "out of range amount", "too long remarks"}


def test_a_changed_sheet_makes_a_new_workbook(spark, folder):
    root, book = f"{folder}/store", f"{folder}/in/Book.XLSX"
    one = put(f"{book}/1.csv", "Scheme Code,Plan-Name,Plan Type,Fund Code\nS1,P,G,F1\nS2,P,G,F1\nS1,P,G,F2\n")
    put(f"{book}/2.csv", "Scheme Code,Plan-Name,Plan Type,Plan Type,Sl No\nS2,P,G,H,1\nS3,P,G,H,1\n")
    put(f"{folder}/in/lone.csv", "Scheme Code,Plan-Name,Plan Type,Fund Code\nS9,P,G,F9\n")
    summary = {r["source_file"]: r for r in run_feed(spark, FEEDS["scheme"], f"{folder}/in", root, T1).summary.collect()}
    assert (summary["Book.XLSX"]["inserted"], summary["Book.XLSX"]["duplicates"], summary["lone.csv"]["inserted"]) == (3, 2, 1)
    assert stored(spark, root, "scheme", "scheme_code", "fund_code") == [("S1", "F2"), ("S2", None), ("S3", None), ("S9", "F9")]
    report = spark.read.parquet(f"{root}/duplicates")
    assert report.count() == 2  # S2 is on both sheets; S1 is twice on one
    assert run_feed(spark, FEEDS["scheme"], f"{folder}/in", root, T2).status == "skipped"
    put(one, "Scheme Code,Plan-Name,Plan Type,Fund Code\nS1,P,G,F7\n")
    assert run_feed(spark, FEEDS["scheme"], f"{folder}/in", root, T2).status == "success"
    assert stored(spark, root, "scheme", "scheme_code", "fund_code") == [("S1", "F7"), ("S2", None), ("S3", None), ("S9", "F9")]

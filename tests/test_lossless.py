"""Nothing of a feed file goes missing without a trace."""

import os
import random
import struct

import pytest
from pyspark.sql import functions as F

from millrace.functions import contact, extract, names
from millrace.operators.schema import rename_all
from millrace.plans.feed import FeedStore, run_feed
from millrace.plans.registry import FEEDS
from millrace.sources import dbf
from millrace.sources.text import read_csv_strings
from tests.test_feed import T1, T2, put


def test_headers_of_any_length(spark, folder):
    cells = [f"column_number_{i:07d}" for i in range(3000)]
    path = put(f"{folder}/wide.csv", ",".join(cells) + "x" * (1 << 20) + "\n" + ",".join(["1"] * 3000) + "\n")
    assert len(read_csv_strings(spark, [path]).columns) == 3000


def test_headers_with_line_breaks(spark, folder):
    path = put(f"{folder}/a.csv", 'a,"b\nx",c\n1,"2\n2",3\n')
    df = read_csv_strings(spark, [path])
    assert df.columns == ["a", "b\nx", "c"]
    assert [tuple(r) for r in df.collect()] == [("1", "2\n2", "3")]


def test_surplus_cells_are_kept_as_records(spark, folder):
    path = put(f"{folder}/a.csv", 'a,b\n1\n1,2\n1,2,3\n"1,1","2 ""x"", y"\n1,"2,2",3,4\n')
    rows = read_csv_strings(spark, [path], surplus="more").collect()
    assert [(r["a"], r["b"]) for r in rows][:2] == [("1", None), ("1", "2")]
    assert [r["more"] for r in rows] == [None, None, "1,2,3", None, '1,"2,2",3,4']


def test_clashing_headers_are_numbered(spark):
    df = spark.range(1).selectExpr("'oops' AS AMOUNT", "'7' AS `Amount `", "'8' AS ` amount`")
    assert rename_all(df).columns == ["amount", "amount.2", "amount.3"]


def test_rejects_and_unread_cells(spark, folder):
    put(f"{folder}/in/a.csv", "FOLIO_NO,TrxnNo,TRADDATE,Amount\n1,T1,2024-01-05,oops\n2,T2,2024-01-05,5,6\n3,T3,2024-01-05,7\n3,T3,2024-01-05,8\n")
    result = run_feed(spark, FEEDS["wbr2c"], f"{folder}/in", f"{folder}/store", T1)
    assert result.status == "success"
    lost = {r["raw"]: (r["action"], r["reason"]) for r in spark.read.parquet(f"{folder}/store/rejects").collect()}
    assert lost["2,T2,2024-01-05,5,6"] == ("reject", "more cells than the header")
    assert sorted(a for a, _ in lost.values()) == ["duplicate", "reject"]
    unread = spark.read.parquet(f"{folder}/store/unread").collect()
    assert [(r["cells"], "oops" in r["raw"]) for r in unread] == [(["amount"], True)]
    stored = FeedStore(spark, f"{folder}/store").table(FEEDS["wbr2c"]).read()
    assert sorted((r["folio_no"], r["amount"]) for r in stored.collect()) == [("1", None), ("3", 7.0)]
    counts = result.summary.first()
    assert (counts["total_rows"], counts["failed"], counts["duplicates"]) == (4, 1, 1)


def test_brokerage_keeps_all_columns(spark, folder):
    head = "PRCODE,ACCOUNTNO,TRNO,FROMDATE,CNAV,INVNAME"
    put(f"{folder}/in/a.csv", f"{head}\nP,1,T,2024-01-05,12.5,Ann\n")
    root = f"{folder}/store"
    assert run_feed(spark, FEEDS["wbbrok"], f"{folder}/in", root, T1).status == "success"
    table = FeedStore(spark, root).table(FEEDS["wbbrok"])
    put(f"{folder}/in/b.csv", "PRCODE,ACCOUNTNO,TRNO,FROMDATE,INVNAME\nP,1,T,2024-01-05,Bob\nP,2,U,2024-01-06,Cy\n")
    assert run_feed(spark, FEEDS["wbbrok"], f"{folder}/in", root, T2).status == "success"
    wide = table.stored_schema()
    assert {"cnav", "invname"} <= set(wide.fieldNames())
    paths = [p for _, p in table._current()]
    got = spark.read.schema(wide).parquet(*paths).select("accountno", "cnav", "invname").collect()
    assert sorted(map(tuple, got), key=str) == [("1", None, "Bob"), ("2", None, "Cy")]


def test_a_stored_holdings_file_is_skipped_in_any_month(spark, folder):
    head = "BROK_DLR_C,FOLIO,SCHEME_NAM,ASSET_DATE,INV_NAME"
    put(f"{folder}/in/a.csv", f"{head}\nB,1,S,2024-01-05,Ann\n")
    root = f"{folder}/store"
    assert run_feed(spark, FEEDS["wbr22"], f"{folder}/in", root, T1).status == "success"
    put(f"{folder}/in/a.csv", f"{head}\nB,9,S,2024-03-05,Bob\n")
    assert run_feed(spark, FEEDS["wbr22"], f"{folder}/in", root, T2).status == "skipped"
    assert FeedStore(spark, root).table(FEEDS["wbr22"]).read().count() == 1


@pytest.mark.parametrize("raw", ["\tFolio No", "Folio\xa0No", " TradDate ", "a\x1cB", "x  Y", "\x85KYC1Flag"])
def test_header_forms_agree_on_all_white_space(spark, raw):
    df = spark.createDataFrame([(raw,)], "c string")
    got = df.select(names.snake_case_col(F.col("c")), names.plain_name_col(F.col("c"))).first()
    assert tuple(got) == (names.snake_case(raw), names.plain_name(raw))


def test_amounts_of_any_size(spark):
    values = [1e15, 9.99e15, 1e16, 1.5e18, -2.25e20, 1e300, 123.0, float("inf"), float("-inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(contact.format_amount(F.col("v"))).collect()] == [f"{v:,}" for v in values]


def test_repeated_keys_of_a_message_keep_the_last_value(spark):
    rows = "".join(f"<tr><td>k{i % 7}</td><td>{i}</td></tr>" for i in range(400))
    df = spark.createDataFrame([(f"<table>{rows}</table>",)], "b string")
    assert df.select(extract.html_fields(F.col("b"))).first()[0] == {f"k{i % 7}": str(i) for i in range(400)}


def dbf_file(path, fields, records, count=None, version=0x30, end=b"\x1a"):
    """A table of the given (name, type, width) fields and records of bytes."""
    size, start = 1 + sum(w for *_, w in fields), 32 + 32 * len(fields) + 1
    head = struct.pack("<BBBBIHH", version, 125, 1, 1, len(records) if count is None else count, start, size).ljust(32, b"\0")
    for name, kind, width in fields:
        head += struct.pack("<11scIBB", name.encode(), kind.encode(), 0, width, 0).ljust(32, b"\0")
    with open(path, "wb") as f:
        f.write(head + b"\r" + b"".join(records) + end)
    return path


def test_dbf_field_types_and_stale_counts(spark, folder):
    fields = [("C", "C", 3), ("N", "N", 5), ("D", "D", 8), ("L", "L", 1), ("I", "I", 4), ("B", "B", 8), ("T", "T", 8), ("Y", "Y", 8), ("O", "O", 8), ("A", "+", 4), ("S", "@", 8)]
    moment = struct.pack("<ii", 2_460_311, 3_723_000)  # 2024-01-01 01:02:03
    one = b" ab " + b" 1.50" + b"20240105" + b"T" + struct.pack("<i", -7) + struct.pack("<d", 2.5) + moment + struct.pack("<q", 12_345) + struct.pack("<d", 1e20) + struct.pack("<i", 9) + moment
    gone = b"*" + one[1:]
    dbf.register(spark)
    path = dbf_file(f"{folder}/t.dbf", fields, [one, gone, one], count=1)
    rows = spark.read.format("dbf").load(path).collect()
    want = ("ab", "1.50", "20240105", "True", "-7", "2.5", "2024-01-01 01:02:03.000", "1.2345", "1e+20", "9", "2024-01-01 01:02:03.000")
    assert [tuple(r)[:11] for r in rows] == [want, want]
    assert [r["row_ord"] for r in rows] == [0, 2]
    path = dbf_file(f"{folder}/end.dbf", fields[:1], [b" abc", b"\x1aold", b" old"], end=b"")
    assert [r["C"] for r in spark.read.format("dbf").load(path).collect()] == ["abc"]
    dbf_file(f"{folder}/odd.dbf", [("C", "Q", 3)], [b" abc"])
    with pytest.raises(Exception, match="unknown field types"):
        spark.read.format("dbf").load(f"{folder}/odd.dbf").collect()


def test_holdings_files_at_once_as_one_after_another(spark, folder):
    rng = random.Random(6)
    head = "BROK_DLR_C,FOLIO,SCHEME_NAM,ASSET_DATE,INV_NAME,MOBILE,UNITS"
    paths = []
    for n in range(4):
        rows = [f"B,{rng.choice(['1', '2', '3', '4', '5', ''])},S,2024-0{rng.randint(1, 2)}-05,N{n}{i},{i},{n}" for i in range(12)]
        paths.append(put(f"{folder}/in/{'dacb'[n]}.csv", "\n".join([head, *rows]) + "\n"))
    before = put(f"{folder}/in0/x.csv", f"{head}\nB,1,S,2024-01-05,old,0,9\nB,1,S,2024-01-05,old,0,8\n")
    spec, columns = FEEDS["wbr22"], ("folio", "asset_date", "inv_name", "mobile", "units", "file_path")
    seen = {}
    for name, runs in (("each", [[p] for p in sorted(paths)]), ("once", [paths])):
        root = f"{folder}/{name}"
        summaries = [run_feed(spark, spec, run, root, T1).summary for run in ([before], *runs)]
        counts = [(r["source_file"], r["total_rows"], r["inserted"], r["updated"]) for s in summaries for r in s.collect()]
        stored = FeedStore(spark, root).table(spec).read().select(*columns).collect()
        seen[name] = sorted(counts), sorted(map(str, stored))
    assert seen["each"] == seen["once"]
    assert len(seen["once"][0]) == 5


def test_dbf_varchar_is_text(spark, folder):
    """A V field holds its length in the last byte where its flag is set; nullable fields have a bit of their own."""
    fields = [("ID", "C", 2), ("A", "V", 6), ("B", "V", 4), ("_NullFlags", "0", 1)]
    record = lambda i, a, b, flags: b" " + i + a + b + bytes([flags])
    rows = [
        record(b"r1", b"abc\0\0\x03", b"wxyz", 0b0001),  # A short, B full
        record(b"r2", b"abcdef", b"\xe9 \0\x02", 0b0010),  # A full, B short, ends in a blank
        record(b"r3", b"\0" * 5 + b"\0", b"\0\0\0\0", 0b0111),  # A empty, B short and NULL
    ]
    path = dbf_file(f"{folder}/v.dbf", fields, rows)
    raw = bytearray(open(path, "rb").read())
    raw[32 + 2 * 32 + 18] |= 2  # B may be NULL
    open(path, "wb").write(raw)
    dbf.register(spark)
    got = [(r["A"], r["B"]) for r in spark.read.format("dbf").load(path).orderBy("row_ord").collect()]
    assert got == [("abc", "wxyz"), ("abcdef", "\xe9 "), ("", None)]
    path = dbf_file(f"{folder}/plain.dbf", fields[:2], [b" r1abc   ", b" r2abcdef"], version=0x03)
    assert [r["A"] for r in spark.read.format("dbf").load(path).orderBy("row_ord").collect()] == ["abc", "abcdef"]


def test_headers_and_ranges_are_read_in_tasks(spark, folder, monkeypatch):
    """A thousand tables, none of which the driver opens."""
    fields = [("A", "C", 4), ("B", "N", 3)]
    for i in range(1000):
        more = [("EXTRA", "C", 2)] if i == 700 else []
        dbf_file(f"{folder}/t{i:04d}.dbf", fields + more, [b" r%03d%3d" % (i, i % 9) + (b"xy" if more else b"")] * (i % 3))

    driver, opened, real = os.getpid(), [], dbf._open

    def watched(path):
        if os.getpid() == driver:
            opened.append(path)
        return real(path)

    monkeypatch.setattr(dbf, "_open", watched)
    paths = [f"{folder}/t{i:04d}.dbf" for i in range(1000)]
    df = dbf.read_tables(spark, paths, range_bytes=16)
    assert df.columns == ["A", "B", "EXTRA", "file_path", "row_ord"] and not opened
    got = df.collect()
    assert len(got) == sum(i % 3 for i in range(1000))
    assert {r["EXTRA"] for r in got if r["file_path"].endswith("t0700.dbf")} == {"xy"}
    assert all(r["A"] == "r" + r["file_path"][-7:-4] and r["B"] == str(int(r["A"][1:]) % 9) for r in got)


def test_latin_text_of_varying_length():
    import numpy as np

    cells = np.frombuffer("é\xe9b\x00abcd\xff\x00\x00\x01".encode("latin1"), dtype=np.uint8).reshape(3, 4)
    flags = np.array([[0], [0], [3]], dtype=np.uint8)
    assert dbf.decode_varchar(cells, flags, 0, 1).to_pylist() == ["éébé"[:3] + "\x00", "abcd", None]
    flags = np.array([[1], [1], [1]], dtype=np.uint8)
    cells = np.frombuffer(b"\xe9\xe9b\x02abc\x00\xffxy\x03", dtype=np.uint8).reshape(3, 4)
    assert dbf.decode_varchar(cells, flags, 0, 1).to_pylist() == ["éé", "", "ÿxy"]

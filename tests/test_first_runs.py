"""What a run spares: rows alone under their key are not compared, what is the same in all rows is not stored or shuffled."""

from __future__ import annotations

import io

import pytest
from pyspark.sql import functions as F

from millrace.functions.clean import clean_date
from millrace.operators import position
from millrace.operators.position import known_empty, land, no_rows, repeated_keys, with_position
from millrace.plans import feed
from millrace.plans.registry import FEEDS
from millrace.session import HUGE_METHOD, compiled_methods
from millrace.sources.heads import has_quotes
from millrace.sources.snapshot import SnapshotTable, date_part
from tests.test_feed import T1, put

VALUES = {"date": ["2024-01-05", "2024-02-05"], "date_dmy": ["05-01-2024", "05-02-2024"], "double": ["1", "2"]}


def raw_rows(spark, spec, run: int):
    """Two files with keys of their own, keys that repeat in a file and over files, and incomplete keys."""
    more = next(c for c in (*spec.tracked, *spec.update_columns) if c not in spec.keys and spec.cleaning.get(c) in ("string", "double"))
    rows = []
    for i in range(36):
        first, rest = spec.keys[0], spec.keys[1:]
        key = f"r{run}-{i}" if i % 3 == 0 else None if i % 11 == 4 else f"k{i % 7}"
        cells = {first: key, **{k: VALUES.get(spec.cleaning[k], ["a", "b"])[i % 5 == 1] for k in rest}, more: str(i * run)}
        rows.append((*cells.values(), f"/in/{run}-{i % 2}.csv", 0, i))
    names = [f"`{c}` string" for c in (*spec.keys, more)]
    return spark.createDataFrame(rows, ", ".join([*names, "file_path string, row_block long, row_seq long"]))


def told(df) -> list[str]:
    return sorted(str(sorted(r.asDict().items(), key=lambda x: x[0])) for r in df.collect())


@pytest.mark.parametrize("code", ["wbr2c", "wbr5", "wbr22", "wbtrn", "wbr2", "wbbrok", "scheme"])
def test_rows_alone_under_their_key_change_nothing(spark, monkeypatch, code):
    spec, stored = FEEDS[code], {}
    for run in (1, 2):
        staged = with_position(land(feed.stage(spec, raw_rows(spark, spec, run), T1), "rows"))
        target = stored.get("snapshot") or no_rows(spark, spec.schema)
        results = []
        for most in (-1, 1000):
            monkeypatch.setattr(position, "BROADCAST_REPEATS", most)
            plan = feed.plan_feed(spec, staged, target, many_files=True)
            parts = (plan.result.snapshot, plan.result.actions, plan.duplicates, plan.dropped)
            results.append([told(p) for p in parts])
            stored["snapshot"] = land(plan.result.snapshot, "stored")
        assert results[0] == results[1]
        assert results[0][0] and results[0][1]


def test_a_batch_without_repeats_is_inserted_as_it_is(spark, monkeypatch):
    spec = FEEDS["wbr2"]
    staged = with_position(land(feed.stage(spec, raw_rows(spark, spec, 1).where("row_seq % 3 = 0"), T1), "rows"))
    monkeypatch.setattr(feed, "merged", None)
    plan = feed.plan_feed(spec, staged, no_rows(spark, spec.schema), many_files=True)
    assert plan.result.snapshot.count() == 12
    assert [tuple(r) for r in plan.result.actions.groupBy("action").count().collect()] == [("insert", 12)]
    assert plan.duplicates.isEmpty()


def test_repeated_keys(spark, monkeypatch):
    rows = spark.createDataFrame([("a", 0.0), ("a", -0.0), ("b", 1.0), (None, 2.0), (None, 2.0), ("c", None)], "k string, v double")
    repeats = repeated_keys(rows, ["k", "v"])
    assert repeats.count == 2
    assert sorted(r["k"] for r in repeats.others(rows).collect()) == ["b", "c"]
    assert repeats.rows(rows).count() == 4
    monkeypatch.setattr(position, "BROADCAST_REPEATS", 1)
    assert repeated_keys(rows, ["k", "v"]) is None


def test_landed_rows_are_those_of_the_stage(spark, folder):
    put(f"{folder}/in a%41+/a.csv", 'FOLIO_NO,TrxnNo,TRADDATE,Amount\n1,"T,1",05-JAN-2024,oops\n2,T2,2024-01-05,"1,000"\n,,,\n')
    put(f"{folder}/in a%41+/b.csv", "Amount,FOLIO_NO,Other\n5,3,x\n5,3,x,y\n")
    paths = [f"file:{folder}/in a%41+/{n}.csv" for n in "ab"]
    for code in ("wbr2c", "wbr2", "wbmst"):
        spec, raw = FEEDS[code], land(feed.read_raw(spark, paths), "raw")
        want = feed.stage(spec, raw, T1)
        got = feed.land_staged(spec, raw, T1, f"{folder}/{code}")
        assert got.schema.names == want.schema.names and [t for _, t in got.dtypes] == [t for _, t in want.dtypes]
        assert told(got) == told(want)
        stored = spark.read.parquet(f"{folder}/{code}").columns
        assert not {"created_at", "remarks", "kyc1flag", "_raw"} & set(stored) and "_cells" in stored
        files = with_position(got, feed.plain_path).select("file_path").distinct()
        assert sorted(r[0] for r in files.collect()) == paths


def test_columns_that_are_the_same_are_not_shuffled(spark, folder):
    table = SnapshotTable(spark, f"{folder}/t", spark.createDataFrame([], "k string, a int, b string").schema, F.col("k"))
    table.replace(spark.sql("SELECT 'x' AS k, 1 AS a, CAST(NULL AS STRING) AS b"), {"x"}, "r1", {"b": F.lit(None).cast("string")})
    table.append(spark.sql("SELECT 'y' AS k, 2 AS a, 'z' AS b"), "r2")
    assert sorted(map(tuple, table.read().collect())) == [("x", 1, None), ("y", 2, "z")]


def test_known_empty(spark):
    rows = spark.range(3)
    assert known_empty(no_rows(spark, rows.schema)) and not known_empty(rows) and not known_empty(rows.where("id > 5"))


def test_parts_are_named_as_before(spark):
    days = ["2024-01-05", "0001-01-01", "9999-12-31", "1999-12-31", None]
    rows = spark.createDataFrame([(d,) for d in days], "d string").selectExpr("CAST(d AS DATE) AS d").union(spark.sql("SELECT DATE'9999-12-31' + 40"))
    both = rows.select(date_part("d"), F.coalesce(F.date_format("d", "yyyy-MM"), F.lit("none"))).collect()
    assert all(a == b for a, b in both) and both[0][0] == "2024-01"


def test_dates_with_blanks_around(spark):
    texts = ["2024-01-05", " 2024-01-05", "2024-01-5 ", "2024-01-5　", "2024-13-05", "2024-01-05 ", "2024-01-0x", "2199-12-31", "2200-01-01", "1699-01-01"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(clean_date(F.col("t")))
    got = [str(r[0]) for r in rows.collect()]
    day, five = "2024-01-05", ["2024-01-05"] * 4
    assert got == [*five, "None", day, "None", "2199-12-31", "2200-01-01", "1699-01-01"]


def test_quotes_are_found_in_any_chunk():
    assert has_quotes(io.BytesIO(b"a" * (9 << 20) + b'"')) and not has_quotes(io.BytesIO(b"a,b\n1,2\n"))


def test_the_setting_is_restored(spark):
    before = spark.conf.get(HUGE_METHOD)
    with compiled_methods(spark), compiled_methods(spark):
        assert spark.conf.get(HUGE_METHOD) == "8000"
    assert spark.conf.get(HUGE_METHOD) == before

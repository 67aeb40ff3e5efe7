"""Streams that die, and state that stays small."""

import os

import pytest

from millrace.plans.feed import FeedStore
from millrace.plans.registry import FEEDS
from millrace.sources import heads
from millrace.streaming import ingest

T1 = "2024-06-01 00:00:00"


def put(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def files_below(folder: str) -> list[str]:
    return sorted(f for _, _, names in os.walk(folder) for f in names)


def test_a_stream_that_dies_before_it_archives(spark, folder, monkeypatch):
    spec = FEEDS["wbr77"]
    put(f"{folder}/in/a/1.csv", "FOLIO_NO\n1\n")
    put(f"{folder}/in/b/1.csv", "FOLIO_NO\n2\n")
    put(f"{folder}/in/readme.txt", "x")
    run = lambda: ingest.ingest_feed(spark, spec, f"{folder}/in", f"{folder}/store", f"{folder}/cp", T1, f"{folder}/old").awaitTermination()

    def die(*a):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ingest, "move_files", die)
        with pytest.raises(Exception, match="lost"):
            run()
    stored = lambda: sorted(r[0] for r in FeedStore(spark, f"{folder}/store").table(spec).read().select("folio_no").collect())
    assert stored() == ["1", "2"] and len(files_below(f"{folder}/in")) == 3
    run()
    assert stored() == ["1", "2"]
    assert files_below(f"{folder}/in") == ["readme.txt"] and [f for f in files_below(f"{folder}/old") if f.endswith(".csv")] == ["1.csv", "1.csv"]


def test_a_move_can_be_repeated(folder):
    import pyarrow as pa

    one, two = put(f"{folder}/a.csv", "x"), f"{folder}/deep/er/a.csv"
    batch = pa.RecordBatch.from_pydict({"path": [one], "target": [two]})
    for _ in range(2):
        list(heads.move_files(iter([batch])))
    assert open(two).read() == "x" and not os.path.exists(one)
    with pytest.raises(FileNotFoundError):
        list(heads.move_files(iter([pa.RecordBatch.from_pydict({"path": [one], "target": [f"{folder}/other"]})])))


def test_the_state_of_the_dedup_stream_is_bounded(spark, folder):
    schema = spark.createDataFrame([], "k string, v long, arrived timestamp").schema
    kept, rows_in_state = {}, []
    for n in range(5):
        rows = [(f"{n}-{i}", i) for i in range(50)] + [("0-1", -n), (f"{n}-1", -n), (None, n)]
        for k, _ in rows:
            kept.setdefault(k, n)
        frame = spark.createDataFrame(rows, "k string, v long").selectExpr("*", f"timestamp'2024-01-01 00:00:00' + make_dt_interval({n}) AS arrived")
        frame.write.parquet(f"{folder}/in/{n}")
        query = ingest.dedup_to_table(ingest.read_table_stream(spark, f"{folder}/in", schema), ["k"], "arrived", "1 hour", f"{folder}/out", f"{folder}/cp")
        query.awaitTermination()
        rows_in_state.append(max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]))
    got = spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(f"{folder}/out").collect()
    assert {r["k"]: int(str(r["arrived"])[8:10]) - 1 for r in got} == kept and len(got) == len(kept)
    assert len(kept) == 251 and max(rows_in_state) <= 110

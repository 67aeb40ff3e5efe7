"""Properties of dedup, match and merge, on small frames against plain Python."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import dedup, match, merge
from millrace.operators.skew import SLOT, hot_keys, spread, spread_join

SCHEMA = "pos long, k string, v long"
rows_of = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.integers(0, 3)), min_size=1, max_size=14
)
quick = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows, parts=3):
    data = [(i, k, v) for i, (k, v) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(parts, F.hash("pos"))


def as_set(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@quick
@given(rows_of)
def test_keep_first_and_rejects_split_the_input(spark, rows):
    df = frame(spark, rows)
    seen, first, rest = set(), [], []
    for i, (k, v) in enumerate(rows):
        (rest if k in seen else first).append((i, k, v))
        seen.add(k)
    kept = as_set(dedup.keep_first(df, ["k"], ["pos"]), "pos", "k", "v")
    lost = as_set(dedup.rejects(df, ["k"], ["pos"]), "pos", "k", "v")
    assert kept == sorted(first, key=repr)
    assert lost == sorted(rest, key=repr)


@quick
@given(rows_of)
def test_group_members_are_the_rows_with_company(spark, rows):
    keys = [k for k, _ in rows]
    expected = [(i, k) for i, (k, _) in enumerate(rows) if keys.count(k) > 1]
    got = dedup.group_members(frame(spark, rows), ["k"], ["pos"])
    assert as_set(got, "pos", "k") == sorted(expected, key=repr)


def test_partitioning_does_not_change_the_survivor(spark):
    rows = [(k, i) for i, k in enumerate("abcab" * 20)]
    one = as_set(dedup.keep_first(frame(spark, rows, 1), ["k"], ["pos"]), "pos", "k")
    many = as_set(dedup.keep_first(frame(spark, rows, 7), ["k"], ["pos"]), "pos", "k")
    assert one == many == [(0, "a"), (1, "b"), (2, "c")]


def test_the_limit_runs_below_the_shuffle(spark):
    df = frame(spark, [("a", 1)] * 10)
    plan = dedup.keep_first(df, ["k"], ["pos"])._jdf.queryExecution().executedPlan().toString()
    before = plan.split("Exchange hashpartitioning(k")[1]
    assert "WindowGroupLimit" in before and "Partial" in before


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, how):
    rows = [("hot", i) for i in range(300)] + [("b", 1), (None, 2), ("c", 3), (None, 4)]
    left = frame(spark, rows)
    right = spark.createDataFrame([("hot", 1), ("b", 2), ("z", 3), (None, 4)], "k string, w long")
    got = spread_join(left, right, ["k"], ["pos"], how, hot_rows=20)
    want = left.join(right, "k", how)
    assert as_set(got, *sorted(want.columns)) == as_set(want, *sorted(want.columns))


def test_a_hot_key_is_split(spark):
    left = frame(spark, [("hot", i) for i in range(1000)] + [("cold", 1)])
    right = spark.createDataFrame([("hot",), ("cold",)], "k string")
    assert [r["_slots"] for r in hot_keys(left, ["k"], 100).collect()] == [10]
    lhs, rhs, on = spread(left, right, ["k"], ["pos"], hot_rows=100)
    assert on == ["k", SLOT]
    slots = {r["k"]: r["n"] for r in lhs.groupBy("k").agg(F.countDistinct(SLOT).alias("n")).collect()}
    assert slots == {"hot": 10, "cold": 1}
    assert rhs.where("k = 'hot'").count() == 10


TARGET = "k string, v long, note string, born string"


def target_frame(spark, rows):
    return spark.createDataFrame(rows, TARGET)


SOURCE = [(0, "a", 10, None, "day2"), (1, "x", 11, "n", "day2"), (2, None, 12, "n", "day2")]
STORED = [("a", 1, "old", "day1"), ("b", 2, "old", "day1"), (None, 3, "old", "day1")]


@pytest.mark.parametrize("small", [False, True])
def test_upsert_changes_only_the_listed_columns(spark, small):
    target = target_frame(spark, STORED)
    source = spark.createDataFrame(SOURCE, "pos long, " + TARGET)
    result = merge.upsert(target, source, ["k"], ["v", "note"], ["pos"], small)
    assert as_set(result.snapshot, *target.columns) == sorted(
        [
            ("a", 10, None, "day1"),
            ("b", 2, "old", "day1"),
            (None, 3, "old", "day1"),
            ("x", 11, "n", "day2"),
            (None, 12, "n", "day2"),
        ],
        key=repr,
    )
    actions = {r["pos"]: r["action"] for r in result.actions.collect()}
    assert actions == {0: "update", 1: "insert", 2: "insert"}


def test_upsert_twice_is_upsert_once_for_complete_keys(spark):
    target = target_frame(spark, STORED)
    source = spark.createDataFrame(SOURCE, "pos long, " + TARGET).dropna(subset=["k"])
    once = merge.upsert(target, source, ["k"], ["v", "note"], ["pos"]).snapshot
    twice = merge.upsert(once, source, ["k"], ["v", "note"], ["pos"]).snapshot
    assert as_set(once, *target.columns) == as_set(twice, *target.columns)


@quick
@given(rows_of, rows_of)
def test_last_wins_equals_row_by_row(spark, stored, incoming):
    seen, state = set(), []
    for k, v in stored:
        if k is None or k not in seen:
            state.append([k, v, "old"])
            seen.add(k)
    target = spark.createDataFrame([tuple(r) for r in state], "k string, v long, born string")
    inserted = updated = 0
    for i, (k, v) in enumerate(incoming):
        hits = [r for r in state if k is not None and r[0] == k]
        for r in hits:
            r[1] = v
        updated += bool(hits)
        if not hits:
            inserted += 1
            state.append([k, v, f"new{i}"])
    source = frame(spark, incoming).withColumn("born", F.concat(F.lit("new"), F.col("pos").cast("string")))
    result = merge.last_wins(target, source, ["k"], ["v"], ["born"], ["pos"])
    assert as_set(result.snapshot, "k", "v", "born") == sorted((tuple(r) for r in state), key=repr)
    counts = {r["action"]: r["count"] for r in result.actions.groupBy("action").count().collect()}
    assert (counts.get("insert", 0), counts.get("update", 0)) == (inserted, updated)


def test_if_changed_keeps_all_new_copies_and_skips_equal_rows(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x")], "k string, v long, note string")
    rows = [(0, "a", 1, "y"), (1, "b", 5, "y"), (2, "b", 2, "z"), (3, "n", 1, "y"), (4, "n", 2, "y"), (5, None, 1, "y")]
    source = spark.createDataFrame(rows, "pos long, k string, v long, note string")
    result = merge.if_changed(target, source, ["k"], ["v"], ["v", "note"], ["pos"])
    assert as_set(result.snapshot, "k", "v", "note") == sorted(
        [("a", 1, "x"), ("b", 5, "y"), ("n", 1, "y"), ("n", 2, "y"), (None, 1, "y")], key=repr
    )
    actions = {r["pos"]: r["action"] for r in result.actions.collect()}
    assert actions == {0: "unchanged", 1: "update", 2: "unchanged", 3: "insert", 4: "insert", 5: "insert"}


def test_changes_are_null_safe(spark):
    target = spark.createDataFrame([("a", None), ("b", 1)], "k string, v long")
    source = spark.createDataFrame([(0, "a", None), (1, "b", None)], "pos long, k string, v long")
    got = match.classify_changes(source, target, ["k"], ["v"], ["pos"])
    assert as_set(got, "pos", "change") == [(0, "unchanged"), (1, "changed")]


@pytest.mark.parametrize("policy", ["contact_only", "if_changed", "last_wins"])
def test_a_broadcast_batch_gives_the_same_merge(spark, policy):
    columns = "k string, v long, note string, file_path string"
    target = spark.createDataFrame(
        [("a", 1, "t", "f0"), ("a", 1, "t", "f0"), ("b", 2, "t", "f0"), (None, 3, "t", "f0")], columns
    )
    rows = [(0, "a", 5, "s", "f1"), (1, "a", 6, "s", "f1"), (2, "n", 7, "s", "f1"), (3, None, 8, "s", "f1"), (4, "n", 9, "s", "f1"), (5, "b", 2, "s", "f1")]
    source = spark.createDataFrame(rows, "pos long, " + columns)
    arguments = {
        "contact_only": (["k"], ["note"], ["pos"]),
        "if_changed": (["k"], ["v"], ["v", "note"], ["pos"]),
        "last_wins": (["k"], ["v", "note"], ["file_path"], ["pos"]),
    }[policy]
    run = getattr(merge, policy)
    wide, small = (run(target, source, *arguments, small_source=b) for b in (False, True))
    assert as_set(wide.snapshot, *target.columns) == as_set(small.snapshot, *target.columns)
    assert as_set(wide.actions, "pos", "action") == as_set(small.actions, "pos", "action")


def one_by_one(stored, files):
    """The change-tracking rule, file after file, row after row."""
    state, actions = [list(r) for r in stored], []
    for name, rows in files:
        found = {}
        for k, v, _ in state:
            if k is not None and (k not in found or (v is not None, v or 0) > (found[k] is not None, found[k] or 0)):
                found[k] = v
        winner, fresh = {}, []
        for k, v, note in rows:
            if k is None or k not in found:
                fresh.append([k, v, note])
                actions.append("insert")
            elif v != found[k]:
                winner[k] = (v, note)
                actions.append("update")
            else:
                actions.append("unchanged")
        for r in state:
            if r[0] in winner:
                r[1], r[2] = winner[r[0]]
        state += fresh
    return sorted(map(tuple, state), key=repr), actions


versions = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None])), max_size=5)


@settings(max_examples=15, deadline=None)
@given(versions, st.lists(versions, min_size=1, max_size=6), st.booleans())
def test_files_in_one_pass_equal_files_one_by_one(spark, stored, waves, small):
    kept = [(k, v, "old") for k, v in stored]
    files = [(f"f{i}", [(k, v, f"{i}.{j}") for j, (k, v) in enumerate(rows)]) for i, rows in enumerate(waves)]
    state, actions = one_by_one(kept, files)
    target = spark.createDataFrame(kept, "k string, v long, note string")
    flat = [(n, k, v, note, name) for n, (name, (k, v, note)) in enumerate((name, r) for name, rows in files for r in rows)]
    source = spark.createDataFrame(flat, "pos long, k string, v long, note string, file string").repartition(3)
    result = merge.if_changed(target, source, ["k"], ["v"], ["v", "note"], ["pos"], small_source=small, files=["file"])
    assert as_set(result.snapshot, "k", "v", "note") == state
    assert [r["action"] for r in result.actions.orderBy("pos").collect()] == actions


def test_last_wins_by_position_needs_no_sorted_aggregation(spark):
    from millrace.operators.position import POSITION, land_in_order

    rows = [(i, f"k{i % 40}", i) for i in range(400)]
    source = spark.createDataFrame(rows, "pos long, k string, v long").withColumn("born", F.col("pos").cast("string")).repartition(5)
    landed = land_in_order(source, ["pos"], "ordered")
    assert [r["pos"] for r in landed.orderBy(POSITION).collect()] == list(range(400))
    target = spark.createDataFrame([("k1", -1, "old")], "k string, v long, born string")
    result = merge.last_wins(target, landed, ["k"], ["v"], ["born"], [POSITION])
    want = [(f"k{i}", 360 + i, "old" if i == 1 else str(i)) for i in range(40)]
    assert as_set(result.snapshot, "k", "v", "born") == sorted(want, key=repr)
    assert "SortAggregate" not in result.snapshot._jdf.queryExecution().executedPlan().toString()


def by_contact(stored, files):
    """Holdings, file after file: a new key is inserted with all its rows, a known one takes the last row's contact."""
    state, actions = [list(r) for r in stored], []
    for _, rows in files:
        known = {r[0] for r in state if r[0] is not None}
        for k, v, note in rows:
            actions.append("update" if k in known else "insert")
        winner = {k: note for k, _, note in rows if k in known}
        for r in state:
            if r[0] in winner:
                r[2] = winner[r[0]]
        state += [[k, v, note] for k, v, note in rows if k not in known]
    return sorted(map(tuple, state), key=repr), actions


@quick
@given(versions, st.lists(versions, min_size=1, max_size=4), st.booleans())
def test_holdings_files_in_one_pass_equal_files_one_by_one(spark, stored, waves, small):
    kept = [(k, v, "old") for k, v in stored]
    files = [(f"f{i}", [(k, v, f"{i}.{j}") for j, (k, v) in enumerate(rows)]) for i, rows in enumerate(waves)]
    state, actions = by_contact(kept, files)
    target = spark.createDataFrame([(*r, "seed") for r in kept], "k string, v long, note string, file_path string")
    flat = [(n, k, v, note, name) for n, (name, (k, v, note)) in enumerate((name, r) for name, rows in files for r in rows)]
    source = spark.createDataFrame(flat, "pos long, k string, v long, note string, file_path string").repartition(3)
    result = merge.contact_only(target, source, ["k"], ["note"], ["pos"], small_source=small, many_files=True)
    assert as_set(result.snapshot, "k", "v", "note") == state
    assert [r["action"] for r in result.actions.orderBy("pos").collect()] == actions

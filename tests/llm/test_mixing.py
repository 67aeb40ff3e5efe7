from collections import defaultdict

from millrace.llm import mixing


def filled(sizes, weights, budget, most):
    """Shares a budget by weight, stops the full ones, shares the rest again."""
    left, given, open_ = budget, dict.fromkeys(sizes, 0.0), set(sizes)
    while open_:
        each = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if each * weights[s] >= most * sizes[s]}
        if not full:
            return given | {s: each * weights[s] for s in open_}
        for s in full:
            given[s] = float(most * sizes[s])
            left -= given[s]
        open_ -= full
    return given


def rows():
    out = []
    for k, (source, n) in enumerate((("a", 40), ("b", 400), ("c", 60), ("é", 5), (None, 30), ("none", 1))):
        out += [(1000 * k + i, "w " * (1 + (7 * i + k) % 23), "en", source) for i in range(n)]
    return [*out, (9000, None, None, "a"), (9001, "", None, "only-empty"), (9002, "x y", None, "c"), (9002, "x y", None, "c"), (None, "p q r", None, "c")]


def test_account(spark, documents, clashing):
    data = rows()
    got = mixing.account(spark, clashing(documents(data))).collect()
    assert len(got) == len(data)
    sizes = defaultdict(int)
    for _, text, _, source in data:
        sizes[source] += len((text or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = filled(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(sizes.values()), 2)
    source_of = {(i, len((t or "").split())): s for i, t, _, s in data}
    taken, longest = defaultdict(int), defaultdict(int)
    for r in got:
        s = source_of[r["doc_id"], r["size"]]
        assert abs(r["target"] - want[s]) < 1e-6 and r["source_size"] == sizes[s]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
        longest[s] = max(longest[s], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6
    places = [r["position"] for r in got if r["position"] is not None]
    assert places == sorted(places) and 0 <= places[0] and places[-1] <= 1


def test_reruns_and_partitions_agree(spark, documents):
    one = mixing.account(spark, documents(rows(), 1)).collect()
    two = mixing.account(spark, documents(rows(), 7)).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_mix(spark, documents, clashing):
    df = clashing(documents(rows()))
    mixed = mixing.mix(spark, df)
    assert mixed.columns == df.columns
    counted = defaultdict(int)
    for r in mixed.collect():
        counted[r["doc_id"], r["source"]] += 1
    source_of = {(i, len((t or "").split())): s for i, t, _, s in rows()}
    want = defaultdict(int)
    for r in mixing.account(spark, df).collect():
        if r["copies"]:
            want[r["doc_id"], source_of[r["doc_id"], r["size"]]] += r["copies"]
    assert counted == want


def test_schedules_bend_the_order(spark, documents):
    """A source whose weight falls is read early, one whose weight rises late."""
    data = [(1000 * k + i, "w w w", None, s) for k, s in enumerate("abc") for i in range(200)]
    got = mixing.account(spark, documents(data)).collect()
    mean = {k: [r["position"] for r in got if r["doc_id"] // 1000 == k and r["position"] is not None] for k in range(3)}
    mean = {k: sum(v) / len(v) for k, v in mean.items()}
    assert mean[0] < 0.45 and 0.55 < mean[2]


def test_empty(spark, documents):
    assert mixing.account(spark, documents([(1, "x")]).where("false")).count() == 0
    assert mixing.mix(spark, documents([(1, "x")]).where("false")).count() == 0


def test_rows_without_id_lie_in_many_slices(spark, documents):
    rows = [(None, f"w {i}", "en", "a") for i in range(900)]
    sized = mixing._sized(documents(rows), mixing.F.lit(0), "doc_id", "source", "text", 30)
    got = [r["count"] for r in sized.groupBy("slice").count().collect()]
    assert len(got) == 30 and max(got) < 90

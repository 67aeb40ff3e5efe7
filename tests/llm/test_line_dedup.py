import random
from collections import defaultdict

import pytest

from millrace.llm import line_dedup

BLANK = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
LONG = "One line of Boilerplate that is long enough"
BITS = [LONG, f"  {LONG.upper()}\t", "short", "", "É" * 20, "é" * 20, "  ", "another line, also of fair length", "ÀB" * 10 + "\x0b", "ÀB" * 10, "x" * 19, "Y" * 20]


def brute(rows, least_docs=3, least_chars=20):
    docs = defaultdict(set)
    below = lambda i: (i is not None, i or 0)
    key = lambda s: s.strip(BLANK).translate(LOWER)
    for i, t, *_ in rows:
        for s in (t or "").split("\n"):
            docs[key(s)].add(below(i))
    out = []
    for i, t, *_ in rows:
        own = (t or "").split("\n")
        kept = [s for s in own if len(key(s)) < least_chars or len(docs[key(s)]) < least_docs or max(docs[key(s)]) == below(i)]
        out.append((str(i), len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out)


def rows():
    rng = random.Random(11)
    out = [(i, "\n".join(rng.choice(BITS) for _ in range(rng.randint(0, 12)))) for i in range(40)]
    out += [(100, None), (101, ""), (102, "\n\n"), (None, LONG), (None, f"{LONG}\n{LONG}"), (7, LONG), (7, f"a\n{LONG}\nb"), (7, LONG)]
    out += [(200, "\n".join(f"{LONG} {i % 500} {'é' * (i % 3)}" for i in range(20_000)))]  # a very long text
    out += [(201 + k, f"{LONG} 3 \n{LONG} 4 é\nown {k} of a document of its own") for k in range(3)]
    return out


@pytest.mark.parametrize(("hot", "least"), [(line_dedup.HOT_ROWS, 3), (5, 3), (0, 3), (5, 2), (0, 4)])
def test_against_brute_force(spark, documents, clashing, hot, least):
    """With 0 every key takes the hot way, with many none does: the same result."""
    data = rows()
    df = clashing(documents(data))
    maps = line_dedup.bitmaps(spark, df, line_dedup.Settings(hot_rows=hot, least_docs=least))
    got = line_dedup.apply(df, maps).collect()
    assert sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["kept"]) for r in got) == brute(data, least)


def test_bitmaps_are_runs(spark, documents):
    texts = [(1, f"{LONG}\n{LONG}\nmine"), (2, f"a\n{LONG}\nb\n{LONG} \n {LONG}"), (3, LONG)]
    maps = {r["doc_id"]: [tuple(x) for x in r["drops"]] for r in line_dedup.bitmaps(spark, documents(texts)).collect()}
    assert maps == {1: [(0, 2)], 2: [(1, 1), (3, 2)]}


def test_one_range_shuffle_and_no_python(spark, documents):
    df = documents(rows())
    landed = line_dedup.land(spark, line_dedup.entries(df), "lines")
    plan = line_dedup._cold_dropped(landed, line_dedup._hot(spark, landed, line_dedup.PRODUCTION), line_dedup.PRODUCTION)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("rangepartitioning") == 1 and "hashpartitioning" not in text and "Python" not in text


def test_empty_table_and_other_ids(spark, documents):
    assert line_dedup.apply(documents([(1, "x")]).where("false"), line_dedup.bitmaps(spark, documents([(1, "x")]).where("false"))).count() == 0
    named = spark.createDataFrame([(f"d{i}", LONG) for i in range(4)], "name string, body string")
    got = line_dedup.apply(named, line_dedup.bitmaps(spark, named, doc_id="name", text="body"), "name", "body")
    assert sorted((r["doc_id"], r["kept"]) for r in got.collect()) == [("d0", ""), ("d1", ""), ("d2", ""), ("d3", LONG)]

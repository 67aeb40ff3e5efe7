import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash


def fingerprint(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    votes = [0] * 64
    for g in [w[i : i + k] for i in range(max(1, len(w) - k + 1))] if w else []:
        h = 42
        for x in g:
            h = xxhash.xxh64_intdigest(x.encode(), seed=h)
        votes = [v + (1 if h >> b & 1 else -1) for b, v in enumerate(votes)]
    return sum(1 << b for b, v in enumerate(votes) if v > 0)


def like(a, b):
    return 1 - bin(a ^ b).count("1") / 64


def check(spark, df, rows):
    got = {r["doc_id"]: r for r in simhash.compare_edited(spark, df).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    texts = [t or "" for _, t in order]
    prints = [fingerprint(t) for t in texts]
    assert len(got) == len(rows)
    for k, (i, _) in enumerate(order):
        t, after = texts[k], (k + 1) % len(order)
        half = len(t) // 2
        edited = t[: len(t) - half] + texts[after][:half]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert int(r["fingerprint"], 16) == prints[k] and int(r["edited_fingerprint"], 16) == fingerprint(edited)
        assert r["near_edited"] == like(prints[k], fingerprint(edited)) and r["near_next"] == like(prints[k], prints[after])
        want = sum(bin(prints[k] ^ p).count("1") <= 3 for p in prints) - 1 if i is not None and i % 100 == 0 else None
        assert r["n_near"] == want


def test_against_brute_force(spark, documents, clashing):
    rng = random.Random(9)
    rows = [(rng.randrange(-(10**6), 10**12) if n % 3 else n * 100, " ".join(rng.choice("the of and é x日本 \U0001f600 word".split()) for _ in range(rng.randint(0, 40)))) for n in range(150)]
    rows = list(dict(rows).items())
    rows += [(5_000_100, rows[0][1]), (-(2**62), None), (2**62, "a"), (7, "\n"), (None, "last one of all")]
    check(spark, clashing(documents(rows)), rows)


def test_ranges_in_steps(spark, documents, monkeypatch):
    monkeypatch.setattr(simhash, "QUANTILES", 4)
    rows = [(n * n, f"text {n} with some words in it {n % 7}") for n in range(120)]
    got = simhash.with_next(spark, documents(rows).select("doc_id", "text"), simhash.Settings(rows_per_range=4))
    texts = dict(rows)
    row_of = {r["row"]: r["doc_id"] for r in got.collect()}
    order = sorted(texts, reverse=True)
    assert len(row_of) == len(rows)
    for r in got.collect():
        follows = order[(order.index(r["doc_id"]) + 1) % len(order)]
        assert r["next_text"] == texts[follows] and row_of[r["next_row"]] == follows


def test_few_rows(spark, documents):
    check(spark, documents([(3, "only one here")]), [(3, "only one here")])
    same = [(1, "a b c"), (1, "a b c"), (1, "a b c")]
    got = simhash.compare_edited(spark, documents(same)).collect()
    assert len(got) == 3 and all(r["near_next"] == 1 for r in got)
    assert simhash.compare_edited(spark, documents(same).where("false")).count() == 0


def test_every_fingerprint_within_the_radius(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 6))) for b in base for _ in range(10)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in [*base, *near]], "fp long")
    asked = spark.createDataFrame([(signed(x),) for x in base], "fp long")
    for s in (simhash.PRODUCTION, simhash.Settings(radius=3, blocks=6), simhash.Settings(radius=4, blocks=6), simhash.Settings(radius=1, blocks=2)):
        got = {(r["query"], r["fp"]) for r in simhash.within_radius(asked, df, s).collect()}
        want = {(signed(a), signed(b)) for a in base for b in {*base, *near} if bin(a ^ b).count("1") <= s.radius}
        assert got == want and simhash.within_radius(asked, df, s).count() == len(want)


def test_no_python_in_the_plan(spark, documents):
    df = documents([(1, "a b c"), (2, "d")])
    plan = simhash.fingerprints(df.select("doc_id", "text"), {"text": "fp"}).select(F.col("fp"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

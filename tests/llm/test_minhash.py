import random
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa

from millrace.llm import minhash
from millrace.llm.shingles import lowered, shingle_hashes, shingle_set


def brute(rows, words, percent):
    """Component of every id, by comparing all pairs."""
    sets = [(i, shingle_set(t, words)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in combinations(sets, 2):
        common = len(a & b)
        if common and 100 * common >= percent * (len(a) + len(b) - common):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def corpus(seed, groups=12, copies=14):
    """Groups of exact and near copies, chains of them, and pairs around the threshold."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randint(1, 120))]
        for _ in range(copies):
            rows.append(" ".join(base))
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = word()
            rows.append(" ".join(text))
            if rng.random() < 0.3:
                base = text  # a chain: ends may be far from its start
    rng.shuffle(rows)
    return [(7 * n + 3, t) for n, t in enumerate(rows)]


def check(spark, documents, rows, settings):
    got = minhash.near_duplicates(spark, documents(rows), settings).collect()
    want = brute(rows, settings.words, settings.percent)
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == want[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])
        assert r["n_shingles"] == len(shingle_set(texts[r["doc_id"]], settings.words))


def test_components_against_all_pairs(spark, documents):
    check(spark, documents, corpus(1), minhash.PRODUCTION)


def test_four_words_and_no_broadcast(spark, documents):
    check(spark, documents, corpus(2, groups=8), minhash.Settings(words=4, broadcast_rows=0))


def test_without_rounds_all_open_pairs_are_compared(spark, documents):
    check(spark, documents, corpus(3, groups=6), minhash.Settings(rounds=0))


def test_odd_rows(spark, documents, clashing):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "two one"), (7, long), (8, long + " more"), (9, "É a b c d e"), (10, "é a b c d e"), (11, "a"), (11, "a")]
    df = clashing(documents([*rows, (None, "one two"), (None, None)]))
    got = minhash.near_duplicates(spark, df)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    of = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == len(rows) + 2
    assert {i: of[i]["component_id"] for i in range(1, 12)} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, 9: 9, 10: 10, 11: 11}
    assert [of[i]["n_shingles"] for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert of[None]["component_id"] is None and of[None]["kept"]
    kept = minhash.keep_one(spark, df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "4", "6", "7", "9", "10", "11", "None", "None"])


def test_empty(spark, documents):
    df = documents([(1, "x")]).where("false")
    assert minhash.near_duplicates(spark, df).count() == 0
    assert minhash.keep_one(spark, df).count() == 0


def test_least_matches():
    """A batch drops a pair only if the posterior leaves less than the chosen probability."""
    s = minhash.PRODUCTION
    for n, m in minhash.least_matches(s):
        at = lambda k: sum(comb(n + 1, i) * 0.8**i * 0.2 ** (n + 1 - i) for i in range(k + 1))  # noqa: B023, E731
        assert at(m) >= s.miss and (m == 0 or at(m - 1) < s.miss)


def test_signature_estimates_similarity():
    a, b = minhash._parameters(2000)
    h, sizes = shingle_hashes(pa.array([" ".join(f"u{i}" for i in range(400)), " ".join(f"u{i}" for i in range(100, 500))]), 1)
    with np.errstate(over="ignore"):
        sigs = [((own[:, None] * a + b) >> np.uint64(32)).min(axis=0) for own in (h[: sizes[0]], h[sizes[0] :])]
    assert abs((sigs[0] == sigs[1]).mean() - 300 / 500) < 0.05


def test_lowered_touches_ascii_only():
    texts = pa.array(["ÀÖ Ab", None, "", "É[Z@"])
    assert lowered(texts).to_pylist() == ["ÀÖ ab", "", "", "É[z@"]
    assert lowered(texts.slice(3)).to_pylist() == ["É[z@"]


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 200)] + [(500 + rng.randrange(60), 500 + rng.randrange(60)) for _ in range(50)]
    got = {r["node"]: r["root"] for r in minhash.components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in range(300):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: r for n, r in root.items() if n != r}

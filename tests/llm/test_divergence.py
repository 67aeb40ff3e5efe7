import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def brute(rows, least=3, top=200):
    counts, groups, docs = defaultdict(Counter), set(), defaultdict(Counter)
    for _, text, lang, source in rows:
        g = (lang or "", source or "")
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        groups.add(g)
        counts[g].update(terms)
        docs[g[0]].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        own = sorted(g for g in groups if g[0] == lang)

        def shares(count):
            total = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // total for t in kept}

        p = {g[1]: shares(counts[g]) for g in own}
        q = shares(sum((counts[g] for g in own), Counter()))
        for g in own:
            a = p[g[1]]
            pairs = [(-sum((a[t] - b[t]) ** 2 // b[t] for t in kept), s.encode(), s) for s, b in p.items() if s != g[1]]
            terms = [(-((a[t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if counts[g][t] and a[t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, g[1], part, item, -v, k + 1) for k, (v, _, item) in enumerate(found)]
    return sorted(out)


def rows():
    rng = random.Random(13)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)] + ["Été", "été", "ÉTÉ", "don't", "日本", "a_b", "x1y", "ABC", "\x00z\x7f", "É"]
    out = []
    for i in range(260):
        source = f"s{min(i % 23, i % 7)}"
        lang = ("en", "de", "é", None)[i % 4 if i % 3 else 0]
        out.append((i, " ".join(rng.choices(words, k=rng.randint(0, 60))), lang, source))
    out += [(900, None, "en", None), (901, "", "en", ""), (902, "!!! 123", "en", "nothing"), (903, "lonely words here", "xx", "one"), (904, "w", "yy", "a"), (905, "w", "yy", "b")]
    out += [(906, "same same", "zz", s) for s in ("a", "b", "b", None)] + [(None, "same", "zz", "a"), (907, "ab " * 300_000, "en", "s0")]
    return out


@pytest.mark.parametrize("shape", [(2048, 64), (16, 4), (7, 1)])
def test_against_brute_force(spark, documents, clashing, shape):
    settings = divergence.Settings(block_terms=shape[0], band_groups=shape[1], slice_bytes=2_000, top_terms=20)
    got = divergence.audit(spark, clashing(documents(rows())), settings).collect()
    assert sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in got) == brute(rows(), top=20)


def test_walk_prices_empty_quadrants_at_once():
    rng = np.random.default_rng(3)
    for _ in range(20):
        rows, columns = rng.integers(1, 9), rng.integers(1, 90)
        counted = np.zeros((8, -(-columns // 8) * 8), dtype=bool)
        counted[:rows, :columns] = rng.random((rows, columns)) < rng.choice([0, 0.02, 0.5])
        zero = rng.integers(1, 50, 8)
        p = np.where(counted, rng.integers(1, 500, counted.shape), zero[:, None])
        tree = divergence.Tree(counted, int(rows), int(columns))
        there, back, priced = divergence.walk(tree, tree, p, p, zero, zero)
        want = np.array([[divergence.excess(p[a, :columns], p[b, :columns]).sum() for b in range(rows)] for a in range(rows)])
        assert (there[:rows, :rows] == want).all() and (back[:rows, :rows] == want.T).all()
        either = counted[:rows, None, :columns] | counted[None, :rows, :columns]
        assert priced == either.sum()


def test_shares_are_exact(spark):
    from pyspark.sql import functions as F

    n, total, terms = 9 * 10**17, 9 * 10**17 + 12_345, 777
    got = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(terms))).first()[0]
    assert got == 1 + 10**9 * (n + 1) // (total + terms)
    assert spark.range(1).select(divergence.share(F.lit(0), F.lit(0), F.lit(0))).first()[0] == 1


def test_empty_table(spark, documents):
    assert divergence.audit(spark, documents([(1, "x")]).where("false")).count() == 0
    assert divergence.audit(spark, documents([(1, None), (2, "")])).count() == 0

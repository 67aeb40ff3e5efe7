import random
import re

from millrace.llm import licenses as L

SCANNER = L.Scanner(L.PRODUCTION, L.TEMPLATES)


def brute(text):
    """All stretches of a text, each compared with all templates and with each other; (license, first word, words)."""
    w = L.plain_words(text or "")
    g = L.grams(w, 3)
    found = []
    for t in SCANNER.templates:
        versions = {x for s in t.shingles for x in s if re.fullmatch(r"v?[0-9][0-9.]*", x)}
        for a in [i for i, x in enumerate(g) if x in t.shingles]:
            held = set(g[a : a + t.step]) & t.shingles
            if len(held) / len(t.shingles) >= 0.8 and versions <= {x for s in held for x in s}:
                n = next(n for n in range(1, t.step + 1) if held <= set(g[a : a + n]))
                found.append((-len(held) / len(t.shingles), -len(held), n + 2, a, t.license, t.number))
    kept = []
    for f in sorted(found):
        if all(f[3] + f[2] <= o[3] or o[3] + o[2] <= f[3] for o in kept):
            kept.append(f)
    return sorted((f[4], f[3], f[2]) for f in kept)


def texts():
    rng = random.Random(8)
    words = [f"word{i}" for i in range(500)] + "the license of this software is under and".split()
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    out = []
    for own in L.TEMPLATES.values():
        for t in own:
            parts = t.split()
            for place in (0, 3, 50, 1000):
                out.append(f"{some(place)} {t}\n{some(rng.randrange(60))}")
                cut = list(parts)
                cut[rng.randrange(len(cut))] = "changed"
                out.append(f"{some(place)} {' '.join(cut)} {some(20)}")
                out.append(f"{some(place)} {' '.join(parts[: len(parts) // 2])} {some(9)}")
    out += [some(3000) for _ in range(5)]
    return out


def test_against_brute_force(spark, documents, clashing):
    rows = list(enumerate(texts()))
    found = {}
    for r in L.scan(spark, clashing(documents(rows))).collect():
        found.setdefault(r["doc_id"], []).append((r["license"], r["first_word"], r["n_words"]))
        assert r["containment"] >= L.PRODUCTION.least
    for i, t in rows:
        assert sorted(found.get(i, [])) == brute(t)
    assert all(i not in found for i, _ in rows[-5:])


def test_every_notice_is_its_own_license(spark, documents):
    cases = [(name, t) for name, own in L.TEMPLATES.items() for t in own]
    got = L.scan(spark, documents([(i, f"some words before. {t} And some words after.") for i, (_, t) in enumerate(cases)])).collect()
    assert sorted((r["doc_id"], r["license"], r["containment"]) for r in got) == [(i, name, 1.0) for i, (name, _) in enumerate(cases)]
    assert len(L.TEMPLATES) >= 25


def test_every_separate_stretch(spark, documents):
    mit, lesser = L.TEMPLATES["MIT"][2], L.TEMPLATES["LGPL-2.1"][0]
    near = " ".join(f"w{i}" for i in range(600))
    rows = [(1, f"{mit} {near} {mit}"), (2, f"{mit} {mit} {lesser}"), (3, lesser.replace("2.1", "7")), (4, "Licensed under the Apache License, Version 1.1.")]
    got = sorted((r["doc_id"], r["first_word"], r["license"]) for r in L.scan(spark, documents(rows)).collect())
    n = len(L.plain_words(mit))
    assert got == [(1, 0, "MIT"), (1, n + 600, "MIT"), (2, 0, "MIT"), (2, n, "MIT"), (2, 2 * n, "LGPL-2.1")]


def test_places(spark, documents):
    got = L.scan(spark, documents([(1, "one two three RELEASED  under the\tMIT License!!! four"), (2, "released under the"), (3, None), (4, ""), (5, "-- ** --")])).collect()
    assert [(r["doc_id"], r["license"], r["containment"], r["first_word"], r["n_words"]) for r in got] == [(1, "MIT", 1.0, 3, 5)]


def test_band_settings_guarantee_collisions():
    assert min(L.collision(L.PRODUCTION, t, SCANNER.bands) for t in SCANNER.templates) >= 1 - L.PRODUCTION.miss


def test_very_long_and_empty(spark, documents):
    text = "word " * 100_000 + "Licensed under the Apache License, Version 2.0. " + "word " * 100_000
    got = L.scan(spark, documents([(1, text), (1, text)])).collect()
    assert [(r["license"], r["first_word"]) for r in got] == [("Apache-2.0", 100_000)] * 2
    assert L.scan(spark, documents([(1, text)]).where("false")).count() == 0

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import quality_rules as q


def measured(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    places = {i + k for i, g in enumerate(windows) if often[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(places), len(lines)


def rows(df):
    return [tuple(r[m] for m in q.MEASURES) for r in sorted(df.collect(), key=lambda r: r["doc_id"])]


CASES = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x\nx\n\ny\nx", "é " * 60, "a " * 20_000, "# | <b>\n" * 9, "\x0b\x0ca\r\nb", "日本 語 x"]


def test_measures(documents):
    assert rows(q.ledger(documents([(i, t) for i, t in enumerate(CASES)]))) == [measured(t) for t in CASES]


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(st.text("ab \n#é \U0001f600", max_size=120), min_size=1, max_size=8))
def test_measures_of_any_text(documents, texts):
    assert rows(q.ledger(documents([(i, t) for i, t in enumerate(texts)], 1))) == [measured(t) for t in texts]


def test_policies_and_ablation(documents):
    clean = " ".join(f"word{i}" for i in range(80))
    df = documents([(0, clean), (1, clean), (2, "short"), (3, "a b c " * 40), (4, clean + " ### ###" * 20), (5, None)])
    entries = q.ledger(df)
    verdicts = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in q.apply_policy(entries).collect()}
    assert verdicts == {0: (False, True), 1: (False, True), 2: (True, False), 3: (True, False), 4: (False, False), 5: (True, False)}
    for r in q.ablation(entries).collect():
        p = q.policy(r["version"])
        without = q.mask(tuple(x for x in p.rules if x != r["rule"]))
        bits = [e["fail_bits"] for e in entries.collect()]
        assert r["n_docs"] == 6
        assert r["n_rejected"] == sum(b & q.mask(p.rules) != 0 for b in bits)
        assert r["kept_without"] == sum(b & without == 0 for b in bits)


def test_stored_ledger(spark, documents):
    clean = " ".join(f"word{i}" for i in range(80))
    df = documents([(0, clean), (0, clean), (1, "short"), (None, clean + " #" * 10), (2, None)])
    entries = q.store(spark, df)
    assert entries.inputFiles() and not entries.where("false").count()
    got = q.verdicts(entries).collect()
    assert sorted(map(str, got)) == sorted(map(str, q.verdicts(q.ledger(df)).collect()))
    for r in got:
        assert [r[f"kept_{p.version}"] for p in q.POLICIES] == [r["fail_bits"] & q.mask(p.rules) == 0 for p in q.POLICIES]
    assert [(r["kept_v1"], r["kept_v2_strict"]) for r in got if r["doc_id"] is None] == [(True, False)]
    assert q.ablation(q.store(spark, df.where("false"))).count() == 0


def test_keep(documents, clashing):
    clean = " ".join(f"word{i}" for i in range(80))
    df = clashing(documents([(0, clean), (0, clean), (1, "short"), (None, clean), (2, None)]))
    kept = q.keep(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["0", "0", "None"]
    assert q.keep(df.where("false")).count() == 0
    assert q.ablation(q.ledger(df.where("false"))).count() == 0

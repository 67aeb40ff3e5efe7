import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
CHARS = st.text(st.sampled_from(list("ab \t\n\x0b<>PSM\x00é日\U0001f600  ")), max_size=40)


def brute(doc_id, text, seed="42", rate=50, first=80):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    assert "".join(units) == text
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    i, j = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    form = "spm" if h[3] % 100 < first else "psm"
    return len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(CHARS)
def test_index_converts_both_ways(text):
    data = text.encode()
    index = fim.ExceptionIndex(np.frombuffer(data, dtype=np.uint8))
    chars = np.arange(len(text) + 1)
    places = np.array([len(text[:k].encode()) for k in chars])
    assert index.bytes(chars).tolist() == places.tolist()
    assert index.chars(places).tolist() == chars.tolist()
    assert len(index) == sum(ord(c) > 127 for c in text)


@settings(max_examples=200, deadline=None)
@given(st.lists(CHARS, max_size=6))
def test_units(texts):
    data = [t.encode() for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    ends, n = fim.unit_ends(np.frombuffer(b"".join(data), dtype=np.uint8), starts)
    want = [UNIT.findall(t) for t in texts]
    assert n.tolist() == [len(u) for u in want]
    flat = [len(x.encode()) for u in want for x in u]
    assert ends.tolist() == np.cumsum(flat).tolist()


def rows():
    texts = ["", None, " ", "\t\n", "one", " one", "one ", "a b c d e f g", "é 日本 x y \U0001f600", "holds <P> a mark", "<S>", "< P> <P <", "<S <M P> >"]
    out = [(i, texts[i % len(texts)]) for i in range(300)]
    out += [(None, "no id at all"), (None, None), (5, "again again"), (5, "again again"), (900, "wörd " * 200_000), (901, "x" * 3_000_000), (902, " <" * 100_000)]
    return out


def test_against_brute_force(spark, documents, clashing):
    data = rows()
    got = fim.transform(spark, clashing(documents(data))).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    want = sorted(((str(i), *brute(i, t)) for i, t in data), key=str)
    assert sorted(((str(r[0]), *r[1:6]) for r in got), key=str) == want
    assert sorted(r["back"] for r in got) == sorted(t or "" for _, t in data)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


@settings(max_examples=25, deadline=None)
@given(st.lists(CHARS, min_size=1, max_size=30))
def test_every_cut_text_comes_back(spark, documents, texts):
    every = fim.Settings(rate=100, suffix_first=50)
    data = list(enumerate(texts))
    got = fim.transform(spark, documents(data, 1), every).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert {r["doc_id"]: r["back"] for r in got} == dict(data)
    assert {r["doc_id"]: r["output"] for r in got} == {i: brute(i, t, rate=100, first=50)[4] for i, t in data}


def test_empty_table(spark, documents):
    assert fim.transform(spark, documents([(1, "x")]).where("false")).count() == 0

import os
from dataclasses import replace
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from millrace.llm import langid

SF = "/root/testdata/sf0.001"


def test_forward_sums_all_segmentations():
    pieces = sorted(["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "c"])
    probs = np.linspace(0.02, 0.2, len(pieces))[:, None]
    of = dict(zip(pieces, probs[:, 0], strict=True))

    def every(word):
        if not word:
            return 1.0
        total = 0.0
        for k in range(1, len(word) + 1):
            p = of.get(word[:k], 1e-9 if k == 1 else 0.0)
            total += p * every(word[k:]) if p else 0.0
        return total

    words = ["a", "ab", "abab", "bca", "xay", "", "b" * 24, "aß"]
    got = langid.log_likelihood(langid.Lattice(pieces), words, probs, 1e-9)[:, 0]
    for w, value in zip(words, got, strict=True):
        marked = langid.START + w
        want = sum(log(every(marked[k : k + langid.PART])) for k in range(0, len(marked), langid.PART))
        assert abs(value - want) < 1e-9


def test_expected_counts_sum_to_segments():
    """Weighted by how likely each segmentation is: of 'ab' as 'ab' or 'a', 'b'."""
    pieces = ["a", "ab", "b", "▁"]
    probs = np.array([0.3, 0.2, 0.1, 0.4])
    whole, parts = 0.2, 0.3 * 0.1
    got = langid.expected_counts(langid.Lattice(pieces), ["ab"], np.array([2.0]), probs, 1e-9)
    share = whole / (whole + parts)
    assert np.allclose(got, [2 * (1 - share), 2 * share, 2 * (1 - share), 2.0])


LANGUAGES = {
    "en": "the of and that with this from which there would about their other because should through where people",
    "de": "der und nicht eine durch werden zwischen können über während möchte schließlich wieder immer gegen straße",
    "fr": "les des une avec pour dans être était même très beaucoup toujours après leurs quelque nouveau français",
}


def corpus():
    rng = np.random.default_rng(3)
    out = []
    for k, (lang, words) in enumerate(LANGUAGES.items()):
        out += [(100 * k + i, " ".join(rng.choice(words.split(), 40)), lang) for i in range(40)]
    return out


def test_predict(spark, documents, clashing):
    rows = corpus()
    odd = [(901, None), (902, ""), (903, "123 %% 4"), (904, "x" * 5000), (905, "the people of"), (906, "日本語")]
    df = clashing(documents([*rows, *odd, rows[0]]))
    model = langid.fit(spark, df, learn=~langid.held_out())
    assert model.languages == ("de", "en", "fr")
    assert np.allclose(model.probs.sum(axis=0), 1, atol=1e-6)
    got = {r["doc_id"]: r for r in langid.predict(spark, df, model).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows)
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (901, 902, 903))
    assert got[905]["lang_pred"] == "en" and got[904]["lang_pred"] in model.languages
    assert all(0 <= r["score"] <= 1 for r in got.values())
    kept = langid.keep(spark, df, model)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert not {901, 902, 903} & set(ids) and {i for i, *_ in rows} <= set(ids) and ids.count(0) == 2


FOREIGN = [
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью. " * 5,
    "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. " * 5,
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. " * 5,
    "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione. " * 5,
]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_long_texts_in_no_learned_language_are_dropped(spark, documents):
    import corpus_pipeline

    rng = np.random.default_rng(5)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    garbled = [" ".join("".join(rng.choice(letters, rng.integers(2, 11))) for _ in range(60)) for _ in range(20)]
    planted = list(enumerate([*FOREIGN, *garbled], 10**9))
    docs = corpus_pipeline.quality(spark, spark.read.parquet(f"{SF}/documents.parquet").select(*documents(planted).columns), SF)
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs.union(documents(planted)), SF).select("doc_id").collect()}
    assert not kept & {i for i, _ in planted}
    assert len(kept) >= 0.99 * docs.count()


def test_nothing_learned(spark, documents):
    df = documents([(1, "some words", None), (2, None, "en")])
    model = langid.fit(spark, df)
    assert [r["lang_pred"] for r in langid.predict(spark, df, model).collect()] == ["und", "und"]
    assert langid.predict(spark, df.where("false"), model).count() == 0


def test_a_worker_that_forgets_words(spark, documents):
    """A small memory for words changes nothing."""
    df = documents(corpus())
    model = langid.fit(spark, df)
    small = langid.Model(model.languages, model.pieces, model.probs, langid.Settings(known_words=7))
    a, b = (sorted(map(str, langid.predict(spark, df, m).collect())) for m in (model, small))
    assert a == b


def test_bounds_and_model_come_from_all_rows(spark, documents):
    """A bound of two documents a language is for the sample that ``fit`` may learn from, never for thresholds."""
    rows = [(i, t * (1 + i % 3) + f" {'zq' * (i % 7)}", lang) for i, t, lang in corpus()]
    df = documents([*rows, (990, None, "en"), (991, "the people", None)])
    few = langid.Settings(docs_per_lang=2, lowest=0.1, least_margin=0.0)
    model = langid.fit(spark, df, settings=langid.Settings(docs_per_lang=None, lowest=0.1, least_margin=0.0))
    usual = langid.fit(spark, df)  # no language has more rows than its sample
    assert np.allclose(model.probs, usual.probs, atol=1e-9)
    best, _, mean = langid.Scorer(model)(pa.array([t for _, t, _ in rows]))
    own = best == np.array([model.languages.index(lang) for *_, lang in rows])
    got = pd.DataFrame({"lang": best[own], "mean": mean[own]})
    middle = got.groupby("lang")["mean"].median()
    margin = few.margins * (got["lang"].map(middle) - got["mean"]).quantile(0.9)
    bounded = langid.with_bounds(spark, df, replace(model, settings=few))
    assert np.allclose(bounded.bounds, [middle[k] - margin for k in range(len(model.languages))], rtol=0, atol=1e-9)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_held_out_accuracy(spark):
    from millrace.llm.queries import QUERIES

    got = QUERIES["op1_language_id"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    held = got[got["held_out"]]
    right = (held["lang_pred"].to_numpy() == docs.loc[held["doc_id"], "lang"].to_numpy()).mean()
    assert len(got) == len(docs) and right > 0.97

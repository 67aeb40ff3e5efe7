import random

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import tokens

TOKENIZER = tokens.load(public_tokenizers.path(tokens.PRODUCTION.tokenizer))
BITS = ["the ", "é", "é ", "\n", "  ", "<|endoftext|>", "<|end", "oftext|>", "don't ", "42 ", "%%% ", "日本 ", "ab", " ", "́x", " ́", "'s", "\U0001f600 ", "İ ", "Σς "]


def encode(text):
    got = TOKENIZER.encode(text, add_special_tokens=False)
    return got.ids, got.offsets


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=150).map("".join), st.sampled_from([(40, 8), (64, 4), (20, 10), (33, 33)]))
def test_chunks_give_the_counts_of_the_whole(text, size):
    s = tokens.Settings(chunk=size[0], overlap=size[1])
    assert tokens.count_long(text, encode, s)[0] == len(encode(text)[0])


def test_overlaps_widen_without_white_space():
    text = "a" * 500 + " b" * 300
    n, chunks, widened = tokens.count_long(text, encode, tokens.Settings(chunk=64, overlap=8))
    assert n == len(encode(text)[0]) and chunks > 5 and widened > 0


PIECES = ["the", "The", "DON'T", "'s", "'S", "it's", "'tis", "l'eau", "42", "a1b2", "...", "(x)", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "é", "ÀB", "\x1c", "\x7f", "don't.'ve", "''", "_a_", "-"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), min_size=1, max_size=5).map("".join), min_size=1, max_size=20))
def test_words_are_the_sums_of_their_pieces(words):
    counts = tokens.WordCounts(TOKENIZER)
    assert counts.splits
    want = [len(encode(w)[0]) for w in words]
    assert counts(words).tolist() == want and counts(words).tolist() == want
    texts = [" ".join(words), "", None, "\t".join(words) + "\n"]
    each, _, owner = tokens.counted_words(pa.array(texts), counts)
    assert [int(each[owner == i].sum()) for i in range(4)] == [len(encode(t or "")[0]) for t in texts]


class Recorded:
    """The tokenizer, and what its model and its whole encoding were asked for."""

    def __init__(self):
        self.asked, self.whole = [], []
        self.model, self.normalizer, self.pre_tokenizer = self, TOKENIZER.normalizer, TOKENIZER.pre_tokenizer

    def tokenize(self, piece):
        self.asked.append(piece)
        return TOKENIZER.model.tokenize(piece)

    def encode_batch_fast(self, words, add_special_tokens):
        self.whole += words
        return TOKENIZER.encode_batch_fast(words, add_special_tokens=add_special_tokens)


def test_a_spelling_of_a_known_word_is_not_encoded_again():
    made = Recorded()
    text = "thin thin. thin,&&& thin%%% THIN! schön schön. Schön, книга книга; don't don't. \u00e9t\u00e9,x"
    each, *_ = tokens.counted_words(pa.array([text, " ", None]), tokens.WordCounts(made))
    assert int(each.sum()) == len(encode(text)[0])
    assert made.whole == [] and len(made.asked) == len(set(made.asked)) and made.asked.count("thin") == 1


def test_what_was_met_last_stays_known():
    made = Recorded()
    counts = tokens.WordCounts(made)
    counts.KNOWN_WORDS = 8
    for n in range(50):
        counts(["the", "word" + "abcdefghij"[n % 10] * (1 + n // 10)])
        assert len(counts.known) + len(counts.older) <= 8
    assert made.asked.count("the") == 1 and len(made.asked) == 51


def test_every_letter_is_one_to_the_tokenizer():
    spell = TOKENIZER.pre_tokenizer.pre_tokenize_str
    for c in tokens.LETTERS:
        assert len(spell(f"a{c}b")) == 1 and TOKENIZER.normalizer.normalize_str(f"a{c}.") == f"a{c.lower()}."
    words = [f"{a}{c}{b}" for c in tokens.LETTERS for a, b in (("", ""), ("x", "'s"), ("7", "é."), ("(", "\u0301"), ("", "\u0323,"))]
    assert tokens.WordCounts(TOKENIZER)(words).tolist() == [len(encode(w)[0]) for w in words]


SPELT = ["a", "É", "ß", "q", "İ", "ŉ", "Ж", "й", "Σ", "日", "'", "'s", "’", ".", "<", "=", "|", "7", "½", "ª", "\u0301", "\u0338", "\u0323", "\xa0", "\x85", "\x1c", "\u200b", " ", "\n"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(SPELT), max_size=40).map("".join), min_size=1, max_size=5))
def test_parts_of_words_make_the_counts_of_texts(texts):
    each, _, owner = tokens.counted_words(pa.array(texts), tokens.WordCounts(TOKENIZER))
    assert [int(each[owner == i].sum()) for i in range(len(texts))] == [len(encode(t)[0]) for t in texts]


DENSE = ["日本語", "文章", "。", "，", "a", "B", "7", "=", "+", "/", "́", "²", "é", "'s", "'", "x,y", "(", "½", "\u0338", "K", "ﬁ"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(DENSE), min_size=10, max_size=200).map("".join), st.sampled_from([(40, 8), (16, 4)]))
def test_chunks_without_white_space(text, size):
    assert tokens.count_long(text, encode, tokens.Settings(chunk=size[0], overlap=size[1]))[0] == len(encode(text)[0])


@pytest.mark.parametrize("unit", ["漢字仮名交文", "漢字仮名交文。", "Ab3/xYz+"])
def test_work_is_in_proportion_without_white_space(unit):
    """Characters encoded in all, against those of one call: no machine's speed is in the figure."""
    done, text = [], unit * 60_000

    def counted(part):
        done.append(len(part))
        return encode(part)

    assert tokens.count_long(text, counted)[0] == len(encode(text)[0])
    assert sum(done) <= 3 * len(text)


def test_table(spark, documents, clashing):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice(BITS) for _ in range(rng.randint(0, 300)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "word " * 30_000), (103, "a b"), (103, "a b"), (None, "c")]
    got = tokens.count_tokens(spark, clashing(documents(rows)), tokens.Settings(chunk=500, overlap=16)).collect()
    want = sorted((str(i), len((t or "").encode()), len(encode(t or "")[0])) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)
    assert tokens.count_tokens(spark, documents([(1, "x")]).where("false")).count() == 0


def test_tokenizers_that_keep_white_space_are_refused():
    with pytest.raises(ValueError, match="white space"):
        tokens.load(public_tokenizers.path("byte_bpe_50k.json"))

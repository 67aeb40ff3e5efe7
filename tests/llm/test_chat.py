from pyspark.sql import functions as F

from millrace.llm import chat


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def test_three_parties(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello"), (1, 3, "cy", None), (1, 4, "ann", "<|end|> of it")]
    df = turns(spark, rows).withColumns({"turns": F.lit(1), "pieces": F.lit(2), "speaker": F.lit(3), "part": F.lit(4)})
    got = {r["speaker"]: r for r in chat.rotate(df).collect()}
    assert set(got) == {"ann", "bob", "cy"}
    assert got["ann"]["rendered"] == (
        "<|system|>\nbe kind<|end|>\n<|assistant|>\nhi<|end|>\n<|user name=bob|>\nhello<|end|>\n"
        "<|user name=cy|>\n<|end|>\n<|assistant|>\n< |end|> of it<|end|>\n"
    )
    learned = {s: [r["rendered"][x["start"] : x["end"]] for x in r["spans"]] for s, r in got.items()}
    assert learned == {"ann": ["hi<|end|>", "< |end|> of it<|end|>"], "bob": ["hello<|end|>"], "cy": ["<|end|>"]}
    assert all(r["n_turns"] == 5 for r in got.values())


def test_odd_rows(spark):
    rows = [(1, 0, "system", "alone"), (2, 1, None, "who"), (2, 0, "a", "x"), (2, 0, "a", "x"), (None, 0, "a", "p"), (None, 0, "b", "q"), (None, None, None, None), (3, None, "a", "late"), (3, 5, "a", "é\U0001f600")]
    got = sorted((str(r["conv_id"]), str(r["speaker"]), r["n_turns"], [r["rendered"][s["start"] : s["end"]] for s in r["spans"]]) for r in chat.rotate(turns(spark, rows)).collect())
    assert got == [
        ("1", "None", 1, []),
        ("2", "a", 3, ["x<|end|>", "x<|end|>"]),
        ("3", "a", 2, ["é\U0001f600<|end|>", "late<|end|>"]),
        ("None", "None", 1, []),
        ("None", "a", 1, ["p<|end|>"]),
        ("None", "b", 1, ["q<|end|>"]),
    ]
    assert chat.rotate(turns(spark, rows).where("false")).count() == 0


def test_turn_numbers_do_not_cut_a_dialogue(spark):
    rows = [(1, 0, "a", "x"), (1, 5_000, "b", "y"), (1, 9_000, "a", "z"), (2, 2**40, "a", "p"), (2, -(2**62), "b", "q")]
    got = chat.rotate(turns(spark, rows)).collect()
    assert sorted((r["conv_id"], r["speaker"], r["part"], r["n_turns"]) for r in got) == [(1, "a", 0, 3), (1, "b", 0, 3), (2, "a", 0, 2), (2, "b", 0, 2)]


def test_long_conversations_come_in_parts(spark):
    rows = [(1, 7 * i, "ab"[i % 2], f"t{i}") for i in range(250)] + [(2, i, "a", f"s{i}") for i in range(20)]
    got = chat.rotate(turns(spark, rows), chat.Settings(part_chars=1000)).collect()
    whole = {(r["conv_id"], r["speaker"]): r["rendered"] for r in chat.rotate(turns(spark, rows)).collect()}
    for key in ((1, "a"), (1, "b"), (2, "a")):
        parts = sorted((r["part"], r["rendered"], r["n_turns"], r["spans"]) for r in got if (r["conv_id"], r["speaker"]) == key)
        assert "".join(p[1] for p in parts) == whole[key]
        assert [p[0] for p in parts] == list(range(len(parts))) and len(parts) == (3 if key[0] == 1 else 1)
        own = [rendered[x["start"] : x["end"]] for _, rendered, _, spans in parts for x in spans]
        assert own == [f"{t}<|end|>" for c, _, s, t in rows if (c, s) == key]


def test_ties_and_very_long_texts(spark):
    rows = [(1, 1, r, t) for r in ("b", "a", None, "system") for t in ("y", "x", "x", None)] + [(2, 0, "a", "é" * 3_000_000), (2, 1, "b<|", "z"), (2, 2, "b<|", "z" * 9)]
    rows += [(3, i, "a", "") for i in range(20_000)]  # many turns, little text
    got = {(r["conv_id"], r["speaker"], r["part"]): r for r in chat.rotate(turns(spark, rows)).collect()}
    assert set(got) == {(1, "a", 0), (1, "b", 0), (2, "a", 0), (2, "a", 2), (2, "b<|", 0), (2, "b<|", 2), (3, "a", 0)}
    cut = lambda r: [r["rendered"][x["start"] : x["end"]] for x in r["spans"]]
    assert cut(got[1, "b", 0]) == ["<|end|>", "x<|end|>", "x<|end|>", "y<|end|>"] and got[1, "b", 0]["n_turns"] == 16
    assert got[1, "b", 0]["rendered"].startswith("<|user|>\n<|end|>\n<|user|>\nx<|end|>\n")
    assert cut(got[2, "b<|", 2]) == ["z<|end|>", "z" * 9 + "<|end|>"] and cut(got[2, "a", 0]) == ["é" * 3_000_000 + "<|end|>"]
    assert got[3, "a", 0]["n_turns"] == 20_000 and set(cut(got[3, "a", 0])) == {"<|end|>"}

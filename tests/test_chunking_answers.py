from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.operators import answers as W
from inkwell.operators import chunking as K
from inkwell.plans.registry import queries


def test_greedy_packing_example(spark):
    got = spark.range(1).select(K.pack_ids(F.lit([150, 200, 100, 500, 30, 370, 1]), 400).alias("x")).first().x
    assert got == [0, 0, 1, 2, 3, 3, 4]


def test_sentence_pieces(spark):
    t = "aaaa aaaa. bbbb bbbb bbbb. cccc."
    got = spark.createDataFrame([(t,)], "t string").select(K.sentence_pieces(F.col("t"), 5).alias("x")).first().x
    assert got == ["aaaa aaaa. bbbb bbbb bbbb.", "cccc."]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab .\n", min_size=1, max_size=40), min_size=1, max_size=40), st.integers(3, 30))
def test_window_pieces_keep_the_budget(parts, budget):
    text = " ".join(parts)
    pieces = K.window_pieces(text, budget, 2)
    words = text.split()
    bare = lambda t: {w.strip(".") for w in t.split()} - {""}
    assert bare(text) <= bare(" ".join(pieces))
    if all(K.n_tokens(w + " ") * 2 + 2 <= budget for w in words):
        assert all(K.n_tokens(p) <= budget + 2 for p in pieces)


def test_navigation_and_headings():
    assert K.without_navigation("Title Short\nPrevious Document\nThe Tribunal met.\nBody\ncontents\n") == "The Tribunal met.\nBody"
    got = K.headed_pieces("before it\nPART II\nfirst text here\nCHAPTER 3\nmore")
    assert got == ["before it", "PART II\nfirst text here", "CHAPTER 3\nmore"]


def test_packed_turns_and_the_finished_table(spark):
    turns = spark.createDataFrame(
        [(1, 0, "A", "x" * 1200, 5), (1, 1, None, "y" * 600, None), (1, 2, "B", " ", 6), (1, 3, "B", None, 6), (2, 0, "", "z", None)],
        "doc long, turn_no int, speaker string, text string, page int",
    )
    got = K.packed_turns(turns).orderBy("doc", "chunk_index").collect()
    assert [(r.doc, r.chunk_index, r.n_turns, r.tokens, r.page) for r in got] == [(1, 0, 1, 300, 5), (1, 1, 1, 150, None), (2, 0, 1, 1, None)]
    docs = spark.createDataFrame([(1, "h/a.asp", "1946-01-02", "sessions"), (2, "h/b.asp", None, "sessions")], "doc long, url string, date_iso string, collection string")
    rows = K.finished(K.packed_turns(turns), docs).orderBy("chunk_id").collect()
    assert [r.chunk_id for r in rows] == ["sessions::a::0000", "sessions::a::0001", "sessions::b::0000"]
    assert rows[0].total_chunks == 2 and rows[0].text.startswith("[Date: 1946-01-02 | Source: a | Speaker: A | Collection: sessions | Page: 5]\nA: x")


def check(spark, answer, n):
    return W.verified(spark.createDataFrame([(1, answer, n)], "id int, answer string, num_sources int")).first()


def test_citations(spark):
    r = check(spark, "[[SOURCE 1]] and (SOURCE 2, p. 5) plus SOURCE 3. [SOURCE 9]", 3)
    assert r.verified == "[SOURCE 1] and [SOURCE 2] plus [SOURCE 3]." and r.cited == [1, 2, 3] and r.hallucinated == [9] and not r.clean
    assert check(spark, "A [SOURCE 1] b [SOURCE 1] c", 1).verified == "A  b [SOURCE 1] c"
    long = "x" * 150
    r = check(spark, f"{long}\n\nshort [SOURCE 1]\n\nSources cited: none and a lot of other words that do not count", 2)
    assert r.uncited_paragraphs == ["x" * 120 + "..."] and r.uncited_sources == [2]
    r = check(spark, None, 0)
    assert r.verified == "" and r.clean and r.cited == []


def test_context_budget(spark):
    df = spark.createDataFrame([(1, "c", None, "", 0, "s", "b" * 50), (2, "c", "1946", "X", 3, "s", "d" * 900), (3, "c", "1946", "X", 3, "s", "never")], "n int, c string, d string, sp string, p int, s string, b string")
    block = W.source_block(*[F.col(x) for x in ("n", "c", "d", "sp", "p", "s", "b")])
    blocks = F.transform(F.sort_array(F.collect_list(F.struct("n", block.alias("b")))), lambda x: x["b"])
    got = df.agg(blocks.alias("x")).select(W.context_block(F.col("x"), 100).alias("t")).first().t
    assert got.startswith("[SOURCE 1 | c | date unknown | speaker: - | page: ? | slug: s]\nbbb") and got.endswith("...  [truncated]") and "never" not in got


def test_answers_hold_whole_passages(spark, tmp_path):
    body = " ".join(f"word{i}" for i in range(100))
    spark.createDataFrame([(1, body), (2, None)], "chunk_row long, body string").write.parquet(str(tmp_path / "chunks.parquet"))
    got = {r.id: r.verified for r in queries()["cited_answers"](spark, str(tmp_path)).collect()}
    assert body in got[1] and got[2] == ""

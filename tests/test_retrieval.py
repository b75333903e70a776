from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from inkwell.operators import retrieval as R


def ranks(spark, rows):
    return spark.createDataFrame(rows, "qid int, did string, rk int")


def test_rank_fusion_example_and_tie(spark):
    f = R.fused(ranks(spark, [(1, "A", 1), (1, "B", 2), (1, "C", 3)]), ranks(spark, [(1, "B", 1), (1, "D", 2)]), 25)
    got = [(r.did, r.rrf) for r in f.orderBy("rk").collect()]
    assert got == [("B", round(1 / 62 + 1 / 61, 12)), ("A", round(1 / 61, 12)), ("D", round(1 / 62, 12)), ("C", round(1 / 63, 12))]
    tie = R.fused(ranks(spark, [(1, "A", 1)]), ranks(spark, [(1, "B", 1)]), 25)
    assert [r.did for r in tie.orderBy("rk").collect()] == ["A", "B"]


def test_dense_equals_brute_force_in_blocks(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(57, 8)).round(2)
    v[10] = v[11]  # a tie
    df = spark.createDataFrame([(i, v[i].tolist()) for i in range(57)] + [(99, None)], "id long, vec array<double>")
    got = {(r.qid, r.rk): r.did for r in R.dense_topk(df.where("id % 5 = 0"), df, 4, block=10).collect()}
    for q in range(0, 57, 5):
        s = np.round(v @ v[q], 6)
        want = sorted(range(57), key=lambda i: (-s[i], i))[:4]
        assert [got[q, k + 1] for k in range(4)] == want
    assert R.dense_topk(df.where("id < 0"), df, 4).count() == 0


def test_dense_of_many_queries_keeps_vectors_as_bytes(spark):
    v = np.random.default_rng(2).integers(-2, 3, size=(2600, 6)) / 3  # many ties
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, vec array<double>")
    found = R.dense_topk(df.where("id % 2 = 0"), df, 7, block=500)
    plan = found._jdf.queryExecution().toString()
    assert "collect_list" not in plan  # no block is gathered as rows of a heap
    got = {(r.qid, r.rk): (r.did, r.score) for r in found.collect()}
    s = np.round(v @ v.T, 6)
    for q in range(0, 2600, 2):
        best = np.lexsort((np.arange(2600), -s[q]))[:7]
        assert [got[q, k + 1] for k in range(7)] == [(d, s[q, d]) for d in best]
    assert len(got) == 1300 * 7


def test_sparse_drops_zero_scores(spark):
    q = spark.createDataFrame([("x", 1, 2), ("y", 1, 1)], "token string, id int, w int")
    d = spark.createDataFrame([("x", 7, 3), ("z", 8, 3)], "token string, id int, w int")
    assert [(r.did, r.score, r.rk) for r in R.sparse_topk(q, d, 5).collect()] == [(7, 6, 1)]


def test_max_pooling(spark):
    rows = [(1, 5, "a", 0.2), (1, 5, "a", 0.7), (1, 9, " a", 0.1), (1, 3, "b", -1.0), (1, 4, " ", 3.0)]
    got = R.max_pooled(spark.createDataFrame(rows, "id int, token_id int, token string, w double")).collect()
    assert [(r.id, r.token, r.w) for r in got] == [(1, "a", 0.1)]


def test_sparse_scores_few_of_many_texts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    words = np.array(["the", "of", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400))])
    odds = 1 / np.arange(3, 405)
    long = rng.lognormal(2.5, 0.8, 2600).astype(int) + 1
    texts = [(i, " ".join(rng.choice(words, n, p=odds / odds.sum()))) for i, n in enumerate(long)]
    p = R.token_counts(spark.createDataFrame(texts, "id long, text string")).persist()
    w = np.zeros((2600, 403))
    known = {t: i for i, t in enumerate(words)}
    for r in p.collect():
        w[r.id, known[r.token]] = r.w
    got = {(r.qid, r.rk): (r.did, r.score) for r in R.sparse_topk(p.where("id % 2 = 0"), p, 7, block=600).collect()}
    s = w @ w.T
    for q in range(0, 2600, 2):
        best = np.lexsort((np.arange(2600), -s[q]))[:7]
        assert [got[q, k + 1] for k in range(7) if s[q, best[k]] > 0] == [(d, s[q, d]) for d in best if s[q, d] > 0]
    # of one block's pairs the bounds leave a small part to be scored
    rows = [(t, i, int(w[i, known[t]]), k == 0) for i in range(2600) for k, t in enumerate(words[np.flatnonzero(w[i, :402])])]
    table = pa.table({"token": [r[0] for r in rows], "id": [r[1] for r in rows], "w": [r[2] for r in rows], "first": [int(r[3]) for r in rows]})
    scored, score = [], R._SparseBlock._score
    monkeypatch.setattr(R._SparseBlock, "_score", lambda self, q, y, *x: scored.append(len(y)) or score(self, q, y, *x))
    block = R._SparseBlock(*R._pack_texts(table), k=7, whole=True)
    block.meet(*R._pack_texts(table))
    assert len(block.result()[0]) == 2600 * 7 and sum(scored) < 0.4 * 2600 * 2600


def test_sparse_counts_all_tokens_as_brute_force_does(spark):
    rng = np.random.default_rng(4)
    words = ["letter", "witness", "the"] + ["w" + "abcdefghij"[i] * 2 for i in range(10)]
    texts = [(i, " ".join(rng.choice(words, 12, p=[0.2, 0.2, 0.2] + [0.04] * 10))) for i in range(60)] + [(97, None), (98, "?!"), (99, "LETTER letter")]
    p = R.token_counts(spark.createDataFrame(texts, "id long, text string"))
    counts = {i: Counter((t or "").lower().split()) for i, t in texts if t != "?!"}
    assert {(r.id, r.token, r.w) for r in p.collect()} == {(i, t, n) for i, c in counts.items() for t, n in c.items()}
    for block in (8, 4000):
        got = {(r.qid, r.rk): (r.did, r.score) for r in R.sparse_topk(p.where("id % 3 = 0"), p, 5, block).collect()}
        want = {}
        for q in [i for i in counts if i % 3 == 0]:
            s = sorted(((-sum(n * c[t] for t, n in counts[q].items()), d) for d, c in counts.items()))
            want |= {(q, k + 1): (d, -v) for k, (v, d) in enumerate([x for x in s if x[0] < 0][:5])}
        assert got == want
    few = R.token_counts(spark.createDataFrame([(1, "a b"), (2, "b c")], "id long, text string"))
    assert {(r.qid, r.did): r.score for r in R.sparse_topk(few, few, 5).collect()} == {(1, 1): 2, (1, 2): 1, (2, 2): 2, (2, 1): 1}


def test_sparse_goes_through_the_fewer_of_queries_and_texts(spark, monkeypatch):
    rng = np.random.default_rng(6)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    texts = [(i, [str(x) for x in rng.choice(words, n)]) for i, n in enumerate(rng.lognormal(3, 0.7, 3000).astype(int) + 1)]
    df = spark.createDataFrame(texts, "id long, tokens array<string>")
    w = np.zeros((3000, 300))
    for i, said in texts:
        for t in said:
            w[i, words.index(t)] += 1
    s = w @ w.T
    best = [np.lexsort((np.arange(3000), -s[q]))[:7] for q in range(3000)]
    want = {(q, k + 1): (d, s[q, d]) for q in range(0, 3000, 2) for k, d in enumerate(best[q]) if s[q, d] > 0}
    lists = R.sparse_topk(df.where("id % 2 = 0"), df, 7, block=600)
    posts = df.select("id", F.explode("tokens").alias("token")).groupBy("token", "id").agg(F.count("*").alias("w"))
    for found in (lists, R.sparse_topk(df.where("id % 2 = 0"), posts, 7, block=600)):
        assert {(r.qid, r.rk): (r.did, r.score) for r in found.collect()} == want
    # blocks of 500 texts against one of 3 000 queries: a turn for each text at most
    turns, score, score_text = [], R._SparseBlock._score, R._SparseBlock._score_text
    monkeypatch.setattr(R._SparseBlock, "_score", lambda self, *x: turns.append(1) or score(self, *x))
    monkeypatch.setattr(R._SparseBlock, "_score_text", lambda self, *x: turns.append(1) or score_text(self, *x))
    pack = lambda some: R._pack_lists(pa.table({"id": [i for i, _ in some], "tokens": [said for _, said in some]}))
    block = R._SparseBlock(*pack(texts), k=7, whole=True)
    for lo in range(0, 3000, 500):
        block.meet(*pack(texts[lo : lo + 500]))
    at, did, found = block.result()
    for q in range(0, 3000, 100):
        assert list(did[at == q]) == [d for d in best[q] if s[q, d] > 0]
    assert len(turns) <= 3000
    # texts too light for any query are not read
    block = R._SparseBlock(*pack([x for x in texts if len(x[1]) > 30]), k=7, whole=True)
    block.meet(*pack([x for x in texts if len(x[1]) > 30]))
    block.best.settle()
    monkeypatch.setattr(R._SparseBlock, "_read", None)
    block.meet(*pack([(9000 + i, [t]) for i, t in enumerate(words[:9])]))


def test_cells_that_are_not_below_a_bound():
    rng = np.random.default_rng(7)
    for m in (1, 7, 8, 41):
        s = rng.normal(size=(9, m)).astype(np.float32)
        s[2, 0], low = np.nan, rng.normal(size=9).astype(np.float32)
        low[3], s[4, m - 1] = -np.inf, low[4]
        want = np.nonzero(~(s < low[:, None]))
        assert all((a == b).all() for a, b in zip(R._not_below(s, low), want))

import base64
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.llm import boilerplate, contamination, names, near_duplicates, offensive, packing, splitting, token_budget, transcripts, truncation
from inkwell.llm.batches import tokenizer_path
from inkwell.llm.bpe import PATTERN, BpeCounter
from inkwell.llm.words import WordHashes, words

VOCABULARY = tokenizer_path("byte_bpe_50k.tiktoken")
random.seed(7)
WORDS = [f"w{i}" for i in range(400)]


def prose(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


# 1
def test_signature_agreement_is_weighted_jaccard():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 48, 300).astype(np.uint64)
    a, b = pool[:200], pool[80:280]
    s = near_duplicates.signatures(np.concatenate([a, b]), np.array([0, 200, 400]), 2000)
    assert abs((s[0] == s[1]).mean() - 120 / 280) < 0.05
    w = np.concatenate([np.full(200, 0.5), np.full(200, 2.0)])
    s = near_duplicates.signatures(np.concatenate([a, a]), np.array([0, 200, 400]), 2000, w)
    assert abs((s[0] == s[1]).mean() - 0.25) < 0.05


def test_pairs_equal_brute_force(spark):
    base = [prose(60) for _ in range(15)]
    texts = base + [t + " " + prose(k) for k, t in enumerate(base)] + [base[0], base[0], None, "", "w1", "w1 w2 " * 40]
    rows = spark.createDataFrame([("t", i, t, "x") for i, t in enumerate(texts)], "tbl string, id long, text string, rep string")
    members, pairs = near_duplicates.similar_pairs(rows, 3, 0.6, 30)
    got = {(r.id_a, r.id_b) for r in near_duplicates.expanded(members, pairs).collect()}
    sets = {i: {tuple(words(t)[k : k + 3]) for k in range(len(words(t)) - 2)} for i, t in enumerate(texts) if t and len(words(t)) >= 30}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    assert got == want
    groups = {r.row_id: r.group_id for r in near_duplicates.groups(members, pairs).collect()}
    assert groups[0] == groups[15] == groups[30] == groups[31] == 0 and len(groups) == len(sets)
    empty_members, empty_pairs = near_duplicates.similar_pairs(rows.where("false"), 3, 0.6, 30)
    assert near_duplicates.expanded(empty_members, empty_pairs).count() == 0


def test_pairs_at_the_bound_are_seldom_lost(spark):
    rows = []
    for i in range(400):  # 90 common 3-grams of 150: a similarity of exactly 0.6
        common = " ".join(f"p{i}c{j}" for j in range(92))
        rows += [("t", 2 * i + k, common + " " + " ".join(f"p{i}k{k}u{j}" for j in range(30))) for k in (0, 1)]
    _, pairs = near_duplicates.similar_pairs(spark.createDataFrame(rows, "tbl string, id long, text string"), 3, 0.6, 30)
    got = {(r.rep_a, r.rep_b) for r in pairs.collect()}
    assert got <= {(2 * i, 2 * i + 1) for i in range(400)} and len(got) >= 395


# 2
@given(st.lists(st.integers(-5, 5).map(float), max_size=12))
def test_best_run_is_maximal(scores):
    a, b = boilerplate.best_run(scores)
    best = max([0.0, *(sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))])
    assert sum(scores[a:b]) == best


def test_furniture_of_a_page(spark):
    page = [
        "Oskhaven Reading Room", "Home » Contact » Help", "This site uses cookies to count visits. Accept all | Settings", "Order 40 of the Brammarket command",
        "The mayor told the court that the papers were burned, and", "nobody", "in Marrowvik was told.", "ARTICLE 5", "Related records", "Letter from Naravik to Bramermoor, 10 April 1953",
        "All rights reserved to the crown under the treaty of Junmarket lapsed on 22 December 1949.", "Certified copy, Marrowstow", "© 2009 Oskhaven Reading Room", "Subscribe to our newsl",
    ]
    rows = spark.createDataFrame([("t", 1, "\n".join(page)), ("t", 2, None), ("t", 3, ""), ("t", 4, "x" * 100_000)], "tbl string, id long, text string")
    got = sorted((r.row_id, r.line_no) for r in boilerplate.furniture_lines(rows).collect())
    assert got == [(1, n) for n in (1, 2, 3, 9, 10, 13, 14)]
    assert {r.row_id: r.removed for r in boilerplate.main_text(rows).collect()} == {1: 7, 2: 0, 3: 0, 4: 0}


# 3
def test_dirt_and_clean_turns(spark):
    said = [
        ("THE PRESIDENT.-", "[10:33:20] I saw it.", 5), ("MR. A", "We, uh, met. The Ah river [sic] at 10:30 in the morning.", 6), ("MR. A", "Stop. (Laughter.) -- DR. B: No, never.", 6),
        ("", "MISS C: I was there.", 4), ("MR. D", None, None), (None, "and more", None), ("Q. MR. E", "wofür er befördert wurde, und der Rat kam von dort.", 7),
    ]
    s = spark.createDataFrame([(1, [{"speaker": a, "text": b, "page_number": c} for a, b, c in said]), (2, []), (3, None)], "session_id long, turns array<struct<speaker:string,text:string,page_number:int>>")
    turns = transcripts.turns_of(s)
    got = {(r.turn_no, r.kind) for r in transcripts.dirt(turns).collect()}
    assert got == {(1, "label"), (1, "time"), (2, "filler"), (3, "sound"), (3, "inner"), (4, "label"), (4, "order"), (7, "label")}
    clean = [(r.speaker, r.text) for r in transcripts.clean_turns(turns).orderBy("turn_no").collect()]
    assert ("DR. B", "No, never.") in clean and ("THE PRESIDENT", "I saw it.") in clean and clean[0][0] == "MISS C"


# 4
def test_limits_and_breaks(spark):
    rows = [("t", i, "x" * (100 + i * 3 % 400) + ".", "http://h/a", "c") for i in range(200)]
    rows += [("t", 1000 + i, f"{i} " + "y" * (698 - len(str(i))) + ".", "http://h/a", "c") for i in range(30)]
    rows += [("t", 2000, "The mayor went to the", "http://h/a", "c"), ("t", 2001, None, None, None), ("t", 2002, "", "http://h/a", "c"), ("t", 2003, "Certified copy, Marrowstow", "http://h/a", None)]
    df = spark.createDataFrame(rows, "tbl string, id long, text string, url string, collection string")
    got = {r.row_id for r in truncation.cut_rows(df).where("cut").collect()}
    assert {1000 + i for i in range(30)} | {2000} == got
    # a source with a limit in characters and another in bytes keeps both
    both = rows + [("t", 3000 + i, f"{i} " + "é" * (100 + i) + "z" * (900 - 2 * (100 + i) - len(str(i)) - 2) + ".", "http://h/a", "c") for i in range(14)]
    sized = truncation._lengths(spark.createDataFrame(both, df.schema).where("text is not null"))
    assert {("chars", 700), ("bytes", 900)} <= {(r.measure, r.length) for r in truncation.spikes(sized).where("host = 'h'").collect()}
    assert truncation.cut_rows(df.where("false")).count() == 0


# 5
@pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no vocabulary")
def test_token_counts_equal_the_encoder():
    import tiktoken

    counter = BpeCounter(VOCABULARY)
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=counter.rank, special_tokens={})
    assert enc.encode_ordinary(base64.b64encode(b"x" * 99).decode())
    for _ in range(1500):
        t = "".join(random.choice("abcdeéß日 \n.,'s12") for _ in range(random.randrange(60)))
        assert counter.count(t) == len(enc.encode_ordinary(t)), t
    assert counter.count(None) == 0


@pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no vocabulary")
def test_budget_counts_copies_once(spark):
    df = spark.createDataFrame([(1, "one two", 1, "a"), (2, "one two", 2, "b"), (3, None, None, None)], "id long, text string, stated int, coll string")
    null = F.lit(None).cast("string")
    rows = token_budget.census(df, "t", "id", "text", F.col("stated"), F.col("coll"), null, null, null)
    total = token_budget.budget(rows).where("grouping = 31").first()
    assert (total.texts, total.tokens, total.usable_tokens) == (3, 4, 2)


# 6
@settings(max_examples=80, deadline=None)
@given(st.text("ab .\n!", max_size=600), st.integers(8, 40), st.integers(0, 6))
def test_splits_go_back_together(text, limit, overlap):
    spans = splitting.split_spans(text, limit, overlap)
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all((b - a) // 4 <= limit for a, b in spans)
    assert all(b[0] <= a[1] and b[1] > a[1] for a, b in zip(spans, spans[1:]))
    # the asked overlap at least, and never more than a word beyond it
    back = 4 * min(overlap, limit // 2)
    assert all(back <= a[1] - b[0] <= back + (40 if back else 0) for a, b in zip(spans, spans[1:]))


def test_split_items_nulls(spark):
    df = spark.createDataFrame([(1, None, 5, 1), (2, "", 5, 1), (3, "word " * 50, 5, None), (4, "x" * 99, None, 1)], "k long, text string, max_tokens int, overlap_tokens int")
    got = Counter(r.k for r in splitting.split_items(df, ["k"]).collect())
    assert got[1] == 0 and got[2] == 1 and got[3] > 5 and got[4] == 1


# 7
def test_spellings(spark):
    groups = [
        ["THE PRESIDENT", "PRES.", "THE PRESDIENT", "President", "(10:21) THE PRESIDENT:"], ["MR. JORVANE HOLGAMAR", "HOLGAMAR, JORVANE", "Mr. Holgamar", "J. HOLGAMAR", "JORVANE HOOLGAMAR"],
        ["DR. PADRICK MORRIMOTT", "P. MORRIMOTT"], ["COLONEL QUINTARO MORRIMOTT", "Q. MORRIMOTT"], ["DELEGATION OF THE LONG VALLEY ASSEMBLY", "L.V.A. DELEGATION", "Long Valley Assembly Delegation"],
    ]
    rows = [(n,) for g in groups for k, n in enumerate(g) for _ in range(10 - k)] + [(None,), ("",)]
    got = {(r.name_a, r.name_b) for r in names.variant_pairs(names.entities(spark.createDataFrame(rows, "n string"), "n")).collect()}
    assert got == {tuple(sorted((a, b))) for g in groups for a in g for b in g if a < b}


def test_two_edits_chains_and_short_names(spark):
    rows = [("MR. HOLGAMARSTOV",)] * 40 + [("HOLGANARSTOW",)] * 3 + [("HOLGANARSTOWE",)] + [("HOLGANARSTOWEN",)] + [("DR. ANNA LIO",)] * 9 + [("DR. ANNA LIOS",)] + [("MR. LUO",)] * 9
    linked = {r.name: r.entity for r in names.entities(spark.createDataFrame(rows, "n string"), "n").collect()}
    assert len({linked[x] for x in ("MR. HOLGAMARSTOV", "HOLGANARSTOW", "HOLGANARSTOWE", "HOLGANARSTOWEN")}) == 1
    assert linked["DR. ANNA LIO"] == linked["DR. ANNA LIOS"] != linked["MR. LUO"]


# 8
def test_packing(spark):
    sizes = [random.randrange(1, 700) for _ in range(600)] + [2500]
    docs = spark.createDataFrame([(i, ("word " * n)[: 4 * n]) for i, n in enumerate(sizes)] + [(9000, None), (9001, "")], "doc_id long, text string")
    rows = packing.pack(docs, 1024, shard_rows=1000).collect()
    load = Counter()
    for r in rows:
        load[r.container] += r.tokens
    assert max(load.values()) <= 1024 and sum(load.values()) / (1024 * len(load)) > 0.9
    assert {r.doc_id for r in rows if r.n_pieces > 1} == {600} and {r.doc_id for r in rows} == {*range(601), 9001}


def test_few_containers_more_than_best_fit():
    rng = np.random.default_rng(2)
    sizes = np.sort(np.minimum(1024, rng.gamma(2.0, 160, 6000).astype(int) + 1))[::-1]
    rooms: list[int] = []
    for s in sizes.tolist():  # best fit, descending
        fit = [r for r in rooms if r >= s]
        if fit:
            rooms.remove(min(fit))
        rooms.append((min(fit) if fit else 1024) - s)
    at = packing.assign(sizes, 1024)
    assert np.bincount(at, sizes).max() <= 1024 and len(set(at.tolist())) <= 1.005 * len(rooms) + 1


@pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no vocabulary")
def test_packing_by_vocabulary_tokens(spark):
    bpe = BpeCounter(VOCABULARY)
    texts = ["word " * 300, "日本" * 900, "x" * 5000, "", "Short. " * 10]
    docs = spark.createDataFrame([*enumerate(texts), (9, None)], "doc_id long, text string")
    rows = packing.pack(docs, 256, vocabulary=VOCABULARY).collect()
    assert max(r.tokens for r in rows) <= 256 and {r.doc_id for r in rows} == {0, 1, 2, 3, 4}
    assert {r.doc_id for r in rows if r.n_pieces > 1} == {i for i, t in enumerate(texts) if bpe.count(t) > 256}
    for i, t in enumerate(texts):
        spans = packing.counted_spans(t, 256, bpe.count)
        assert "".join(t[a:b] for a, b, _ in spans) == t and all(max(1, bpe.count(t[a:b])) == n for a, b, n in spans)


# 9
def test_leaks(spark, monkeypatch):
    items = [prose(40) for _ in range(5)] + [prose(5), None]
    docs = [prose(30) + " " + items[k].upper().replace(" ", ", ", 3)[10:140] + ". " + prose(10) for k in range(4)] + [None, "", prose(50)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string")
    e = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    hits = contamination.hits(d, e)
    want = {
        (i, j) for i, t in enumerate(docs) for j, s in enumerate(items)
        if t and s and any(words(t)[a : a + 12] == words(s)[b : b + 12] for a in range(len(words(t)) - 11) for b in range(len(words(s)) - 11))
    }
    assert want and {tuple(r) for r in contamination.leaked(hits).collect()} == want
    # a table of bits so small that nearly all windows pass it gives the same spans
    small = contamination.MOST_BITS, contamination.LEAST_BITS
    contamination.MOST_BITS = contamination.LEAST_BITS = 15
    monkeypatch.setattr(contamination, "BITS_A_GRAM", 0)
    assert {tuple(r) for r in contamination.hits(d, e).collect()} == {tuple(r) for r in hits.collect()}
    contamination.MOST_BITS, contamination.LEAST_BITS = small
    cleaned = contamination.cleaned(d, hits)
    assert contamination.hits(cleaned, e).count() == 0 and cleaned.count() == len(docs)


# 10
CALM = [f"The {a} {b} the {c}." for a in ("mayor", "clerk", "widow", "guard") for b in ("signed", "counted", "read", "sold") for c in ("letters", "crates", "maps", "horses")]
INSULTS = [f"You {a} {b}, {c}." for a in ("filthy", "lying", "rotten") for b in ("swine", "coward", "fool") for c in ("go to hell", "shut your mouth", "damn you")]


def reviewed():
    """Documents (id, text, label): harmless ones, offensive ones of which most sentences are harmless, some wrong labels, and unlabelled ones."""
    rng = random.Random(11)
    docs = [(i, " ".join(rng.sample(CALM, 6)), "none") for i in range(120)]
    for i in range(120, 160):
        said = rng.sample(CALM, 5)
        said.insert(rng.randrange(6), rng.choice(INSULTS))
        docs.append((i, " ".join(said), "abuse"))
    docs += [(200, " ".join([*rng.sample(CALM, 3), rng.choice(INSULTS)]), "none"), (201, " ".join(rng.sample(CALM, 4)), "abuse")]
    docs += [(300 + i, " ".join([*rng.sample(CALM, 4), x]), None) for i, x in enumerate(INSULTS)] + [(400 + i, " ".join(rng.sample(CALM, 5)), None) for i in range(200)]
    return docs


def test_near_is_exact():
    sentences = [*CALM, *INSULTS]
    reader = offensive.Reader()
    read = [reader.words(s) for s in sentences]
    v = offensive.Vocabulary(read)
    idf = np.linspace(0.5, 4, v.size)
    m = offensive.Model(sentences, np.arange(len(sentences)), reader, v, read, idf)
    m.label(["none"] * len(CALM) + ["abuse"] * len(INSULTS), np.ones(len(sentences)))
    dense = np.zeros((len(sentences), v.size))
    np.add.at(dense, (m.owner, m.terms), 1)
    dense = dense * idf
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    asked = 0
    for i in range(len(sentences)):
        ids, sims = m.index.near(m.of_example(i), 0.25)
        want = dense @ dense[i]
        if (want[m.bad] >= 0.25).any():
            asked += 1
            assert ids.tolist() == np.flatnonzero(want >= 0.25 - 1e-12).tolist() and np.allclose(sims, want[ids])
        else:
            assert not len(ids)
    assert asked >= len(INSULTS)


def test_offensive_documents_are_told_by_the_labels_alone(spark):
    docs = reviewed()
    extra = [(900, None, "x"), (901, "", "x"), (902, "Damn y o u, you f i l t h y coward!", "x"), (900, "The clerk read the maps.", "x")]
    documents = spark.createDataFrame([(i, t, "s") for i, t, _ in docs] + extra, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, c) for i, _, c in docs if c] + [(None, "abuse"), (7777, "hate"), (900, None), (3, "abuse"), (3, "none"), (3, "none")], "doc_id long, category string")
    scored = offensive.scores(documents, offensive.train(documents, labels))
    rows = scored.collect()
    found = {r.doc_id for r in rows if r.score >= offensive.THRESHOLD}
    assert found == {*range(120, 160), 200, *range(300, 300 + len(INSULTS)), 902} and len(rows) == len(docs) + 4
    one = next(r for r in rows if r.doc_id == 300)
    assert one.category == "abuse" and "you filthy swine" in one.sentence and one.example
    assert offensive.rates(scored).where("source = 'x'").first().offensive == 1
    # without labels nothing is offensive, and no documents give no rows
    nothing = offensive.scores(documents, offensive.train(documents, labels.where("false")))
    assert nothing.where("score > 0").count() == 0 and offensive.scores(documents.where("false"), offensive.train(documents.where("false"), labels)).count() == 0


def test_examples_are_taken_from_the_whole_text(spark):
    long = " ".join(f"The {WORDS[i]} clerk counted the {WORDS[i + 1]} boxes." for i in range(70))
    documents = spark.createDataFrame([(1, long, "a"), (2, "The widow wrote a letter.", "a")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(1, "abuse"), (2, "none")], "doc_id long, category string")
    sentences = {s.rstrip(".") for s in offensive.train(documents, labels).sentences}
    assert all(f"the {WORDS[i]} clerk counted the {WORDS[i + 1]} boxes" in sentences for i in range(70))


def test_word_hashes_forget_beyond_their_bound():
    h = WordHashes()
    h.BOUND = 2
    assert [h[w] for w in "abc"] == [WordHashes()[w] for w in "abc"]


def test_runs_below_a_sum_are_found():
    assert boilerplate.islands([1, -2, -2, 1, -1, 5, -1, 3, -4], -2.5) == [(1, 3), (8, 9)]
    assert boilerplate.islands([-1, -1, -1, 9], -2.5) == [(0, 3)] and boilerplate.islands([], -1) == [] and boilerplate.islands([2, 3], -1) == []


def test_sites_of_the_test_page_are_in_no_labelled_page():
    from inkwell.llm.labelled_pages import PAGES

    assert not any(site in PAGES for site in ("Oskhaven", "Marrowfield", "Tolberry", "Fenholm", "Veldale"))

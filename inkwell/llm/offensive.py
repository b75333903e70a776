"""Problem 10: documents scored for abusive, hateful and sexual language by their nearest labelled examples.

Examples are the sentences of a bounded sample of labelled documents; there is no list of words or phrases. A label holds
for a document, and most sentences of an offensive one are harmless, so each sentence is told by its neighbours in other
documents: what is said in harmless documents too is harmless, what only offensive ones say is an example of their
category, and what has no neighbour has no say. Wrong labels are outvoted in the same way. Every sentence of every document
is compared with the examples by exact TF-IDF cosine over words and pairs of words; a block-max inverted index leaves out
blocks of examples whose bound is below ``NEAR``. The nearest ``K`` vote with the square of their similarity. A document's
score is that of its worst sentence, which is given as evidence with the nearest example; the votes are calibrated on the
labelled documents, each judged without its own sentences.

Document frequencies come from all documents. Spaced letters, digits and signs for letters, and starred-out letters are
undone first. Nulls: null and empty texts score 0 with no evidence; labels without a document, or with a null category,
are left out. Of several labels of a document the offensive ones hold if they are no fewer than the others. Without
labels every document scores 0.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.batches import map_columns

#: Neighbours that vote, the least similarity of a neighbour, and examples a block.
K, NEAR, BLOCK = 15, 0.25, 32
#: Bounds of the sample of labelled documents: offensive and harmless ones, each with all its sentences.
MAX_OFFENSIVE, MAX_HARMLESS = 1000, 1000
#: Share of the vote that makes a sentence of an offensive document an example, and rounds of that at most.
AGREE, ROUNDS = 0.6, 5
#: The least evidence of a candidate sentence, and how near a telling term's rate comes to the highest.
TELLING, PURE = 6.0, 0.4
#: Score from which a document counts as offensive.
THRESHOLD = 0.5
#: The weight of a word that no example has, and of what is unseen in a vote.
UNSEEN_IDF, COUNTERWEIGHT = 2.5, 0.08
#: Documents to which the calibration's prior (a vote is its own score) amounts.
PRIOR = 20.0

#: The end of a sentence, and words or such ends; the second pattern also takes signs that stand for letters.
_END = r"[.!?][\"”»']?\s|\n"
_SPLIT = re.compile(_END)
#: Short forms whose full stop ends no sentence.
_ABBREVIATIONS = ("mr.", "mrs.", "dr.", "mme.", "prof.")
_PLAIN = re.compile(rf"\w+|{_END}")
_WORD = re.compile(rf"[^\W_]+(?:[*@$]+[^\W_]*)*|[@$][^\W_]+(?:[*@$]+[^\W_]*)*|{_END}")
_MIXED = re.compile(r"\d(?<=[a-z]\d)|\d(?=[a-z])")
_MAYBE_SPACED = re.compile(r"[\s.·_-]\w[ .·_-]\w[ .·_-]\w")
_SPACED = re.compile(r"\b[^\W\d_]([ .·_-])(?:[^\W\d_]\1)+[^\W\d_](?![^\W_])")
_LONG = re.compile(r"([^\W\d_])\1\1+")
_LEET = str.maketrans("0134578$@", "oleastbsa")
_LEET_I = str.maketrans("0134578$@", "oieastbsa")
_MARKS = re.compile("[\u0300-\u036f\u200b-\u200f\u2060\u00ad\ufeff]+")


def fold(text: str) -> str:
    """Lower case without accents and invisible characters."""
    low = text.lower()
    return low if low.isascii() else _MARKS.sub("", unicodedata.normalize("NFKD", low))


def _thrice(text: str) -> bool:
    """Whether some letter stands three times in a row."""
    b = np.frombuffer(text.encode("latin-1", "replace"), dtype=np.uint8)
    return bool(((b[2:] == b[1:-1]) & (b[1:-1] == b[:-2]) & (b[2:] > 96)).any())


class Reader:
    """Sentences and their words; starred-out and disguised words are told by the words of the examples."""

    def __init__(self, vocabulary: set[str] | None = None):
        self.vocabulary = vocabulary or set()
        self.by_shape: dict[tuple[str, str, int], list[str]] = defaultdict(list)
        for w in sorted(self.vocabulary):
            self.by_shape[w[:1], w[-1:], len(w)].append(w)

    def plain(self, text: str) -> str:
        """The text in lower case, short forms without their stop."""
        text = " " + fold(text)
        for a in _ABBREVIATIONS:
            if a in text:
                text = text.replace(a, a[:-1])
        return text

    def sentences(self, text: str) -> list[str]:
        """The sentences of a text, one for each that ``marked`` tells apart."""
        return _SPLIT.split(self.plain(text))

    def marked(self, text: str) -> list[str]:
        """Words, and the ends of sentences between them; what disguises words is undone."""
        text = self.plain(text)
        if _MAYBE_SPACED.search(text):
            text = _SPACED.sub(lambda m: m.group().replace(m.group(1), ""), text)
        if _thrice(text):
            text = _LONG.sub(r"\1", text)
        if "*" in text or "$" in text or "@" in text or _MIXED.search(text):
            return [self._plain(x) if x[0] in "@$" or (x[0].isalnum() and not x.isalpha() and not x.isdigit()) else x for x in _WORD.findall(text)]
        return _PLAIN.findall(text.replace("_", " ") if "_" in text else text)

    def words(self, sentence: str) -> list[str]:
        """The words of one sentence."""
        return [w for w in self.marked(sentence) if w[0].isalnum()]

    def _plain(self, word: str) -> str:
        if "*" in word:
            first, last = word[0], word[-1]
            fit = [x for x in self.by_shape.get((first, last, len(word)), ()) if all(a == b or a == "*" for a, b in zip(word, x))]
            return fit[0] if fit else word.replace("*", "")
        a, b = word.translate(_LEET), word.translate(_LEET_I)
        return a if a in self.vocabulary and b not in self.vocabulary else b


class WordNumbers(dict):
    """Numbers of known words; any number is the word 0, other words are 0, the end of a sentence is -1.

    Unknown ones are remembered up to a bound.
    """

    BOUND = 300_000

    def __missing__(self, word: str) -> int:
        n = self.get("0", 0) if word.isdigit() else 0 if word[0].isalnum() or word[0] == "_" else -1
        if len(self) < self.BOUND:
            self[word] = n
        return n


class Vocabulary:
    """Numbers for the words of the examples and for their pairs of neighbouring words; other words are 0."""

    def __init__(self, sentences: list[list[str]]):
        self.id = WordNumbers()
        for ws in sentences:
            for w in ws:
                self.id.setdefault("0" if w.isdigit() else w, len(self.id) + 1)
        self.n_words = len(self.id) + 1
        pairs = {self.id[a] * self.n_words + self.id[b] for ws in sentences for a, b in zip(ws, ws[1:])}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.size = self.n_words + len(self.pairs)

    def tokens(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All terms of marked texts (words, then known pairs), the sentence of each, and the first sentence of each text.

        Sentences are numbered over all texts; every text has at least one.
        """
        lengths = np.array([len(ws) for ws in texts], dtype=np.int64)
        ids = np.fromiter(map(self.id.__getitem__, chain.from_iterable(texts)), np.int64, int(lengths.sum()))
        begins = np.cumsum(lengths) - lengths
        ends = ids < 0
        passed = np.concatenate(([0], np.cumsum(ends)))
        # a sentence's number: the ends of sentences before it, and one more for each text begun before its own
        first = passed[begins] + np.arange(len(texts))
        owner = passed[:-1] + np.repeat(np.arange(len(texts)), lengths)
        known = ids > 0
        both = np.flatnonzero(known[1:] & known[:-1] & (owner[1:] == owner[:-1]))
        words = np.flatnonzero(~ends)
        terms, of = ids[words], owner[words]
        if len(both) and len(self.pairs):
            code = ids[both] * self.n_words + ids[both + 1]
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            hit = np.flatnonzero(self.pairs[at] == code)
            terms, of = np.concatenate([terms, self.n_words + at[hit]]), np.concatenate([of, owner[both[hit]]])
        return terms, of, first


class Postings:
    """Inverted lists side by side in arrays: per term the examples and weights, and per block of examples the largest."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, weight: np.ndarray, size: int, n: int):
        order = np.lexsort((doc, term))
        term, self.doc, self.weight = term[order], doc[order].astype(np.int32), weight[order]
        self.at = np.searchsorted(term, np.arange(size + 1))
        self.n, self.blocks, self.home = n, -(-n // BLOCK), (self.doc // BLOCK).astype(np.int32)
        key = term * max(1, self.blocks) + self.home
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        self.block = self.home[first]
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.block_at = np.searchsorted(term[first], np.arange(size + 1))
        self.begin, self.length = first, np.diff(np.append(first, len(self.doc)))
        del self.home, self.at

    def similar(self, terms: np.ndarray, x: np.ndarray, least: float) -> np.ndarray | None:
        """Sums over the lists; exact for examples that reach ``least``, None if by the blocks' bounds none can.

        Only the parts of the lists that lie in blocks whose bound reaches ``least`` are read.
        """
        a, n = self.block_at[terms], self.block_at[terms + 1] - self.block_at[terms]
        parts = _ranges(a, n)
        q = np.repeat(x, n)
        bound = np.bincount(self.block[parts], q * self.most[parts], self.blocks)
        open_ = bound >= least
        if not open_.any():
            return None
        m = open_[self.block[parts]]
        parts, q = parts[m], q[m]
        at = _ranges(self.begin[parts], self.length[parts])
        return np.bincount(self.doc[at], np.repeat(q, self.length[parts]) * self.weight[at], self.n)


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, ... of each range, one range after the other."""
    return np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


class BlockMaxIndex:
    """Examples as unit TF-IDF vectors in inverted lists; the offensive ones once more by themselves, to be asked first."""

    def __init__(self, terms: np.ndarray, owner: np.ndarray, n: int, idf: np.ndarray):
        self.n, self.idf = n, idf
        key, count = np.unique(terms * n + owner, return_counts=True)
        term, doc = key // n, key % n
        weight = count * idf[term]
        norm = np.sqrt(np.bincount(doc, weight**2, n))
        weight = weight / np.maximum(norm[doc], 1e-12)
        known = term > 0
        self.raw = term[known], doc[known], weight[known]
        self.all = Postings(*self.raw, len(idf), n)

    def set_offensive(self, offensive: np.ndarray) -> None:
        """Says which examples are offensive."""
        place = np.cumsum(offensive) - 1
        term, doc, weight = self.raw
        m = offensive[doc]
        self.hot = Postings(term[m], place[doc[m]], weight[m], len(self.idf), int(offensive.sum()))
        self.high = np.zeros(len(self.idf))
        np.maximum.at(self.high, term[m], weight[m])

    def possible(self, terms: np.ndarray, owner: np.ndarray, n: int, least: float) -> np.ndarray:
        """Which of ``n`` queries may have an offensive example at least ``least`` similar; none that has one is left out."""
        idf = self.idf[terms]
        most = np.bincount(owner, idf * self.high[terms], n)
        norm = np.sqrt(np.bincount(owner, idf**2, n))  # a term that occurs twice counts for less here than in the true norm
        return np.flatnonzero((most > 0) & (most >= least * norm))

    def near(self, terms: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities of all examples at least ``least`` similar; none if no offensive one is among them."""
        t, count = np.unique(terms, return_counts=True)
        x = count * self.idf[t]
        norm = float(np.sqrt((x**2).sum())) or 1.0
        query = t[t > 0], x[t > 0]
        hot = self.hot.similar(*query, least * norm)
        if hot is None or hot.max() < least * norm:
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        sims = self.all.similar(*query, least * norm) / norm
        ids = np.flatnonzero(sims >= least)
        return ids, sims[ids]


class Model:
    """The examples with their documents and categories, votes over them, and the calibration of votes."""

    def __init__(self, sentences: list[str], home: np.ndarray, reader: Reader, vocabulary: Vocabulary, read: list[list[str]], idf: np.ndarray):
        self.sentences, self.home, self.reader, self.vocabulary = sentences, home, reader, vocabulary
        self.terms, self.owner, _ = vocabulary.tokens(read) if read else (np.zeros(0, np.int64),) * 3
        order = np.argsort(self.owner, kind="stable")
        self.terms, self.owner = self.terms[order], self.owner[order]
        self.begin = np.searchsorted(self.owner, np.arange(len(sentences) + 1))
        self.index = BlockMaxIndex(self.terms, self.owner, len(sentences), idf)
        self.slope, self.shift = 1.0, 0.0

    def label(self, categories: list[str], say: np.ndarray) -> Model:
        """The model with these categories of its examples and their weights in a vote."""
        self.categories, self.say = categories, say
        self.bad = np.array([c != "none" for c in categories], dtype=bool) & (say > 0)
        self.index.set_offensive(self.bad)
        return self

    def vote(self, terms: np.ndarray, without: int = -1) -> tuple[float, int, float]:
        """Share of the vote for offensive, the nearest offensive example (-1: none) and the power of all votes.

        ``without`` leaves the examples of one document out.
        """
        ids, sims = self.index.near(terms, NEAR)
        heard = self.say[ids] > 0
        if without >= 0:
            heard &= self.home[ids] != without
        ids, sims = ids[heard], sims[heard]
        order = np.lexsort((ids, -sims))[:K]
        ids, sims = ids[order], sims[order]
        power = self.say[ids] * sims**2
        bad = self.bad[ids]
        if not bad.any():
            return 0.0, -1, float(power.sum())
        # a lone distant neighbour is weak evidence: a fixed counterweight stands for the unseen harmless ones
        return float(power[bad].sum() / (power.sum() + COUNTERWEIGHT)), int(ids[bad][0]), float(power.sum())

    def score(self, vote: float) -> float:
        """The calibrated score of a vote; 0 for none."""
        if vote <= 0:
            return 0.0
        x = np.log(min(vote, 0.999) / (1 - min(vote, 0.999)))
        return float(1 / (1 + np.exp(-(self.slope * x + self.shift))))

    def of_example(self, i: int) -> np.ndarray:
        """The terms of an example."""
        return self.terms[self.begin[i] : self.begin[i + 1]]

    def learn(self, given: list[str], df: np.ndarray) -> Model:
        """Categories of the examples from those of their documents, in rounds, and the calibration.

        A sentence of an offensive document is a candidate when it holds a telling term (``_suspect``). Candidates are
        confirmed by their neighbours in other documents, sentences near confirmed ones are asked in the next round; what
        is not confirmed has no say. Sentences of harmless documents are harmless, but for those that confirmed ones
        outvote: their documents' labels are wrong.
        """
        bad_doc = np.array([c != "none" for c in given], dtype=bool)
        near_telling = bad_doc & self._suspect(bad_doc, df)
        kept = set(np.flatnonzero(near_telling).tolist())
        asked = kept
        for _ in range(ROUNDS):
            say = np.where(bad_doc, 0.0, 1.0)
            say[list(kept)] = 1.0
            self.label([c if i in kept else "none" for i, c in enumerate(given)], say)
            close = self.index.possible(self.terms[m := bad_doc[self.owner]], self.owner[m], len(self.sentences), NEAR)
            asked = asked | set(close.tolist())
            told = {i: self.vote(self.of_example(i), int(self.home[i])) for i in sorted(asked)}
            # a telling sentence that is like no other stays
            now = {i for i, (v, _, power) in told.items() if v >= AGREE or (near_telling[i] and power < COUNTERWEIGHT)}
            if now == kept:
                break
            kept = now
        say = np.where(bad_doc, 0.0, 1.0)
        say[list(kept)] = 1.0
        self.label([c if i in kept else "none" for i, c in enumerate(given)], say)
        m = ~bad_doc[self.owner]
        close = self.index.possible(self.terms[m], self.owner[m], len(self.sentences), NEAR)
        say[[i for i in close.tolist() if self.vote(self.of_example(i), int(self.home[i]))[0] >= AGREE]] = 0.0
        self.label(self.categories, say)
        self._calibrate(bad_doc)
        return self

    def _suspect(self, bad: np.ndarray, df: np.ndarray) -> np.ndarray:
        """Which examples speak, by the evidence of their telling terms, for an offensive document.

        Labelled offensive documents are a share p of all documents, and a share q (the upper quartile by
        evidence) of those that hold the most telling terms. A term of n other documents, b of them labelled offensive, is telling when b / n is at least ``PURE`` q; its
        evidence is the log likelihood ratio of the rates b / n and p. Pairs of words count half, as they repeat their words.
        """
        n_homes = int(self.home.max(initial=0)) + 1
        key = np.unique(self.terms[m] * n_homes + self.home[self.owner[m]]) if (m := bad[self.owner]).any() else np.zeros(0, np.int64)
        b = np.bincount(key // n_homes, minlength=len(df)).astype(float)
        n = np.maximum(df, b)
        b[0] = 0
        p = min(0.5, max(1, len(np.unique(self.home[bad]))) / max(1.0, df[0]))

        def ratio(b: np.ndarray, n: np.ndarray) -> np.ndarray:
            rate = b / np.maximum(n, 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                x = np.where(b > 0, b * np.log(rate / p), 0.0) + np.where(n > b, (n - b) * np.log((1 - rate) / (1 - p)), 0.0)
            return np.where(rate > p, x, 0.0)

        evidence = ratio(b, n)
        most = np.flatnonzero(evidence >= 2 * TELLING)
        most = most[np.argsort((b / np.maximum(n, 1))[most])]
        reached = np.cumsum(evidence[most])
        q = max(4 * p, (b / np.maximum(n, 1))[most[np.searchsorted(reached, 0.75 * reached[-1])]]) if len(most) else 4 * p
        b, n = np.maximum(b - 1, 0), np.maximum(n - 1, 0)
        # once elsewhere is chance: a term counts from its second other offensive document
        evidence = np.where((b >= 2) & (b >= PURE * q * np.maximum(n, 1)), ratio(b, n), 0.0)
        evidence[self.vocabulary.n_words :] *= 0.5
        pair = np.unique(self.owner * len(df) + self.terms)
        return np.bincount(pair // len(df), evidence[pair % len(df)], len(self.sentences)) >= TELLING

    def _calibrate(self, bad_doc: np.ndarray) -> None:
        """A logistic map from the votes of labelled documents, each without its own sentences, to their labels."""
        near = self.index.possible(self.terms, self.owner, len(self.sentences), NEAR).tolist()
        worst: dict[int, float] = defaultdict(float)
        for i in near:
            v = self.vote(self.of_example(i), int(self.home[i]))[0]
            worst[int(self.home[i])] = max(worst[int(self.home[i])], v)
        truth = {int(h): bool(b) for h, b in zip(self.home, bad_doc)}
        rows = [(min(max(v, 0.001), 0.999), truth[h]) for h, v in worst.items() if v > 0]
        # the prior: votes spread evenly over their range, each its own score
        even = np.linspace(0.05, 0.95, 19)
        x = np.array([v for v, _ in rows] + even.tolist() * 2)
        y = np.array([float(t) for _, t in rows] + [1.0] * 19 + [0.0] * 19)
        w = np.concatenate([np.ones(len(rows)), even * PRIOR / 19, (1 - even) * PRIOR / 19])
        x = np.stack([np.log(x / (1 - x)), np.ones(len(x))], axis=1)
        at = np.array([1.0, 0.0])
        for _ in range(25):
            p = 1 / (1 + np.exp(-(x @ at)))
            step = np.linalg.solve((x.T * (w * p * (1 - p))) @ x + 1e-6 * np.eye(2), x.T @ (w * (p - y)))
            at = at - np.clip(step, -1, 1)
        self.slope, self.shift = max(0.1, float(at[0])), float(at[1])

    def votes(self, texts: list[str | None]) -> list[tuple[int, int, float, int]]:
        """Text, sentence, score and nearest example of each sentence that scores above 0."""
        terms, owner, first = self.vocabulary.tokens([self.reader.marked(t) if t else [] for t in texts])
        total = int(max(owner.max(initial=0), first[-1] if len(first) else 0)) + 1
        todo = self.index.possible(terms, owner, total, NEAR)
        if not len(todo):
            return []
        asked = np.zeros(total, bool)
        asked[todo] = True
        few = np.flatnonzero(asked[owner])
        few = few[np.argsort(owner[few], kind="stable")]
        terms, owner = terms[few], owner[few]
        begin, end = np.searchsorted(owner, todo), np.searchsorted(owner, todo, "right")
        text = np.searchsorted(first, todo, "right") - 1
        out = []
        for i, k, a, b in zip((todo - first[text]).tolist(), text.tolist(), begin.tolist(), end.tolist()):
            v, e, _ = self.vote(terms[a:b])
            if v > 0:
                out.append((k, i, v, e))
        return out


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """The model from a bounded sample of labelled documents; document frequencies are counted over all documents."""
    votes = labels.where("doc_id is not null and category is not null").groupBy("doc_id").agg(
        F.count_if(F.col("category") != "none").alias("bad"), F.count_if(F.col("category") == "none").alias("good"), F.max(F.when(F.col("category") != "none", F.col("category"))).alias("category")
    )
    state = votes.select("doc_id", F.when((F.col("bad") > 0) & (F.col("bad") >= F.col("good")), F.col("category")).otherwise("none").alias("category"))
    sample = lambda which, bound: state.where(which).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    chosen = sample("category != 'none'", MAX_OFFENSIVE).unionByName(sample("category = 'none'", MAX_HARMLESS))
    # texts of the sample only: at most the two bounds together, read in one pass
    texts = documents.select("doc_id", "text").where("text is not null")
    rows = sorted(texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "category", "text").collect(), key=lambda r: (r.doc_id, r.text))
    return fit([(r.text, r.category) for r in rows], lambda v: frequencies(documents, v))


def fit(rows: list[tuple[str, str]], frequencies_of: Callable[[Vocabulary], np.ndarray]) -> Model:
    """The model of labelled (text, category) documents; ``frequencies_of`` counts a vocabulary's terms in all documents."""
    reader = Reader()
    sentences, home, given = [], [], []
    for k, (text, category) in enumerate(rows):
        for s in dict.fromkeys(x.strip() for x in reader.sentences(text)):
            if len(s) > 8:
                sentences.append(s)
                home.append(k)
                given.append(category)
    homes = np.array(home, dtype=np.int64)
    # words that stand undisguised in offensive documents tell what disguised ones mean
    reader = Reader({w for s, c in zip(sentences, given) if c != "none" for w in reader.words(s) if w.isalpha()})
    read = [reader.words(s) for s in sentences]
    vocabulary = Vocabulary(read)
    df = frequencies_of(vocabulary)
    idf = np.log((1 + max(1.0, df[0])) / (1 + df)) + 0.2
    idf[0] = UNSEEN_IDF
    model = Model(sentences, homes, reader, vocabulary, read, idf).learn(given, df)
    # what only learning needs is not sent
    model.index.raw = model.terms = model.owner = model.begin = model.home = None
    return model


def frequencies(documents: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """The number of documents, of all, with each term of the examples (their vocabulary is bounded); first that of all.

    Words are taken as they are written here.
    """

    plain = Reader().plain

    def kernel(c: dict, _) -> dict:
        n = np.zeros(vocabulary.size, dtype=np.int64)
        for lo in range(0, len(c["text"]), 256):
            texts = c["text"][lo : lo + 256]
            terms, owner, first = vocabulary.tokens([_PLAIN.findall(plain(t)) if t else [] for t in texts])
            there = np.zeros((len(texts), vocabulary.size), dtype=bool)
            there[np.searchsorted(first, owner, "right") - 1, terms] = True
            n += there.sum(axis=0)
        n[0] = len(c["text"])
        some = np.flatnonzero(n)
        return {"term": some, "n": n[some]}

    counted = map_columns(documents.select("text"), kernel, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    df = np.zeros(vocabulary.size)
    for r in counted.collect():
        df[r.term] = r.n
    return df


def scores(documents: DataFrame, model: Model) -> DataFrame:
    """A row per document: doc_id, source, score, category, sentence, example (the last three null without evidence)."""

    def kernel(c: dict, m: Model) -> dict:
        best: dict[int, tuple[float, int, int]] = {}
        for d, i, v, e in m.votes(c["text"]):
            if v > best.get(d, (0.0, 0, 0))[0]:
                best[d] = v, i, e
        found = [best.get(d) for d in range(len(c["text"]))]
        return {
            "doc_id": c["doc_id"],
            "source": c["source"],
            "score": [round(m.score(b[0]), 6) if b else 0.0 for b in found],
            "category": [m.categories[b[2]] if b else None for b in found],
            "sentence": [m.reader.sentences(t)[b[1]].strip() if b else None for t, b in zip(c["text"], found)],
            "example": [m.sentences[b[2]] if b else None for b in found],
        }

    schema = "doc_id bigint, source string, score double, category string, sentence string, example string"
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's bounds
    return map_columns(documents.select(F.col("doc_id").cast("bigint"), "source", "text"), kernel, schema, lambda: shared.value)


def rates(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per source: documents, offensive ones, their share, and the mean score."""
    return scored.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("score") >= threshold).alias("offensive"),
        F.round(F.count_if(F.col("score") >= threshold) / F.count(F.lit(1)), 6).alias("rate"),
        F.round(F.avg("score"), 6).alias("mean_score"),
    )

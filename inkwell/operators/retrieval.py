"""Retrieval: postings, exact dense and sparse top-k, reciprocal rank fusion, reranking, cached answers.

Ties are broken by the smaller id throughout. Null vectors and texts are in no result; queries without a match give no
row; repeated ids count as they come. Query and document blocks bound what a task holds, whatever the tables.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from inkwell.sources.shared import materialise, scratch

RRF_K = 60
#: Vectors a block of queries at most; a block of what they meet has twice as many.
BLOCK = 4096
#: So many queries, or fewer, are one block if that may hold them.
FEW = 1024


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it occurs there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def normalised(v: Column) -> Column:
    """A vector of unit length, in doubles; a null or zero vector gives null."""

    def unit(d: Column) -> Column:
        norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda a, x: a + x * x))
        return _bound(norm, lambda n: F.when(n > 0, F.transform(d, lambda x: x / n)))

    return _bound(F.transform(v, lambda x: x.cast("double")), unit)


def dot(a: Column, b: Column) -> Column:
    """Inner product, summed left to right in doubles."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


class _Best:
    """The best ``k`` of what was offered to each of ``n`` queries, by score, then by the smaller id."""

    def __init__(self, n: int, k: int):
        self.k, self.most, self.new = k, max(n * k, 50_000), 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        #: Scores below it are of no use to a query.
        self.least = np.full(n, -np.inf)

    def offer(self, at: np.ndarray, did: np.ndarray, score: np.ndarray) -> None:
        self.parts.append((at, did, score))
        self.new += len(at)
        if self.new > self.most:
            self.settle()

    def settle(self) -> None:
        if not self.new:
            return
        at, did, score = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((did, np.where(np.isnan(score), -np.inf, -score), at))
        at = at[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        order, at, place = (x[place < self.k] for x in (order, at, place))
        self.parts, self.new = [(at, did[order], score[order])], 0
        full = place == self.k - 1
        self.least[at[full]] = np.nan_to_num(score[order][full], nan=np.inf, posinf=np.inf, neginf=-np.inf)


def _gathered(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """A task's rows in tables of ``most`` rows, the last one smaller."""
    held, rows = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            held.append(batch.slice(at, most - rows))
            rows, at = rows + held[-1].num_rows, at + held[-1].num_rows
            if rows == most:
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _packed(df: DataFrame, most: int, pack: Callable[[pa.Table], list[bytes]], names: str, side: str, gather: Callable) -> DataFrame:
    """Rows packed, as they lie, into blocks of ``most`` at most: a number and a column of bytes for each of ``names``."""
    at = [f"{side}_{x}" for x in names.split()]

    def run(batches):
        for n, t in enumerate(gather(batches, most)):
            no = pa.array([TaskContext.get().partitionId() << 32 | n])
            yield pa.RecordBatch.from_arrays([no, *(pa.array([x], pa.binary()) for x in pack(t))], names=[f"{side}_no", *at])

    return df.mapInArrow(run, ", ".join([f"{side}_no bigint", *(f"{x} binary" for x in at)]))


def _met(queries: DataFrame, docs: DataFrame, block: int, doc_block: int, packed: Callable, names: str, start: Callable, score: str) -> DataFrame:
    """Every block of queries with every block of docs: qid, did, score.

    A task holds one block of queries and sees the docs block by block, so that its least useful score grows over all it has
    seen. ``packed`` makes blocks of either side's rows, of ``names``. ``start`` makes of a query block's bytes what meets the docs' bytes (``meet``) and tells its best at the end
    (``result``). Many queries: as many blocks as keep all cores busy, and docs packed once; few: one, and docs in stripes.
    Many blocks meet in a session of their own, which sends a pair of blocks at a time to Python, and not 64 MB of them.
    """
    spark = queries.sparkSession
    queries = materialise(queries)
    cores, n = spark.sparkContext.defaultParallelism, queries.select("id").distinct().count()
    blocks = max(1, -(-n // block))
    if n > FEW:
        blocks = -(-max(blocks, 2 * cores) // cores) * cores
    asked, texts = scratch(spark), packed(docs, doc_block, "d")
    packed(queries.repartition(blocks, "id"), block, "q").write.parquet(asked)
    there = max(1, spark.read.parquet(asked).count())
    if there > 1:
        texts.write.parquet(path := scratch(spark))
        spark = spark.newSession()
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
        texts = spark.read.schema(texts.schema).parquet(path).coalesce(-(-2 * cores // there))
    pairs = texts.crossJoin(spark.read.parquet(asked).coalesce(1).repartition(there).hint("shuffle_replicate_nl"))

    def run(batches):
        known = {}
        for batch in batches:
            for row in range(batch.num_rows):
                take = lambda side: [batch.column(f"{side}_{x}")[row].as_buffer() for x in names.split()]  # noqa: E731, B023
                no = batch.column("q_no")[row].as_py()
                if no not in known:
                    known[no] = start(*(x.to_pybytes() for x in take("q")))
                known[no].meet(*take("d"))
        for x in known.values():
            at = x.result()
            for lo in range(0, len(at[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + 100_000]) for c in at], names=["qid", "did", "score"])

    found = pairs.mapInArrow(run, f"qid bigint, did bigint, score {score}")
    if there > 1:
        found.write.parquet(path := scratch(spark))
        found = queries.sparkSession.read.schema(found.schema).parquet(path)
    return found


def _not_below(s: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of what is not below its row's bound, as NaN is not. Few are, so cells are passed over by eights."""
    below = np.ones((len(s), -(-s.shape[1] // 8) * 8), bool)
    np.less(s, low[:, None], out=below[:, : s.shape[1]])
    eights = np.flatnonzero(below.view(np.uint64) != 0x0101010101010101)
    some = np.flatnonzero(~below.reshape(-1, 8)[eights])
    return np.divmod(eights[some >> 3] * 8 + (some & 7), below.shape[1])


def _pack_vectors(t: pa.Table) -> list[bytes]:
    vec = t.column("vec").combine_chunks()
    dims = pc.unique(pc.list_value_length(vec)).to_pylist()
    if len(dims) > 1:
        raise ValueError(f"vectors of {sorted(dims)} dimensions")
    return [t.column("id").to_numpy().tobytes(), vec.flatten().to_numpy(zero_copy_only=False).astype(float).tobytes()]


def _vectors(ids, vecs) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(vecs, float).reshape(len(ids), len(vecs) // 8 // len(ids))


class _DenseBlock:
    """A block of query vectors that meets blocks of vectors: scored in single precision, what may be good again in double."""

    def __init__(self, ids: bytes, vecs: bytes, k: int):
        self.id, self.v = _vectors(ids, vecs)
        self.single, self.norm = self._single(self.v)
        self.best = _Best(len(self.id), k)

    @staticmethod
    def _single(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(all="ignore"):
            return v.astype(np.float32), np.sqrt(np.einsum("ij,ij->i", v, v))

    def meet(self, ids, vecs) -> None:
        did, v = _vectors(ids, vecs)
        if self.v.shape[1] != v.shape[1]:
            raise ValueError(f"vectors of {self.v.shape[1]} and {v.shape[1]} dimensions")
        single, norm = self._single(v)
        with np.errstate(all="ignore"):
            for lo in range(0, len(v), 4096):
                some = slice(lo, lo + 4096)
                # what single precision can be off by, and half a unit of the last of 6 digits
                off = (v.shape[1] + 4) * 1.2e-7 * self.norm * norm[some].max() + 1e-6
                for at in range(0, len(self.v), 256):
                    self._tile(slice(at, at + 256), did[some], v[some], single[some], off[at : at + 256])
                if not np.isfinite(self.best.least).all():
                    self.best.settle()

    def _tile(self, at: slice, did: np.ndarray, v: np.ndarray, single: np.ndarray, off: np.ndarray) -> None:
        s, k = self.single[at] @ single.T, self.best.k
        least = self.best.least[at]
        low = np.where(np.isfinite(least), least - off - 1.2e-7 * np.abs(least), -np.inf)
        if s.shape[1] > k and np.isinf(low).any():
            low = np.fmax(low, np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] - 2 * off)
        x, y = _not_below(s, np.nan_to_num(low, nan=-np.inf, posinf=np.inf, neginf=-np.inf).astype(np.float32))
        x += at.start
        for lo in range(0, len(x), 16384):
            p, r = x[lo : lo + 16384], y[lo : lo + 16384]
            exact = np.round(np.einsum("ij,ij->i", self.v[p], v[r]), 6) + 0.0
            good = ~(exact < self.best.least[p])
            self.best.offer(p[good], did[r[good]], exact[good])

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.best.settle()
        at, did, score = self.best.parts[0] if self.best.parts else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        return self.id[at], did, score


def dense_topk(queries: DataFrame, vectors: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """The ``k`` vectors of largest inner product for each query, of tables (id, vec): qid, did, score (6 digits), rk.

    Blocks of queries meet blocks of vectors as bytes, and a task keeps ``k`` a query; no vector becomes Python objects.
    """
    rows = lambda df: df.where("vec is not null and id is not null").select(F.col("id").cast("bigint").alias("id"), F.col("vec").cast("array<double>").alias("vec"))
    start = lambda ids, vecs: _DenseBlock(ids, vecs, k)
    names = "ids vecs"
    packed = lambda df, most, side: _packed(df, most, _pack_vectors, names, side, _gathered)
    return ranked(_met(rows(queries), rows(vectors), block, 2 * block, packed, names, start, "double"), k)


def ranked(scored: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each query with their rank ``rk`` (from 1)."""
    w = Window.partitionBy("qid").orderBy(F.desc("score"), "did")
    return scored.withColumn("rk", F.row_number().over(w).cast("bigint")).where(F.col("rk") <= k)


def tokens(text: Column) -> Column:
    """A text's lower-case letter runs, in their order."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def token_lists(texts: DataFrame) -> DataFrame:
    """All tokens of ``texts(id, text)``, one row an id: id, tokens. Ids without tokens are left out."""
    one = texts.repartition("id").groupBy("id").agg(F.collect_list("text").alias("texts"))
    return one.select("id", F.flatten(F.transform("texts", tokens)).alias("tokens")).where(F.size("tokens") > 0)


def token_counts(texts: DataFrame) -> DataFrame:
    """Token counts of ``texts(id, text)`` over lower-case letter runs, every token of every text: token, id, w."""
    # a text is shuffled rather than each of its tokens
    each = texts.repartition("id").select("id", F.explode(tokens(F.col("text"))).alias("token"))
    return each.groupBy("token", "id").agg(F.count(F.lit(1)).alias("w"))


def max_pooled(weights: DataFrame) -> DataFrame:
    """Per text and token string the weight of the last id of that string, each id's weights pooled by maximum first.

    ``weights(id, token_id, token, w)``; blank tokens and weights not above 0 are dropped; weights are rounded to 4 digits.
    """
    pooled = weights.groupBy("id", "token_id", "token").agg(F.max("w").alias("w")).where("w > 0 and trim(token) != ''")
    return pooled.groupBy("id", F.trim("token").alias("token")).agg(F.round(F.max_by("w", "token_id"), 4).alias("w"))


def _by_text(posts: DataFrame) -> DataFrame:
    """Postings in the order of their texts, ``first`` being 1 at the first of each; shuffled only if not laid out by text."""
    first = F.row_number().over(Window.partitionBy("id").orderBy("id"))
    return posts.where("token is not null and id is not null").select("token", F.col("id").cast("bigint").alias("id"), "w").withColumn("first", first)


def _texts(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """A task's postings in tables of ``most`` whole texts, the last one smaller."""
    held, n = [], 0
    for batch in batches:
        at, first = 0, np.flatnonzero(batch.column("first").to_numpy() == 1)
        while n + len(first) > most:
            held.append(batch.slice(at, first[most - n] - at))
            yield pa.Table.from_batches(held).combine_chunks()
            at, first, held, n = first[most - n], first[most - n :], [], 0
        held.append(batch.slice(at))
        n += len(first)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers not below 0 in as few bytes as they allow; others in doubles."""
    return x.astype(np.min_scalar_type(int(x.max())) if x.dtype.kind in "iu" and len(x) and x.min() >= 0 else float)


def _pack_texts(t: pa.Table) -> list[bytes]:
    """Postings as texts, see ``_pack_weighted``."""
    start, token = np.flatnonzero(t.column("first").to_numpy() == 1), t.column("token").combine_chunks().dictionary_encode()
    return _pack_weighted(t.column("id").to_numpy()[start], start, token.dictionary.to_pylist(), token.indices.to_numpy(), t.column("w").to_numpy())


def _pack_lists(t: pa.Table) -> list[bytes]:
    """Lists of tokens as texts with the tokens' counts, see ``_pack_weighted``."""
    said = t.column("tokens").combine_chunks()
    token = said.flatten().dictionary_encode()
    row, n = np.repeat(np.arange(len(said)), pc.list_value_length(said).to_numpy()), len(token.dictionary)
    both, w = np.unique(row * n + token.indices.to_numpy(), return_counts=True)
    row, code = np.divmod(both, n)
    return _pack_weighted(t.column("id").to_numpy(), np.flatnonzero(np.diff(row, prepend=-1)), token.dictionary.to_pylist(), code, w)


def _pack_weighted(ids: np.ndarray, start: np.ndarray, tokens: list[str], code: np.ndarray, w: np.ndarray) -> list[bytes]:
    """Texts of falling norm: their ids, norms and ends, and each posting's token and weight."""
    size = np.diff(np.append(start, len(w)))
    norm = np.sqrt(np.add.reduceat(w.astype(float) ** 2, start))
    order = np.argsort(-norm, kind="stable")
    row = _ranges(start[order], size[order])
    code, w = _narrow(code[row]), _narrow(w[row])
    head = {"tokens": tokens, "code": code.dtype.str, "w": w.dtype.str}
    return [ids[order].tobytes(), norm[order].tobytes(), np.cumsum(size[order]).tobytes(), json.dumps(head).encode(), code.tobytes(), w.tobytes()]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)


class _SparseBlock:
    """A block of query texts that meets blocks of texts.

    A pair is scored only if a bound on its score allows: first the product of the norms (texts come by falling norm), then
    the products of the block's heaviest tokens plus, in each group of the other tokens, the product of the norms there.
    """

    HEAVY, GROUPS, TILE = 64, 32, 128

    def __init__(self, *block: bytes, k: int, whole: bool):
        self.id, self.norm, self.token, self.code, self.w, self.start, self.size = self._read(*block)
        self.whole, self.best, self.seen = whole, _Best(len(self.id), k), 0
        weight = np.bincount(self.code, self.w**2, len(self.token))
        self.place = np.empty(len(weight), int)
        self.place[np.argsort(-weight, kind="stable")] = np.arange(len(weight))
        self.place = np.where(self.place < self.HEAVY, self.place, self.HEAVY + self.place % self.GROUPS)
        self.short = self._short(np.repeat(np.arange(len(self.id)), self.size), self.code, self.w, len(self.id))
        self.positive = bool((self.w >= 0).all())

    @staticmethod
    def _read(ids, norms, ends, head, code, w, most: int | None = None) -> tuple:
        """A block's texts, or the first ``most`` of them."""
        h, ends = json.loads(bytes(head)), np.frombuffer(ends, np.int64)[:most]
        start, n = np.concatenate(([0], ends[:-1])), int(ends[-1])
        return (
            np.frombuffer(ids, np.int64)[:most], np.frombuffer(norms, float)[:most], pa.array(h["tokens"], pa.string()), np.frombuffer(code, h["code"], n).astype(int),
            np.frombuffer(w, h["w"], n).astype(float), start, ends - start,
        )

    def _short(self, row: np.ndarray, code: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
        place, dims = self.place[code], self.HEAVY + self.GROUPS
        x = np.bincount(row * dims + place, np.where(place < self.HEAVY, w, w * w), n * dims).reshape(n, dims)
        x[:, self.HEAVY :] = np.sqrt(x[:, self.HEAVY :])
        return x.astype(np.float32)

    def _asking(self, norm: np.ndarray | float) -> np.ndarray:
        """Of norms, or of one, whether a text of that norm may be among a query's best: a row a query."""
        return ~(self.norm * norm * (1 + 1e-9) < self.best.least) & (self.norm != 0)

    def _wanted(self, norm: np.ndarray) -> int:
        """How many of texts of these falling norms any query may want."""
        with np.errstate(all="ignore"):
            asks = self.best.least[self.norm != 0] / self.norm[self.norm != 0]
        most = np.flatnonzero(~(norm * (1 + 2e-9) < asks.min(initial=np.inf)))
        return most[-1] + 1 if len(most) else 0

    def meet(self, *block) -> None:
        # texts come by falling norm, so those that none wants are not even read
        if not (most := self._wanted(np.frombuffer(block[1], float))):
            return
        did, norm, token, code, w, start, size = self._read(*block, most)
        to = pc.fill_null(pc.index_in(token, value_set=self.token), -1).to_numpy().astype(int)[code]
        positive = self.positive and bool((w >= 0).all())
        for lo in range(0, len(did), self.TILE):
            least = self.best.least
            rows = np.flatnonzero(self._asking(norm[lo]))
            if not len(rows):
                break
            hi = min(lo + self.TILE, len(did))
            post = slice(start[lo], start[hi - 1] + size[hi - 1])
            here = np.flatnonzero(to[post] >= 0) + post.start
            doc = np.repeat(np.arange(hi - lo), size[lo:hi])[here - post.start]
            code_here, w_here = to[here], w[here]
            n = np.bincount(doc, minlength=hi - lo)
            at = np.cumsum(n) - n
            bound = self.short[rows] @ self._short(doc, code_here, w_here, hi - lo).T
            # what single precision can be off by
            off = (self.short.shape[1] + 8) * 1.2e-7 * self.norm[rows] * norm[lo]
            low = np.where(np.isinf(least[rows]), -np.inf, least[rows] - off - 1.2e-7 * np.abs(least[rows])).astype(np.float32)
            can = ~(bound < low[:, None])
            can &= bound > (0 if positive else -off[:, None])
            asking, asked = np.flatnonzero(can.any(axis=1)), np.flatnonzero(can.any(axis=0) & (n > 0))
            # whole weights add up to the same in either order, so the fewer of the two are gone through
            if self.whole and len(asked) < len(asking):
                for y in asked:
                    post = slice(at[y], at[y] + n[y])
                    self._score_text(rows[can[:, y]], did[lo + y], code_here[post], w_here[post])
            else:
                for i in asking:
                    self._score(rows[i], np.flatnonzero(can[i] & (n > 0)), did[lo:hi], code_here, w_here, at, n)
            self.seen += 1
            if self.seen & (self.seen - 1) == 0:
                self.best.settle()

    def _score(self, q: int, y: np.ndarray, did: np.ndarray, code: np.ndarray, w: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        if not len(y):
            return
        own = slice(self.start[q], self.start[q] + self.size[q])
        weight = np.zeros(len(self.token))
        np.add.at(weight, self.code[own], self.w[own])
        row = _ranges(at[y], n[y])
        s = np.add.reduceat(weight[code[row]] * w[row], np.cumsum(n[y]) - n[y])
        good = (s > 0) & ~(s < self.best.least[q])
        self.best.offer(np.full(good.sum(), q), did[y[good]], s[good])

    def _score_text(self, q: np.ndarray, did: int, code: np.ndarray, w: np.ndarray) -> None:
        weight = np.zeros(len(self.token))
        np.add.at(weight, code, w)
        if 2 * len(q) > len(self.id):
            s = np.add.reduceat(weight[self.code] * self.w, self.start)[q]
        else:
            row = _ranges(self.start[q], self.size[q])
            s = np.add.reduceat(weight[self.code[row]] * self.w[row], np.cumsum(self.size[q]) - self.size[q])
        good = (s > 0) & ~(s < self.best.least[q])
        self.best.offer(q[good], np.full(good.sum(), did), s[good])

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.best.settle()
        at, did, score = self.best.parts[0] if self.best.parts else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        return self.id[at], did, np.rint(score).astype(np.int64) if self.whole else score


def sparse_topk(queries: DataFrame, posts: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """The ``k`` texts of largest token product for each query, of postings (token, id, w) or of tokens (id, tokens), which
    count as often as they come, an id in one row: qid, did, score, rk.

    All shared tokens count; texts that cannot be among a query's best by their bounds are not scored. Blocks of queries meet
    blocks of texts, so a frequent token is never joined row by row. Ids are whole numbers. Sums are made in doubles, which
    are exact for whole weights while they stay below 2^53.
    """
    listed = lambda df: "tokens" in df.columns
    whole = all(listed(df) or isinstance(df.schema["w"].dataType, IntegralType) for df in (queries, posts))
    start = lambda *x: _SparseBlock(*x, k=k, whole=whole)
    names = "ids norms ends head code w"

    def packed(df: DataFrame, most: int, side: str) -> DataFrame:
        if listed(df):
            return _packed(df.where("id is not null").select(F.col("id").cast("bigint").alias("id"), "tokens"), most, _pack_lists, names, side, _gathered)
        return _packed(_by_text(df), most, _pack_texts, names, side, _texts)

    return ranked(_met(queries, posts, block, 2 * block, packed, names, start, "bigint" if whole else "double"), k)


def fused(dense: DataFrame, sparse: DataFrame, keep: int, k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists: qid, did, dense_rank, sparse_rank, rrf (12 digits), rk.

    Equal sums keep the order of the dense list, then of the sparse one.
    """
    d = dense.select("qid", "did", F.col("rk").alias("dense_rank"))
    s = sparse.select("qid", "did", F.col("rk").alias("sparse_rank"))
    part = lambda c: F.coalesce(1.0 / (k + F.col(c)), F.lit(0.0))
    both = d.join(s, ["qid", "did"], "full").withColumn("rrf", F.round(part("dense_rank") + part("sparse_rank"), 12))
    w = Window.partitionBy("qid").orderBy(F.desc("rrf"), F.col("dense_rank").asc_nulls_last(), F.col("sparse_rank").asc_nulls_last())
    return both.withColumn("rk", F.row_number().over(w).cast("bigint")).where(F.col("rk") <= keep)


def overlap_reranked(candidates: DataFrame, query_words: DataFrame, doc_words: DataFrame, keep: int) -> DataFrame:
    """Candidates (qid, did, rk) in the order of the stand-in reranker: the sigmoid of shared words less 3, 6 digits.

    ``query_words(qid, qwords)`` and ``doc_words(did, dwords)`` hold distinct words, which are not null and have no line
    breaks. Ties keep the given rank. Gives qid, did, rerank, new_rk.
    """
    # a question's words are shuffled once a candidate, as one text half the size of a list
    lines = query_words.select("qid", F.array_join("qwords", "\n").alias("qwords"))
    both = candidates.join(lines, "qid").join(doc_words, "did")
    score = F.round(1 / (1 + F.exp(3.0 - F.size(F.array_intersect(F.split("qwords", "\n"), "dwords")))), 6)
    scored = both.select("qid", "did", "rk", score.alias("rerank"))
    w = Window.partitionBy("qid").orderBy(F.desc("rerank"), "rk")
    return scored.withColumn("new_rk", F.row_number().over(w).cast("bigint")).where(F.col("new_rk") <= keep).drop("rk")


def best_cached(queries: DataFrame, cached: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """The most similar cached vector of each query and whether it is a hit: qid, best_id, sim, hit."""
    unit = lambda df: df.select("id", normalised(F.col("vec")).alias("vec"))
    best = dense_topk(unit(queries), unit(cached), 1, block)
    return best.select("qid", F.col("did").alias("best_id"), F.col("score").alias("sim"), (F.col("score") >= threshold).alias("hit"))

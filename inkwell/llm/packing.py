"""Problem 8: documents packed into containers of a fixed token capacity.

Documents go through in descending size; each joins the container of lowest cost (linear plus quadratic attention cost of
what it holds) among those with room for it, and a new container is opened when none has. A container that the document
fills but for a ``SLIVER`` of the capacity comes before the cheapest one, which leaves less unused. Sizes are the tokens
of a public vocabulary, or the offline count. Only documents above the capacity are cut, at natural boundaries
(``splitting``). Documents are dealt by hash to shards of about ``shard_rows``
rows, so a task's rows are bounded whatever the corpus; the containers of a shard are its own, at most a part of one
container a shard is lost by that.

Nulls: a null text is in no container; an empty one takes one token. Repeated ids are packed each by itself.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.batches import map_columns
from inkwell.llm.bpe import counter
from inkwell.llm.splitting import CHARS_A_TOKEN, split_items, split_spans

SHARD_ROWS = 20_000
#: Cost of a document of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
#: The part of the capacity that may stay empty where a document fills a container.
SLIVER = 1 / 64


def assign(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each size; sizes are at most ``capacity`` and come in descending order.

    A heap of containers by cost for each amount of room left, and a tree over the amounts with the lowest cost below
    each node, find the cheapest container with enough room in the logarithm of the capacity.
    """
    levels, sliver = 1 << capacity.bit_length(), int(capacity * SLIVER)
    none = (float("inf"), -1)
    heaps: list[list[tuple[float, int]]] = [[] for _ in range(levels)]
    best = [none] * (2 * levels)

    def refresh(room: int) -> None:
        node = room + levels
        best[node] = heaps[room][0] if heaps[room] else none
        while node > 1:
            node >>= 1
            best[node] = min(best[2 * node], best[2 * node + 1])

    n_open = -(-int(sizes.sum()) // capacity)
    room_of = [capacity] * n_open
    heaps[capacity] = [(0.0, i) for i in range(n_open)]
    refresh(capacity)
    out = np.empty(len(sizes), dtype=np.int64)
    for k, size in enumerate(sizes.tolist()):
        lo, hi, found = size + levels, 2 * levels, none
        while lo < hi:
            if lo & 1:
                found, lo = min(found, best[lo]), lo + 1
            lo, hi = lo >> 1, hi >> 1
        # a container that this document fills comes first
        filled = next((r for r in range(size, min(size + sliver, capacity - 1) + 1) if heaps[r]), -1)
        cost, at = heaps[filled][0] if filled >= 0 else found
        if at < 0:
            cost, at = 0.0, len(room_of)
            room_of.append(capacity)
        else:
            heapq.heappop(heaps[room_of[at]])
            refresh(room_of[at])
        room_of[at] -= size
        heapq.heappush(heaps[room_of[at]], (cost + LINEAR * size + QUADRATIC * size * size, at))
        refresh(room_of[at])
        out[k] = at
    return out


def counted_spans(text: str, capacity: int, count: Callable[[str], int]) -> list[tuple[int, int, int]]:
    """Begin, end and size of the pieces of a text, each of at most ``capacity`` by ``count``, cut at natural boundaries.

    Characters stand in for tokens in the measure of the text itself; a piece that is still too large is cut again.
    """
    done, todo = [], [(0, len(text))]
    while todo:
        a, b = todo.pop()
        n = max(1, count(text[a:b]))
        if n <= capacity or b - a <= 1:
            done.append((a, b, n))
            continue
        room = max(1, min(int((b - a) * 0.97 * capacity / n), b - a - 1) // CHARS_A_TOKEN)
        spans = split_spans(text[a:b], room, 0)
        if len(spans) == 1:
            spans = [(0, (b - a) // 2), ((b - a) // 2, b - a)]
        todo.extend((a + x, a + y) for x, y in reversed(spans))
    return done


def vocabulary_pieces(documents: DataFrame, capacity: int, vocabulary: str) -> DataFrame:
    """Pieces of ``documents(doc_id, text)`` by the tokens of a public vocabulary: doc_id, piece_no, n_pieces, tokens."""

    def kernel(c: dict, bpe) -> dict:
        out: dict[str, list] = {k: [] for k in ("doc_id", "piece_no", "n_pieces", "tokens")}
        for i, text in zip(c["doc_id"], c["text"]):
            spans = counted_spans(text, capacity, bpe.count)
            for k, v in zip(out, ([i] * len(spans), range(1, len(spans) + 1), [len(spans)] * len(spans), [n for _, _, n in spans])):
                out[k].extend(v)
        return out

    schema = "doc_id bigint, piece_no bigint, n_pieces bigint, tokens bigint"
    return map_columns(documents.where(F.col("text").isNotNull()), kernel, schema, lambda: counter(vocabulary))


def pack(documents: DataFrame, capacity: int, shard_rows: int = SHARD_ROWS, vocabulary: str | None = None) -> DataFrame:
    """Containers for ``documents(doc_id, text)``: doc_id, piece_no, n_pieces, tokens, container (a string id).

    Sizes are the tokens of the vocabulary file, without one the offline count.
    """
    documents = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if vocabulary:
        pieces = vocabulary_pieces(documents, capacity, vocabulary)
    else:
        items = documents.select("doc_id", "text", F.lit(capacity).alias("max_tokens"), F.lit(0).alias("overlap_tokens"))
        pieces = split_items(items, ["doc_id"]).select("doc_id", "piece_no", "n_pieces", "tokens")
    shards = max(1, -(-documents.count() // shard_rows))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(shards)))

    def one(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["tokens", "doc_id", "piece_no"], ascending=[False, True, True], kind="stable")
        at = assign(shard["tokens"].to_numpy(), capacity)
        name = shard["shard"].astype(str) + "-" + pd.Series(at, index=shard.index).astype(str)
        return shard[["doc_id", "piece_no", "n_pieces", "tokens"]].assign(container=name)

    schema = "doc_id bigint, piece_no bigint, n_pieces bigint, tokens bigint, container string"
    return dealt.groupBy("shard").applyInPandas(one, schema)

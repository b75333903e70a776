"""Problem 1: groups of rows whose texts differ by small edits, by DartMinHash signatures and banded joins.

A text is the weighted set of its word n-grams. Darts are thrown at the half-open region [0, weight) x [0, inf) of each
element by a Poisson process that depends on the element's hash alone; each dart falls on one coordinate of the
signature, and the earliest dart of a coordinate is kept. Two texts agree at a coordinate with the probability of their
weighted Jaccard similarity. A text of total weight W throws about k ln k + 2k darts; where a coordinate stays empty, the
reach is doubled, so signatures are always full.

Rows of one set of n-grams are one class before any join. Representatives meet where a band of coordinates is equal, and
each pair that meets is verified on the exact sets. ``similar_pairs`` loses a pair at similarity 0.6 with probability
0.56 % (64 bands of 5), at 0.65 0.04 %, at 0.7 0.001 %. A band is a hash of 48 bits: representatives that share nothing
meet by chance once in 2^48 / 64 pairs, so chance meetings stay fewer than the texts up to some billions of them.

Nulls: null texts, and texts below ``min_words`` words, have no class and no pair. A text shorter than the n-gram is one
element, its words. Equal texts share a class. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.batches import map_columns
from inkwell.llm.words import WordHashes, hashed_words, mix, rolling
from inkwell.llm.bit_filter import bit_filter
from inkwell.llm.components import connected_components
from inkwell.sources.shared import materialise

BANDS, ROWS_A_BAND = 64, 5
SEED = np.uint64(0x5DEECE66D)
#: Sets whose darts are thrown at once: their arrays then stay in a core's cache.
THROW_SETS = 128
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: list[str | None], memo: WordHashes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-gram hashes (48 bits) of at most 65 536 texts, sorted within each; where each begins; its word count."""
    h, starts = hashed_words(texts, memo)
    n_words = np.diff(starts)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), n_words)
    r = rolling(h, width)
    inside = owner[: len(r)] == owner[len(h) - len(r) :]
    keys = [(owner[: len(r)][inside] << np.uint64(48)) | (r[inside] >> np.uint64(16))]
    for i in np.flatnonzero((n_words > 0) & (n_words < width)):
        few = h[starts[i] : starts[i + 1]]
        keys.append((np.uint64(i) << np.uint64(48)) | (rolling(few, len(few)) >> np.uint64(16)))
    key = np.sort(np.concatenate(keys))
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    begin = np.searchsorted(key, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(48))
    if len(texts) == 1 << 16:
        begin[-1] = len(key)
    return key & np.uint64((1 << 48) - 1), begin, n_words


def signatures(elements: np.ndarray, starts: np.ndarray, k: int, weights: np.ndarray | None = None) -> np.ndarray:
    """The DartMinHash signature of each set: one row of ``k`` darts; rows of empty sets hold one constant.

    The darts of an element in the unit strip ``s`` of weight, [s, s + 1), arrive at times with exponential gaps; a dart
    counts if its weight coordinate is below the element's weight. Without weights each element weighs 1.
    """
    parts = []
    for lo in range(0, len(starts) - 1, THROW_SETS):
        at = starts[lo : lo + THROW_SETS + 1]
        part = slice(at[0], at[-1])
        parts.append(_throw(elements[part], at - at[0], k, None if weights is None else weights[part]))
    return np.concatenate(parts) if parts else np.zeros((0, k), dtype=np.uint64)


def _throw(elements: np.ndarray, starts: np.ndarray, k: int, weights: np.ndarray | None) -> np.ndarray:
    n_sets = len(starts) - 1
    owner = np.repeat(np.arange(n_sets), np.diff(starts))
    base = mix(elements + SEED)
    inside = None
    total = np.diff(starts).astype(float)
    if weights is not None:
        w = np.asarray(weights, dtype=float)
        total = np.bincount(owner, w, n_sets)
        strips = np.ceil(w).astype(np.int64)
        strip = np.arange(strips.sum()) - np.repeat(np.cumsum(strips) - strips, strips)
        owner, inside = np.repeat(owner, strips), np.repeat(w, strips) - strip
        base = np.where(strip == 0, np.repeat(base, strips), mix(np.repeat(base, strips) + strip.astype(np.uint64)))
    out = np.full((n_sets, k), _EMPTY)
    reach = (k * np.log(k) + 2 * k) / np.maximum(total, 1e-12)
    todo = total > 0
    while todo.any():
        live = np.flatnonzero(todo[owner])
        x, own = base[live], owner[live]
        limit, at = reach[own], np.zeros(len(live))
        room = None if inside is None else inside[live]
        first = np.full(n_sets * k, _EMPTY)
        while len(x):
            x = mix(x + SEED)
            at = at - np.log(((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52)
            ok = at <= limit
            x, at, own, limit = x[ok], at[ok], own[ok], limit[ok]
            y = x * np.uint64(0xA0761D6478BD642F)
            cell = own * k + ((y >> np.uint64(40)) % np.uint64(k)).astype(np.int64)
            dart = ((at * 2.0**20).astype(np.uint64) << np.uint64(24)) | (mix(y) & np.uint64(0xFFFFFF))
            if room is not None:
                room = room[ok]
                hit = (mix(y + SEED) >> np.uint64(12)).astype(np.float64) * 2.0**-52 < room
                cell, dart = cell[hit], dart[hit]
            np.minimum.at(first, cell, dart)
        full = first.reshape(n_sets, k)
        done = todo & (full != _EMPTY).all(axis=1)
        out[done] = full[done]
        todo &= ~done
        reach[todo] *= 2
    return out


def sketch(rows: DataFrame, width: int, min_words: int, bands: int = BANDS, per_band: int = ROWS_A_BAND) -> DataFrame:
    """Of ``rows(tbl, id, text)``: tbl, id, c1 and c2 (two hashes of the exact set), and the bands of its signature (bands, fine)."""

    def kernel(c: dict, memo: WordHashes) -> dict:
        s, starts, n_words = shingle_sets(c["text"], memo, width)
        keep = np.flatnonzero(n_words >= max(1, min_words))
        sig = signatures(s, starts, bands * per_band)[keep]
        band = np.zeros((len(keep), bands), dtype=np.uint64)
        for j in range(per_band):
            band = mix(band * np.uint64(0x9E3779B97F4A7C15) + sig[:, j::per_band])
        sums = np.zeros((2, len(s) + 1), dtype=np.uint64)
        for j in (0, 1):
            np.cumsum(mix(s + np.uint64(77 + j)), out=sums[j, 1:])
        ids = (sums[:, starts[1:]] - sums[:, starts[:-1]]).view(np.int64)
        return {
            "tbl": [c["tbl"][i] for i in keep],
            "id": [c["id"][i] for i in keep],
            "c1": ids[0, keep],
            "c2": ids[1, keep],
            # 48 bits of a band, in the narrowest columns
            "bands": list((band >> np.uint64(32)).astype(np.uint32).view(np.int32)),
            "fine": list((band >> np.uint64(16)).astype(np.uint16).view(np.int16)),
        }

    schema = "tbl string, id bigint, c1 bigint, c2 bigint, bands array<int>, fine array<smallint>"
    return map_columns(rows.where(F.col("text").isNotNull()), kernel, schema, WordHashes)


def classes(sketched: DataFrame) -> DataFrame:
    """Rows of equal sets put together: tbl, rep (smallest id), bands, fine."""
    return sketched.groupBy("tbl", "c1", "c2").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"), F.first("fine").alias("fine"))


def candidate_pairs(reps: DataFrame) -> DataFrame:
    """Pairs of representatives with an equal band: tbl, rep_a < rep_b, each once."""
    band = reps.select("tbl", "rep", F.posexplode(F.arrays_zip("bands", "fine")).alias("no", "hash"))
    keyed = band.select("tbl", "rep", F.xxhash64("tbl", "no", "hash.bands", "hash.fine").alias("key"))
    a = keyed.select("tbl", "key", F.col("rep").alias("rep_a"))
    b = keyed.select(F.col("tbl").alias("tbl_b"), F.col("key").alias("key_b"), F.col("rep").alias("rep_b"))
    met = a.join(b, (F.col("key") == F.col("key_b")) & (F.col("tbl") == F.col("tbl_b")) & (F.col("rep_a") < F.col("rep_b")))
    return met.select("tbl", "rep_a", "rep_b").distinct()


def verified(rows: DataFrame, candidates: DataFrame, width: int, similarity: float) -> DataFrame:
    """The candidates whose exact similarity reaches the bound: tbl, rep_a, rep_b, similarity.

    Only texts of representatives that met another are cut into n-grams again; a bit table of bounded size tells them, so
    no text is shuffled. The sets are of 32-bit hashes: two n-grams of a pair share one with a probability below 1e-5 a
    thousand n-grams.
    """
    def kernel(c: dict, memo: WordHashes) -> dict:
        g, starts, _ = shingle_sets(c["text"], memo, width)
        short = (g >> np.uint64(16)).astype(np.uint32).view(np.int32)
        return {"tbl": c["tbl"], "id": c["id"], "grams": [short[a:b] for a, b in zip(starts[:-1], starts[1:])]}

    met = bit_filter(candidates.select("tbl", F.explode(F.array("rep_a", "rep_b")).alias("id")), ["tbl", "id"], 2 * candidates.count())
    sets = map_columns(met(rows), kernel, "tbl string, id bigint, grams array<int>", WordHashes)
    a = sets.select("tbl", F.col("id").alias("rep_a"), F.col("grams").alias("grams_a"))
    b = sets.select("tbl", F.col("id").alias("rep_b"), F.col("grams").alias("grams_b"))
    both = candidates.join(a, ["tbl", "rep_a"]).join(b, ["tbl", "rep_b"])
    common = F.size(F.array_intersect("grams_a", "grams_b"))
    share = common / (F.size("grams_a") + F.size("grams_b") - common)
    return both.select("tbl", "rep_a", "rep_b", share.alias("similarity")).where(F.col("similarity") >= similarity)


def similar_pairs(rows: DataFrame, width: int, similarity: float, min_words: int) -> tuple[DataFrame, DataFrame]:
    """Of ``rows(tbl, id, text)``: membership (tbl, id, rep) and the verified pairs between representatives."""
    sketched = materialise(sketch(rows, width, min_words))
    firsts = sketched.groupBy("tbl", "c1", "c2").agg(F.min("id").alias("rep"))
    members = sketched.select("tbl", "c1", "c2", "id").join(firsts, ["tbl", "c1", "c2"])
    candidates = materialise(candidate_pairs(classes(sketched)))
    return members.select("tbl", "id", "rep"), verified(rows, candidates, width, similarity)


def expanded(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """All pairs of rows, copies included: tbl, id_a < id_b. For results that must name every pair."""
    a = members.select("tbl", F.col("rep").alias("rep_a"), F.col("id").alias("x"))
    b = members.select("tbl", F.col("rep").alias("rep_b"), F.col("id").alias("y"))
    across = pairs.select("tbl", "rep_a", "rep_b").join(a, ["tbl", "rep_a"]).join(b, ["tbl", "rep_b"])
    within = a.join(b.withColumnRenamed("rep_b", "rep_a"), ["tbl", "rep_a"]).where(F.col("x") < F.col("y"))
    return across.select("tbl", "x", "y").unionByName(within.select("tbl", "x", "y")).select(
        "tbl", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")
    )


def groups(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """Each row with its group: tbl, row_id, class_id, group_id (smallest id linked to it), n_links of its class."""
    node = lambda c: F.concat_ws(":", "tbl", F.lpad(F.col(c).cast("string"), 20, "0"))
    edges = materialise(pairs.select(node("rep_a").alias("a"), node("rep_b").alias("b")))
    root = connected_components(edges)
    links = edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    joined = members.withColumn("node", node("rep")).join(root, "node", "left").join(links, "node", "left")
    return joined.select(
        "tbl",
        F.col("id").alias("row_id"),
        F.col("rep").alias("class_id"),
        F.coalesce(F.substring_index("root", ":", -1).cast("bigint"), F.col("rep")).alias("group_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )

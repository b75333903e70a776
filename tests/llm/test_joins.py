from hypothesis import given, settings
from hypothesis import strategies as st

from inkwell.llm import metric_join
from inkwell.llm.bit_filter import bit_filter
from inkwell.llm.components import connected_components, pointer_roots
from inkwell.llm.metric_join import radius_pairs


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (10, 11), (12, 11), (5, 5), (None, 1)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got[3] == 1 and got[12] == 10 and all(got[100 + i] == 100 for i in range(41)) and 5 not in got
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


@given(st.text("abc", max_size=9), st.text("abcd", max_size=9))
def test_bit_parallel_edits_equal_the_table(a, b):
    assert metric_join.edits(a, b) == edits(a, b)


def test_pivots_lie_apart():
    assert metric_join.far_apart(["aaaa", "aaab", "bbbbbbbb", "aabb"], 3, 1) == ["aaaa", "bbbbbbbb", "aabb"]


def test_pointers_are_followed_to_the_end(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(40)] + [("x", "y")]
    got = {r.node: r.root for r in pointer_roots(spark.createDataFrame(chain, "node string, to string")).collect()}
    assert got == {f"n{i:03d}": "n040" for i in range(40)} | {"x": "y"}
    assert pointer_roots(spark.createDataFrame([], "node string, to string")).count() == 0


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=7), min_size=1, max_size=25), st.integers(1, 2))
def test_metric_join_is_exact(spark, words, radius):
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "s string")
    got = {(r.x, r.y, r.distance) for r in radius_pairs(df, "s", radius).collect()}
    distinct = sorted(set(words))
    assert got == {(a, b, edits(a, b)) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if edits(a, b) <= radius}


def test_bit_filter_drops_no_key(spark):
    rows = spark.createDataFrame([("t", i, "x", "y") for i in range(500)], "tbl string, id long, bits string, bucket_no string")
    keys = rows.where("id % 50 = 0").select("tbl", "id")
    kept = {r.id for r in bit_filter(keys, ["tbl", "id"], 10)(rows).collect()}
    assert {i for i in range(500) if i % 50 == 0} <= kept and len(kept) < 50
    assert bit_filter(keys.where("false"), ["tbl", "id"], 0)(rows).count() == 0

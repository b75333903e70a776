import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from inkwell.operators import pages as H
from inkwell.sources import files as I
from inkwell.sources import sinks as K
from inkwell.sources import web

DOC = StructType().add("url", StringType()).add("word_count", LongType())


@pytest.fixture
def folder(tmp_path):
    for name, text in (("b.json", '{\n "url": "u/b",\n "word_count": 2\n}'), ("a.json", '{"url": "u/a", "more": [1]}'), ("bad.json", '{"url": '), ("empty.json", "")):
        (tmp_path / "docs").mkdir(exist_ok=True)
        (tmp_path / "docs" / name).write_text(text)
    for parent in ("vol1", "vol2"):
        (tmp_path / "deep" / parent).mkdir(parents=True)
        (tmp_path / "deep" / parent / "x.json").write_text(json.dumps({"url": parent, "word_count": 1}))
    (tmp_path / "deep" / "_old").mkdir()
    return tmp_path


def test_json_folders_skip_bad_files(spark, folder):
    docs = I.documents_in(spark, f"{folder}/docs", DOC)
    assert [(r.file, r.url, r.word_count) for r in I.by_slug(docs, "b").collect()] == [("b.json", "u/b", 2)]
    assert [(r.file, r.url) for r in I.paths_and_urls(docs).collect()] == [("a.json", "u/a"), ("b.json", "u/b")]
    assert {r.file for r in I.unreadable_files(spark, f"{folder}/docs", DOC).collect()} == {"bad.json"}
    assert [r.url for r in I.documents_in(spark, f"{folder}/deep", DOC, parent="vol2").collect()] == ["vol2"]
    assert I.collections_in(spark, f"{folder}/deep", ["vol2", "gone"]) == ["vol2", "vol1"]
    assert [r.url for r in I.first_found(docs, docs.withColumn("url", F.lit("x")), F.col("url") == "x").limit(9).collect()] == ["x", "x"]
    assert [r.url for r in I.first_found(docs, docs, F.col("url") == "u/a").collect()] == ["u/a"]


def test_lines_progress_versions_and_encodings(spark, tmp_path):
    (tmp_path / "lines.jsonl").write_text('{"url": "a", "word_count": 1}\n\n{"url": \n{"url": "é"}\n')
    assert [r.url for r in I.read_json_lines(spark, f"{tmp_path}/lines.jsonl", DOC).collect()] == ["a", "é"]
    assert [r.line for r in I.bad_lines(spark, f"{tmp_path}/lines.jsonl", DOC).collect()] == ['{"url": ']
    assert I.read_progress(spark, f"{tmp_path}/none").count() == 0
    assert I.first_existing(spark, [f"{tmp_path}/none", f"{tmp_path}/lines.jsonl"]).endswith("lines.jsonl")
    with pytest.raises(FileNotFoundError):
        I.first_existing(spark, [f"{tmp_path}/none"])
    with pytest.raises(FileNotFoundError):
        K.read_version(spark, f"{tmp_path}/t")
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, url string")
    first = K.write_version(df, f"{tmp_path}/t")
    K.write_version(K.read_version(spark, f"{tmp_path}/t").where("id = 1"), f"{tmp_path}/t")
    assert K.read_version(spark, f"{tmp_path}/t").count() == 1 and spark.read.parquet(first).count() == 2
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.htm").write_bytes('<meta charset="iso-8859-1"> ü'.encode("latin-1"))
    (tmp_path / "p" / "b.htm").write_bytes("<p>ü".encode())
    got = {r.file: (r.declared, r.utf8, r.advice) for r in I.encoding_report(spark, f"{tmp_path}/p").collect()}
    assert got == {"a.htm": ("iso-8859-1", False, "windows-1252"), "b.htm": (None, True, "utf-8")}


def test_tries_and_waits():
    waits, said = [], iter([(503, {}, b""), (429, {}, b""), (200, {}, b"ok")])
    assert web.fetched("u", lambda u, t: next(said), sleep=waits.append) == (200, "ok", 3) and waits == [2.0, 4.0]

    def broken(url, timeout):
        raise OSError

    assert web.fetched("u", broken, sleep=waits.append) == (0, web.EXHAUSTED, 3)
    assert web.fetched("u", lambda u, t: (404, {}, b"x")) == (404, "", 1)
    assert web.decoded({}, "ü".encode("latin-1")) == "ü" and web.decoded({"content-type": "text/html; charset=nonsense"}, "ü".encode()) == "ü"


def test_pages_and_windows(spark):
    web.register(spark)
    urls = ["http://a/1", "http://a/missing", "http://b/1", "http://a/1"]
    pages = spark.read.format("inkwell_pages").option("urls", json.dumps(urls)).option("transport", "tests.fake_web:get").option("delay", 0).load()
    assert sorted((r.url, r.status, r.html, r.tries) for r in pages.collect()) == [("http://a/1", 200, "<p>Müller</p>", 1), ("http://a/missing", 404, "", 1), ("http://b/1", 200, "<p>Müller</p>", 1)]
    busy = spark.read.format("inkwell_pages").option("urls", '["http://a/busy"]').option("transport", "tests.fake_web:get").option("wait", 0).option("tries", 1).load()
    assert [(r.status, r.html) for r in busy.collect()] == [(0, web.EXHAUSTED)]
    options = {"base": "http://w/", "last": 40, "stretch": 6, "delay": 0, "transport": "tests.fake_web:get"}
    windows = spark.read.format("inkwell_windows").options(**options).load()
    rows = H.window_pages(windows)
    # windows of neighbouring stretches overlap; each page is there once
    assert sorted(r.seq for r in rows.collect()) == list(range(1, 15))
    later = spark.read.format("inkwell_windows").options(**options, startDate="1951-02-06").load()
    assert min(r.seq for r in H.window_pages(later).collect()) == 5
    turns = [(r.date_iso, r.turn_no, r.speaker, r.text, r.page_number) for r in H.window_turns(rows).where("date_iso = '1951-02-05'").orderBy("turn_no").collect()]
    # a label without words is no label; a turn goes on over the page's end and has the page it ends on
    assert turns[0] == ("1951-02-05", 1, "MR. A", "said 1 and on DR. B: before", 102) and turns[1][3:] == ("said 2 and on DR. B: before", 103) and len(turns) == 5
    days = {r.date_iso: r for r in H.window_documents(rows).collect()}
    assert days["1951-02-05"].page_numbers == [101, 102, 103, 104, 105] and days["1951-02-05"].slug == "02-05-51" and days["1951-02-05"].speakers[0] == "MR. A"
    assert H.window_documents(rows.where("false")).count() == 0

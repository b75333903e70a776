from inkwell.streaming import cache, crawl


def test_crawl_stream_takes_up_where_it_ended(spark, tmp_path):
    log = spark.createDataFrame(
        [("u1", "c", "failed", "2025-01-01 00:10:00"), ("u1", "c", "ok", "2025-01-01 00:20:00"), ("u1", "c", "ok", "2025-01-01 01:20:00"), (None, "c", "ok", None), ("u2", "d", "ok", "2025-01-01 00:30:00")],
        "url string, collection string, status string, at string",
    ).selectExpr("url", "collection", "status", "cast(at as timestamp) logged_at")
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    log.coalesce(1).write.parquet(src)
    for _ in range(2):  # the second run finds nothing new
        crawl.write_once(crawl.first_successes(crawl.crawl_stream(spark, src, log.schema)), out, ck).awaitTermination()
        assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["u1", "u2"]
    q = crawl.hourly_counts(crawl.crawl_stream(spark, src, log.schema)).writeStream.format("memory").queryName("hourly").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(str(r.begin)[11:13], r.collection): (r.tries, r.ok) for r in spark.table("hourly").collect()}
    assert got == {("00", "c"): (2, 1), ("01", "c"): (1, 1), ("00", "d"): (1, 1)}


def test_cached_answers(spark, tmp_path):
    rows = spark.createDataFrame([("k", 2, "second"), ("k", 1, "first"), ("m", 3, "other"), (None, 4, "x")], "key string, qid long, answer string")
    src = str(tmp_path / "q")
    rows.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(rows.schema).parquet(src)
    q = cache.cached_answers(stream, idle_ms=None).writeStream.format("memory").queryName("served").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = {r.qid: (r.answer, r.hit) for r in spark.table("served").collect()}
    assert got == {1: ("first", False), 2: ("first", True), 3: ("other", False)}

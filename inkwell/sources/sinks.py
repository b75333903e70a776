"""Sinks: documents, passages, indexes, logs, reports, and versions of a table that is being read.

All writes are Spark jobs to a folder on a shared file system. A table that is read while it is rewritten gets a new version;
a small pointer file is then switched, so readers see the old version or the new one. Writing an empty table writes its
schema, or an empty folder.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators.retrieval import normalised
from inkwell.sources.files import TIMES, exists


def write_documents(documents: DataFrame, folder: str, form: str = "json", by: str = "collection") -> None:
    """Documents below one folder a collection, replacing what was there."""
    documents.write.mode("overwrite").partitionBy(by).format(form).save(folder)


def append_log(rows: DataFrame, folder: str) -> None:
    """Rows added to a CSV log; every file has the header."""
    rows.write.mode("append").option("header", True).option("escape", '"').option("timestampFormat", TIMES).option("timestampNTZFormat", TIMES).csv(folder)


def write_failures(log: DataFrame, folder: str) -> None:
    """The urls of this run that never succeeded, with their last status, as JSON."""
    last = log.groupBy("url").agg(F.max_by("status", F.struct("logged_at", "log_id")).alias("status"), F.max(F.col("status") == "ok").alias("ok"))
    last.where("not ok").select("url", "status").write.mode("overwrite").json(folder)


def write_summary(documents: DataFrame, folder: str) -> None:
    """Documents and urls a collection as JSON, and the sorted list of urls as text."""
    documents.groupBy("collection").agg(F.count(F.lit(1)).alias("documents"), F.count_distinct("url").alias("urls")).write.mode("overwrite").json(f"{folder}/summary")
    documents.select("url").where("url is not null").distinct().sort("url").write.mode("overwrite").text(f"{folder}/urls")


def write_passages(passages: DataFrame, folder: str, dry_run: bool = False, append: bool = False) -> DataFrame:
    """Passages as JSON lines; a dry run writes nothing. Gives passages and tokens by collection, either way."""
    if not dry_run:
        passages.write.mode("append" if append else "overwrite").json(folder)
    return passages.groupBy("collection").agg(F.count(F.lit(1)).alias("passages"), F.sum("token_count").cast("bigint").alias("tokens"))


def write_index(vectors: DataFrame, postings: DataFrame, metadata: DataFrame, folder: str, append: bool = False) -> None:
    """Dense vectors (id, vec) of unit length, postings (token, id, w) sorted by token, and metadata, each as Parquet.

    Postings are laid out by token, so that a query's tokens are found by the files' statistics.
    """
    mode = "append" if append else "overwrite"
    vectors.select("id", normalised(F.col("vec")).alias("vec")).where("vec is not null").write.mode(mode).parquet(f"{folder}/dense")
    postings.select("token", "id", "w").repartitionByRange("token").sortWithinPartitions("token", "id").write.mode(mode).parquet(f"{folder}/sparse")
    metadata.write.mode(mode).parquet(f"{folder}/metadata")


def write_sparse_lines(weights: DataFrame, metadata: DataFrame, folder: str, append: bool = False) -> None:
    """Token weights a passage (id, weights as a map) and metadata as JSON lines; characters stay as they are."""
    mode = "append" if append else "overwrite"
    pairs = F.map_from_entries(F.array_sort(F.collect_list(F.struct("token", "w"))))
    weights.groupBy("id").agg(pairs.alias("weights")).write.mode(mode).json(f"{folder}/sparse")
    metadata.write.mode(mode).json(f"{folder}/metadata")


def append_progress(done: DataFrame, folder: str, column: str) -> None:
    """Ids that are done, one a line, added to the list."""
    done.select(F.col(column).cast("string").alias("value")).where("value is not null").write.mode("append").text(folder)


def write_report(sections: dict[str, DataFrame], folder: str) -> None:
    """One row of JSON that holds each section, a small table, as a list; sections are audits, whose size is that of their groups."""
    parts = [df.agg(F.collect_list(F.struct(*[F.col(c) for c in df.columns])).alias(name)) for name, df in sections.items()]
    report = parts[0]
    for p in parts[1:]:
        report = report.join(p, F.lit(True))  # one row each
    report.write.mode("overwrite").json(folder)


def write_stats(passages: DataFrame, folder: str, seconds: float) -> None:
    """Passages by collection, in all, and a second (null where no time passed), as one row of JSON."""
    total = F.count(F.lit(1))
    by = passages.groupBy("collection").agg(total.alias("n"))
    row = by.agg(F.sum("n").alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("collection", "n")))).alias("by_collection"))
    row.select("*", F.lit(seconds).alias("seconds"), F.when(F.lit(seconds) > 0, F.round(F.col("total") / F.lit(seconds), 1)).alias("per_second")).write.mode("overwrite").json(folder)


def log_of_documents(documents: DataFrame) -> DataFrame:
    """A crawl log made anew from the documents: one row each, flags joined by a bar."""
    return documents.select(
        "url", "collection", F.lit("ok").alias("status"), "char_count", F.array_join("validation_flags", "|").alias("validation_flags"), "scrape_timestamp"
    )


def throughput(done: Column, total: Column, seconds: Column) -> tuple[Column, Column]:
    """Items a second (one digit) and the seconds that are left; null without time or items."""
    rate = F.when((seconds > 0) & (done > 0), done / seconds)
    return F.round(rate, 1), F.round((total - done) / rate, 1)


def write_version(df: DataFrame, folder: str, form: str = "parquet") -> str:
    """A new version of a table below ``folder``; the pointer is switched when it is whole. Gives the version's path.

    The old version stays as the backup, and may be what ``df`` reads.
    """
    spark = df.sparkSession
    path = f"{folder}/v{time.time_ns()}"
    df.write.format(form).save(path)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    pointer, fresh = (jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}") for n in ("CURRENT", "CURRENT.new"))
    fs = pointer.getFileSystem(conf)
    out = fs.create(fresh, True)
    out.write(bytearray(json.dumps({"path": path, "form": form}).encode()))
    out.close()
    fs.delete(pointer, False)
    fs.rename(fresh, pointer)
    return path


def read_version(spark: SparkSession, folder: str) -> DataFrame:
    """The current version of a table; an error if there is none."""
    if not exists(spark, f"{folder}/CURRENT"):
        raise FileNotFoundError(f"{folder} has no version")
    at = json.loads(spark.read.text(f"{folder}/CURRENT", wholetext=True).first()[0])
    return spark.read.format(at["form"]).load(at["path"])

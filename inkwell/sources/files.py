"""Documents, passages and logs read from files: JSON folders, JSON lines, CSV logs, progress lists, encodings.

Everything is a plan over file scans, so filters and columns reach the scan; only lists of folders are read on the driver.
Bad files and lines are skipped and can be asked for. Empty folders give no rows, a missing one an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

CORRUPT = "_corrupt_record"
#: How times stand in CSV logs: to the microsecond.
TIMES = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

#: Columns of the crawl log as CSV.
CRAWL_LOG = (
    "log_id bigint, url string, collection string, date_iso string, status string, char_count int, turn_count int, speaker_count int, "
    "page_format string, validation_flags string, scrape_timestamp string, logged_at timestamp_ntz"
)


def _with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add(CORRUPT, StringType())


def read_json_folder(spark: SparkSession, folder: str, schema: StructType, recursive: bool = False) -> DataFrame:
    """One document a file: the columns of ``schema``, then file, parent (its folder) and bad (it is no JSON of that form)."""
    parsed = F.from_json("value", _with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    path = F.col("_metadata.file_path")
    files = spark.read.option("recursiveFileLookup", recursive).text(folder, wholetext=True)
    read = files.select(parsed.alias("d"), F.element_at(F.split(path, "/"), -1).alias("file"), F.element_at(F.split(path, "/"), -2).alias("parent"))
    bad = F.col("d").isNull() | F.col(f"d.{CORRUPT}").isNotNull()
    return read.select(*[F.col(f"d.{n}").alias(n) for n in schema.names], "file", "parent", bad.alias("bad"))


def documents_in(spark: SparkSession, folder: str, schema: StructType, parent: str | None = None) -> DataFrame:
    """The readable documents of a folder; with ``parent`` of all folders of that name below it."""
    df = read_json_folder(spark, folder, schema, recursive=parent is not None)
    kept = df if parent is None else df.where(F.col("parent") == parent)
    return kept.where("not bad").drop("bad", "parent")


def unreadable_files(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Files that were skipped: file."""
    return read_json_folder(spark, folder, schema).where("bad").select("file").distinct()


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One row a line; blank and bad lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def bad_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Lines that are no JSON: line. Told from the text itself, so nothing has to be cached."""
    parsed = F.from_json("value", _with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT})
    return spark.read.text(path).where("trim(value) != ''").where(parsed[CORRUPT].isNotNull()).select(F.col("value").alias("line"))


def with_ordinals(lines: DataFrame) -> DataFrame:
    """Rows of a text or JSON-lines scan with their place in the data, by file and place in it: adds ordinal (from 0).

    Rows are numbered within the split that read them and shifted by the rows of the splits before; only one row a split
    is sorted in one place.
    """
    at = lines.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"))
    splits = at.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(1)).orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("_file", "_start").orderBy("_id")) - 1
    return at.withColumn("_at", within).join(splits.withColumn("_before", before), ["_file", "_start"]).withColumn("ordinal", F.col("_before") + F.col("_at")).drop(
        "_file", "_start", "_id", "_n", "_at", "_before"
    )


def read_crawl_log(spark: SparkSession, path: str, schema: str = CRAWL_LOG) -> DataFrame:
    """The crawl log as CSV with a header; unreadable values are null."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("timestampFormat", TIMES).option("timestampNTZFormat", TIMES).csv(path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Ids that are done, one a line: id. A list that is not there yet is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], "id string")
    return spark.read.text(path).where("trim(value) != ''").select(F.trim("value").alias("id")).distinct()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system it names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def first_existing(spark: SparkSession, candidates: list[str]) -> str:
    """The first folder that is there, as for an index with fallbacks; an error if none is."""
    for path in candidates:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"none of {candidates}")


def collections_in(spark: SparkSession, folder: str, known: list[str]) -> list[str]:
    """Known collections first, then other folders by name, but for those that begin with an underscore."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    status = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target)
    names = {s.getPath().getName().removeprefix("collection=") for s in status if s.isDirectory()}
    return [k for k in known if k in names] + sorted(n for n in names if n not in known and not n.startswith("_"))


def by_slug(documents: DataFrame, slug: str, file: str = "file", url: str = "url") -> DataFrame:
    """The document of a slug: by its file's name first, else the first by name whose url holds the slug; at most one row."""
    rank = F.when(F.substring_index(F.col(file), ".", 1) == slug, 0).when(F.contains(F.col(url), F.lit(slug)), 1)
    return documents.withColumn("_rank", rank).where("_rank is not null").orderBy("_rank", file).limit(1).drop("_rank")


def first_found(primary: DataFrame, fallback: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet a condition, from the fallback only if the primary table has none."""
    found = primary.where(condition)
    other = fallback.where(condition)
    there = found.limit(1).select(F.lit(1).alias("_there"))
    rest = other.join(F.broadcast(there), F.lit(True), "left_anti")  # one row at most
    return found.unionByName(rest)


def paths_and_urls(documents: DataFrame) -> DataFrame:
    """File and url of every document, by file name."""
    return documents.select("file", "url").orderBy("file")


def encoding_report(spark: SparkSession, folder: str) -> DataFrame:
    """What encoding each page declares, whether its bytes are UTF-8, and what to read it as: file, declared, utf8, advice."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    head = F.decode(F.substring("content", 1, 4096), "ISO-8859-1")
    declared = F.lower(F.regexp_extract(head, r"""(?i)charset\s*=\s*["']?([\w-]+)""", 1))
    utf8 = F.is_valid_utf8(F.col("content").cast("string"))
    latin = declared.isin("iso-8859-1", "latin-1", "latin1", "windows-1252")
    advice = F.when(utf8, "utf-8").when(latin, "windows-1252").when(declared != "", declared).otherwise("sniff")
    return raw.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.when(declared != "", declared).alias("declared"), utf8.alias("utf8"), advice.alias("advice"))

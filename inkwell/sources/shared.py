"""Tables written between the steps of a query, where every executor can read them again."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a local one only on a local master where none is named, as in tests."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SETTING} must name a folder that every executor can reach")
        named = "file://" + tempfile.mkdtemp(prefix="inkwell-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch(spark: SparkSession) -> str:
    """A fresh path in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/inkwell-{uuid.uuid4().hex}"
    _forget_at_exit(spark, path)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """``df``, written once as Parquet to the shared folder and read back: its lineage is cut, a lost executor loses nothing.

    Written as a table, not by ``checkpoint``, which computes its input twice and keeps rows uncompressed. The table is
    deleted when the driver ends.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _forget_at_exit(spark: SparkSession, path: str) -> None:
    def forget() -> None:
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session may be gone; the folder is then the cluster's to clean
            pass

    atexit.register(forget)

"""Plan plumbing: stored stages, package shipping and hot-key joins."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it; a temporary one only where it names none and everything runs in one process (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="pagemill-stages-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


class SharedFiles:
    """Marks and folders in the file system that a path names, whichever Hadoop knows."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.conf)

    def names(self, path: str) -> list[str]:
        """Names in a folder, none if it doesn't exist."""
        p, fs = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def mark(self, path: str) -> None:
        """Creates an empty file in one step; fails if it is there already."""
        p, fs = self._at(path)
        fs.create(p, False).close()

    def remove(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        SharedFiles(spark).remove(path)
    except Exception:  # the session may be gone already
        pass


def shared_folder(spark: SparkSession, label: str) -> str:
    """The path of a new folder in the shared one, removed when the driver ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def stored(df: DataFrame, label: str = "stage") -> DataFrame:
    """Writes df to the shared folder and returns a scan of it.

    This cuts the lineage and survives the loss of executors; the files are removed when
    the driver ends.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that they need no copy of their own."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    out = os.path.join(tempfile.mkdtemp(prefix="pagemill-zip-"), "pagemill.zip")
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(out)
    _shipped.add(app)


def salted_join(facts: DataFrame, lookup: DataFrame, key: str, row_id: Column, how: str = "left", rows_per_task: int = 1_000_000) -> DataFrame:
    """Equi-join in which hot keys of facts are spread over several tasks.

    lookup has at most one row per key. A key is hot when it holds more than ``rows_per_task`` rows of facts, whatever their number in all, so the list
    of hot keys has at most a row per that many rows; it gets as many salts as it has such parts. Hot rows get a salt from row_id; the lookup rows
    of hot keys (only those) are repeated once per salt. Null keys match nothing. The list is broadcast only where its
    counted rows allow it.
    """
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_task)
    hot = stored(counts.select(F.col(key).alias("_hot_key"), F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts")), "hot-keys")
    n = hot.count()
    if not n:
        return facts.join(lookup, key, how)
    hot = F.broadcast(hot) if n <= 200_000 else hot
    f = facts.join(hot, F.col(key) == F.col("_hot_key"), "left")
    f = f.withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(row_id), F.col("_salts")).cast("int"), F.lit(0))).drop("_hot_key", "_salts")
    r = lookup.join(hot, F.col(key) == F.col("_hot_key"), "left")
    r = r.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_hot_key", "_salts")
    return f.join(r, [key, "_salt"], how).drop("_salt")

"""Files as documents: formats, sizes, hashes and sampling."""

from __future__ import annotations

import ipaddress
import os
import urllib.parse
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.operators.elements import file_format, url_format
from pagemill.operators.sync import uuid5

#: Suffixes of documents in a benchmark corpus.
CORPUS_SUFFIXES = (".pdf", ".png", ".jpg", ".jpeg", ".tif", ".tiff")


def files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, length, modified, content) of the files in a folder; columns that aren't used aren't read."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return f.select("path", "length", F.col("modificationTime").alias("modified"), "content")


def checked(found: DataFrame, most_mb: float = 500.0, supported: tuple[str, ...] = ("pdf",)) -> DataFrame:
    """files with format and error: why a file can't be processed, null if it can. The format is that of the first bytes, else of the suffix."""
    kind = file_format(F.col("path"), F.substring("content", 1, 64))
    error = (
        F.when(F.col("format") == "unknown", "unsupported format").when(~F.col("format").isin(*supported), F.concat(F.lit("no parser for "), F.col("format")))
        .when(F.col("length") > most_mb * 1024 * 1024, F.format_string("file exceeds %s MB", F.lit(f"{most_mb:g}")))
    )
    return found.withColumn("format", kind).withColumn("error", error)


def documents_of(found: DataFrame, urls: DataFrame | None = None) -> DataFrame:
    """(document_id, source_path, source_url, format, status, error) of files and of (url): unknown formats are kept with an error and status failed.

    Ids are derived from the path or URL, so that a second run gives the same.
    """
    d = checked(found, supported=("pdf", "docx", "html", "video", "audio")).select(F.col("path").alias("source_path"), F.lit(None).cast("string").alias("source_url"), "format", "error")
    if urls is not None:
        kind = url_format(F.col("url"))
        d = d.unionByName(urls.select(F.lit(None).cast("string").alias("source_path"), F.col("url").alias("source_url"), kind.alias("format"), F.when(kind == "unknown", "unsupported format").alias("error")))
    name = F.coalesce("source_path", "source_url")
    return d.select(uuid5(F.concat(F.lit("document:"), name)).alias("document_id"), "source_path", "source_url", "format", F.when(F.col("error").isNull(), "pending").otherwise("failed").alias("status"), "error")


def hashed(found: DataFrame, most_bytes: int) -> DataFrame:
    """(path, sha256, n_bytes, error): the hash of each file's content; one over the size has none."""
    over = F.col("length") > most_bytes
    return found.select("path", F.when(~over, F.sha2("content", 256)).alias("sha256"), F.col("length").alias("n_bytes"), F.when(over, "file exceeds the size limit").alias("error"))


def corpus(found: DataFrame, sample: int | None = None, strategy: str = "random", seed: int = 42, category: str | None = None) -> DataFrame:
    """Documents of a benchmark corpus by path: those with its suffixes, all or a sample.

    The sample is the feature: sequential takes the first by path, random the first by a hash with the seed, stratified as many of each category in
    proportion (random without a category column). The same seed gives the same sample at every partitioning.
    """
    low = F.lower("path")
    docs = found.where(F.exists(F.array(*map(F.lit, CORPUS_SUFFIXES)), lambda s: low.endswith(s)))
    if sample is None:
        return docs.orderBy("path")
    mixed = F.xxhash64("path", F.lit(seed))
    if strategy == "sequential":
        return docs.orderBy("path").limit(sample)
    if strategy == "stratified" and category:
        n = docs.groupBy(category).agg(F.count(F.lit(1)).alias("_n"))
        total = F.sum("_n").over(Window.partitionBy())  # one row per category
        share = n.withColumn("_take", F.greatest(F.round(F.col("_n") / total * sample), F.lit(1)))
        rank = F.row_number().over(Window.partitionBy(category).orderBy(mixed, "path"))
        return docs.withColumn("_k", rank).join(share, category).where("_k <= _take").select(*docs.columns).orderBy("path")
    return docs.orderBy(mixed, "path").limit(sample).orderBy("path")


def loopback_only(url: str) -> str:
    """A model's address, which must be of this host."""
    host = urllib.parse.urlparse(url).hostname or ""
    try:
        local = host == "localhost" or ipaddress.ip_address(host).is_loopback
    except ValueError:
        local = False
    if not local:
        raise ValueError("a model's address must be of this host")
    return url


def api_key(value: str | None = None, file: str | None = None, variable: str | None = None) -> str:
    """The key of exactly one source: given, in a file, or in an environment variable; blank ones are errors."""
    given = [x for x in (value, file, variable) if x]
    if len(given) != 1:
        raise ValueError("exactly one source of the key is needed")
    key = value or (Path(file).read_text().strip() if file else os.environ.get(variable or "", "").strip())
    if not key:
        raise ValueError("the key is empty")
    return key


def canonical_date(c: Column) -> Column:
    """A DATE of text in the form YYYY-MM-DD exactly, else null."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("date"))


def utc_time(c: Column) -> Column:
    """A TIMESTAMP of ISO text; one without a zone is UTC (the session's zone is), malformed text is null."""
    return F.try_to_timestamp(F.regexp_replace(c, r"^(\d{4}-\d{2}-\d{2})[ Tt]", "$1T"))

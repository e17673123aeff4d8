"""A paged documents API as a Spark data source, with pushed filters and checked listings."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThanOrEqual, InputPartition

SCHEMA = "id string, title string, category string, document_type string, entity_id string, document_date string, is_confidential boolean, consent_on_file boolean, sha256 string, updated_at string"
#: Most pages of a listing.
MOST_PAGES = 100_000


def checked_url(url: str) -> str:
    """https only, but for loopback."""
    p = urllib.parse.urlparse(url)
    if p.scheme == "https" or (p.scheme == "http" and p.hostname in ("localhost", "127.0.0.1", "::1")):
        return url.rstrip("/")
    raise ValueError("the documents API needs https")


def retry_delay(header: str | None, attempt: int) -> float:
    """Seconds to wait after a 429: what the server says, else 1, 2, 4, ...; at most 60."""
    try:
        return min(60.0, max(0.0, float(header)))
    except (TypeError, ValueError):
        return min(60.0, float(2**attempt))


def get_json(url: str, token: str | None, retries: int = 4) -> dict:
    for attempt in range(retries + 1):
        request = urllib.request.Request(url, headers={"Authorization": f"Bearer {token}"} if token else {})
        try:
            with urllib.request.urlopen(request, timeout=60) as r:
                return json.load(r)
        except urllib.error.HTTPError as e:
            if e.code != 429 or attempt == retries:
                raise
            time.sleep(retry_delay(e.headers.get("Retry-After"), attempt))
    raise AssertionError


class ListingMoved(RuntimeError):
    """Rows came or went while a listing was read."""


def page_of(body: object) -> tuple[list, int, int]:
    """(items, pages, total) of a page; another shape is a ValueError."""
    x = body if isinstance(body, dict) else {}
    items, pages, total = x.get("items"), x.get("pages"), x.get("total")
    whole = lambda n, least: isinstance(n, int) and not isinstance(n, bool) and n >= least
    if not isinstance(items, list) or not whole(pages, 1) or not whole(total, 0) or pages > MOST_PAGES:
        raise ValueError("the documents API returned an unexpected page")
    return items, pages, total


def record_row(item: dict, names: list[str]) -> tuple:
    """A record's columns; flags must be booleans or missing, ids text."""
    for flag in ("is_confidential", "consent_on_file"):
        if item.get(flag) is not None and not isinstance(item[flag], bool):
            raise ValueError(f"a record's {flag} isn't a boolean")
    if not isinstance(item.get("id"), str):
        raise ValueError("a record has no id")
    return tuple(item.get(n) for n in names)


class _Page(InputPartition):
    def __init__(self, number: int, pages: int, total: int):
        self.number, self.pages, self.total = number, pages, total


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.token, self.size = checked_url(options["url"]), options.get("token"), int(options.get("pageSize", 100))
        self.filters: dict[str, str] = {}

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("category",):
                self.filters["category"] = str(f.value)
            elif isinstance(f, GreaterThanOrEqual) and f.attribute == ("updated_at",):
                self.filters["updated_since"] = str(f.value)
            yield f  # Spark tests again: the server may be coarser

    def _url(self, page: int) -> str:
        return f"{self.url}/documents?" + urllib.parse.urlencode({"size": self.size, **self.filters, "page": page})

    def partitions(self):
        _, pages, total = page_of(get_json(self._url(1), self.token))
        return [_Page(k + 1, pages, total) for k in range(pages)]

    def read(self, partition):
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        items, _, total = page_of(get_json(self._url(partition.number), self.token))
        if total != partition.total or (not items and partition.number < partition.pages):
            raise ListingMoved("the listing changed while it was read")
        for item in items:
            yield record_row(item, names)


class DocumentsApi(DataSource):
    """spark.dataSource.register(DocumentsApi); spark.read.format("documents_api").option("url", ...), with spark.sql.python.filterPushdown.enabled."""

    @classmethod
    def name(cls) -> str:
        return "documents_api"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def newest_copies(records: DataFrame) -> DataFrame:
    """One row per id, the newest by updated_at: an edit while paging repeats a row."""
    cols = [c for c in records.columns if c != "id"]
    return records.groupBy("id").agg(F.max_by(F.struct(*cols), "updated_at").alias("r")).select("id", "r.*")


def since(mark: datetime | None, overlap: timedelta = timedelta(minutes=5)) -> str | None:
    """The time to list from: the newest update seen less a margin, as a row may become visible after a later one; a time without a zone is UTC."""
    if mark is None:
        return None
    at = mark if mark.tzinfo else mark.replace(tzinfo=timezone.utc)
    return (at.astimezone(timezone.utc) - overlap).isoformat()


def listing(spark: SparkSession, url: str, folder: str, category: str | None = None, updated_since: str | None = None, attempts: int = 2, **options: str) -> DataFrame:
    """The records of a listing, each id once, by (updated_at, id); it is stored in the folder, so that its pages are read once.

    A listing whose pages report different totals, or that has another number of distinct records than reported, is read again and then fails.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # the source takes filters
    spark.dataSource.register(DocumentsApi)
    reader = _Reader({"url": url, **options})
    if category is not None:
        reader.filters["category"] = category
    if updated_since is not None:
        reader.filters["updated_since"] = updated_since
    for k in range(attempts):
        d = spark.read.format("documents_api").options(url=url, **options).load()
        d = d.where(F.col("category") == category) if category is not None else d
        d = d.where(F.col("updated_at") >= updated_since) if updated_since is not None else d
        path = f"{folder.rstrip('/')}/listing-{k}"
        try:
            newest_copies(d).write.mode("overwrite").parquet(path)
        except Exception as e:
            if "listing changed" not in str(e) or k + 1 == attempts:
                raise
            continue
        _, _, total = page_of(get_json(reader._url(1), reader.token))
        found = spark.read.parquet(path)
        if found.count() == total:
            return found.orderBy("updated_at", "id")
    raise ListingMoved("the listing did not match its reported total after a second read")


def lookup(ids: DataFrame, url: str, token: str | None = None) -> DataFrame:
    """(id, found, json) of each id (id): the record as it is now; found is false for one that is gone (404). Ids are looked up where they are, one request each."""
    base = checked_url(url)

    def run(rows):
        for b in rows:
            out = []
            for i in b["id"]:
                try:
                    out.append((i, True, json.dumps(get_json(f"{base}/documents/{urllib.parse.quote(str(i))}", token))))
                except urllib.error.HTTPError as e:
                    if e.code != 404:
                        raise
                    out.append((i, False, None))
            import pandas as pd

            yield pd.DataFrame(out, columns=["id", "found", "json"])

    return ids.select("id").distinct().mapInPandas(run, "id string, found boolean, json string")


def download(ids: DataFrame, url: str, token: str | None = None, most_bytes: int = 500 * 1024 * 1024) -> DataFrame:
    """(id, sha256, n_bytes, content, error) of each id's file, hashed as it streams in; one over the size has an error and no content."""
    base = checked_url(url)

    def run(rows):
        import hashlib

        import pandas as pd

        for b in rows:
            for i in b["id"]:
                h, parts, n, error = hashlib.sha256(), [], 0, None
                request = urllib.request.Request(f"{base}/documents/{urllib.parse.quote(str(i))}/file", headers={"Authorization": f"Bearer {token}"} if token else {})
                try:
                    with urllib.request.urlopen(request, timeout=300) as r:
                        while data := r.read(1 << 20):
                            n += len(data)
                            if n > most_bytes:
                                error = "file exceeds the size limit"
                                break
                            h.update(data)
                            parts.append(data)
                except urllib.error.HTTPError as e:
                    error = "not found" if e.code == 404 else f"HTTP {e.code}"
                yield pd.DataFrame([(i, None if error else h.hexdigest(), n, None if error else b"".join(parts), error)], columns=["id", "sha256", "n_bytes", "content", "error"])

    return ids.select("id").distinct().mapInPandas(run, "id string, sha256 string, n_bytes bigint, content binary, error string")

"""Chunking: sections by title, packing with and without overlap."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.operators.elements import clean_elements, heading_paths, running, strip
from pagemill.plans.stages import stored

#: A tokenizer's counter, and a packed chunk: content, first and last page, first title.
Count = Callable[[str], int]
Packed = tuple[str, int | None, int | None, str | None]


class Chunker(Protocol):
    """Anything that turns elements into chunks; by_title_chunks, token_chunks and tree_chunks with their parameters bound are such."""

    def __call__(self, elements: DataFrame) -> DataFrame: ...


def n_words(c: Column) -> Column:
    """Default token counter: runs of non-white-space."""
    s = strip(c)
    return F.when(F.coalesce(s, F.lit("")) == "", 0).otherwise(F.size(F.split(s, r"(?U)\s+")))


def sections(elements: DataFrame) -> DataFrame:
    """(doc_id, pos, type, content, page_number, section): a new section at each title or heading; what comes before the first is section 0."""
    return running(clean_elements(elements), "doc_id", "pos", section=("sum", F.when(F.col("type").isin("title", "heading"), 1).otherwise(0)))


def section_sizes(elements: DataFrame) -> DataFrame:
    return _sizes(sections(elements))


def _sizes(placed: DataFrame) -> DataFrame:
    return placed.groupBy("doc_id", "section").agg(F.count(F.lit(1)).alias("n_elements"), F.sum(n_words(F.col("content"))).alias("n_words"), (F.sum(F.length("content")) + 2 * (F.count(F.lit(1)) - 1)).alias("n_chars"))


def combined_sections(elements: DataFrame, under: int = 200) -> DataFrame:
    """(doc_id, section, combined): each maximal run of sections under that many characters becomes one; 0 combines nothing."""
    return _combined(sections(elements), under)


def _combined(placed: DataFrame, under: int) -> DataFrame:
    w = Window.partitionBy("doc_id").orderBy("section")
    s = _sizes(placed).withColumn("small", F.col("n_chars") < under)
    start = F.when(F.col("small") & F.coalesce(F.lag("small").over(w), F.lit(False)), 0).otherwise(1)
    return running(s.withColumn("start", start), "doc_id", "section", combined=("sum", F.col("start"))).select("doc_id", "section", F.col("combined").cast("bigint").alias("combined"))


def sentences(text: str) -> list[str]:
    """Pieces between ". ", stripped, blank ones dropped, each with its full stop."""
    parts = [p.strip() for p in text.split(". ")]
    return [p if p.endswith(".") else p + "." for p in parts if p]


def word_count(text: str) -> int:
    """Default tokenizer of the packers; any text -> int that can be pickled may stand for it."""
    return len(text.split())


class TitlePacker:
    """Packing of one section's text elements, fed one by one; no overlap, an element over the size stands alone."""

    def __init__(self, size: int, respect_pages: bool = False, count: Count = word_count):
        self.size, self.respect_pages, self.count = size, respect_pages, count
        self.parts: list[tuple[str, int | None, bool]] = []
        self.total = self.page = 0

    def add(self, text: str, page: int | None, head: bool) -> Iterator[Packed]:
        n = self.count(text)
        turn = self.respect_pages and bool(self.page and page) and page != self.page
        if self.parts and (self.total + n > self.size or turn):
            yield from self.end()
        self.parts.append((text, page, head))
        self.total += n
        self.page = page or self.page
        if n > self.size:
            yield from self.end()

    def end(self) -> Iterator[Packed]:
        if self.parts:
            pages = [p for _, p, _ in self.parts if p is not None]
            yield "\n\n".join(t for t, _, _ in self.parts), min(pages, default=None), max(pages, default=None), next((t for t, _, h in self.parts if h), None)
        self.parts, self.total = [], 0


class TokenPacker:
    """Greedy packing with overlap of one document's elements, fed one by one; holds only the open chunk."""

    def __init__(self, size: int, overlap: int, count: Count = word_count):
        self.size, self.overlap, self.count = size, overlap, count
        self.parts: list[tuple[str, int, int | None]] = []
        self.total = 0

    def _chunk(self) -> Packed:
        pages = [p for _, _, p in self.parts if p is not None]
        return "\n\n".join(t for t, _, _ in self.parts), min(pages, default=None), max(pages, default=None), None

    def add(self, text: str, page: int | None, head: bool = False) -> Iterator[Packed]:
        n = self.count(text)
        if n > self.size:
            yield from self.end()
            yield from self._split(text)
            return
        if self.parts and self.total + n > self.size:
            yield self._chunk()
            first, kept = len(self.parts), 0
            while first and kept + self.parts[first - 1][1] <= self.overlap:
                first -= 1
                kept += self.parts[first][1]
            self.parts, self.total = self.parts[first:], kept
        self.parts.append((text, n, page))
        self.total += n

    def end(self) -> Iterator[Packed]:
        if self.parts:
            yield self._chunk()
        self.parts, self.total = [], 0

    def _split(self, text: str) -> Iterator[Packed]:
        """Sentences of an oversized element; the last three are repeated if they all fit into the overlap."""
        now: list[str] = []
        total = 0
        for s in sentences(text):
            n = self.count(s)
            if now and total + n > self.size:
                yield " ".join(now), None, None, None
                tail = now[-3:]
                size = sum(map(self.count, tail))
                now, total = (tail, size) if size <= self.overlap else ([], 0)
            now.append(s)
            total += n
        if now:
            yield " ".join(now), None, None, None


def _packed(rows: DataFrame, group: str, packer: Callable[[], object]) -> DataFrame:
    """(doc_id, group, local, content, start_page, end_page, section_title): rows (doc_id, group, pos, content, page_number, head) packed group by group, in order.

    Groups are streamed through one packer per task, so that memory grows neither with a group nor with a document.
    """
    r = rows.select("doc_id", F.col(group).cast("bigint").alias("_g"), F.col("pos").cast("bigint").alias("pos"), "content", "page_number", "head")
    r = r.repartition("doc_id", "_g").sortWithinPartitions("doc_id", "_g", "pos")
    kind = dict(r.dtypes)["doc_id"]
    types = (None, pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string())
    names = ("doc_id", "group", "local", "content", "start_page", "end_page", "section_title")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, n = None, None, 0
        out: list[tuple] = []

        def take(chunks) -> None:
            nonlocal n
            for c in chunks:
                out.append((*key, n, *c))
                n += 1

        for b in batches:
            id_type = b.schema.field(0).type
            for doc, g, _, text, page, head in zip(*(c.to_pylist() for c in b.columns)):
                if (doc, g) != key:
                    if now is not None:
                        take(now.end())
                    key, now, n = (doc, g), packer(), 0
                take(now.add(text, page, head))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t or id_type) for c, t in zip(zip(*out), types)], names=names)
                out.clear()
        if now is not None:
            take(now.end())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t or id_type) for c, t in zip(zip(*out), types)], names=names)

    return r.mapInArrow(run, f"doc_id {kind}, group bigint, local int, content string, start_page int, end_page int, section_title string")


def _numbered(chunks: DataFrame) -> DataFrame:
    """chunk_index from 0 and total_chunks per document of chunks with (group, side, local): their place in their part is added to the sizes of the parts before.

    Only the sizes of parts, one row per group and side, are summed along a document. The chunks are stored, as they are needed for the sizes and again with their numbers.
    """
    chunks = stored(chunks, "chunks")
    w = Window.partitionBy("doc_id").orderBy("group", "side")
    sizes = chunks.groupBy("doc_id", "group", "side").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("doc_id", "group", "side", (F.sum("n").over(w) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy("doc_id")).cast("int").alias("total_chunks"))
    c = chunks.join(before, ["doc_id", "group", "side"]).withColumn("chunk_index", (F.col("before") + F.col("local")).cast("int"))
    return c.select("doc_id", "chunk_index", "total_chunks", "chunk_type", "section_title", "start_page", "end_page", n_words(F.col("content")).alias("token_count"), "content")


def _is_head() -> Column:
    return F.col("type").isin("title", "heading")


def split_tables(elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Elements that aren't tables, and tables."""
    return elements.where("type <> 'table'"), elements.where("type = 'table'")


def _table_chunks(tables: DataFrame, group: str, pages: bool) -> DataFrame:
    """Each table as a chunk at the end of its group, with or without pages."""
    t = running(tables, "doc_id", "pos", k=("sum", F.lit(1))).withColumn("group", F.col(group).cast("bigint"))
    first = t.groupBy("doc_id", "group").agg(F.min("k").alias("k0"))
    page = F.col("page_number").cast("int") if pages else F.lit(None).cast("int")
    return t.join(first, ["doc_id", "group"]).select("doc_id", "group", F.lit(1).alias("side"), (F.col("k") - F.col("k0")).cast("int").alias("local"), F.lit("table").alias("chunk_type"), "content", page.alias("start_page"), page.alias("end_page"), F.lit(None).cast("string").alias("section_title"))


def by_title_chunks(elements: DataFrame, size: int = 120, under: int = 200, respect_pages: bool = False, count: Count = word_count) -> DataFrame:
    """(doc_id, chunk_index, total_chunks, chunk_type, section_title, start_page, end_page, token_count, content).

    Within each combined section text is packed up to ``size`` tokens, an element over it stands alone; then come the tables of the
    section, each as a chunk. No overlap; with respect_pages a chunk ends where a known page changes. The title is the first one inside the chunk.
    """
    placed = stored(sections(elements), "sections")
    s = placed.join(_combined(placed, under), ["doc_id", "section"]).withColumn("head", _is_head())
    text, tables = split_tables(s)
    packed = _packed(text, "combined", lambda: TitlePacker(size, respect_pages, count)).withColumn("chunk_type", F.lit("text")).withColumn("side", F.lit(0))
    return _numbered(packed.unionByName(_table_chunks(tables, "combined", True)))


def token_chunks(elements: DataFrame, size: int = 1000, overlap: int = 200, count: Count = word_count) -> DataFrame:
    """Chunks as by_title_chunks, packed over the whole document with an overlap of whole elements; tables stand alone at the end, without pages.

    An element over the size, by white-space tokens, ends what is packed and leaves nothing to overlap, so a document is packed in separate stretches from one such
    element to the next; another tokenizer packs a document in one stretch.
    """
    text, tables = split_tables(clean_elements(elements).withColumn("head", F.lit(False)))
    over = F.when(n_words(F.col("content")) > size, 1).otherwise(0) if count is word_count else F.lit(0)
    stretches = running(text, "doc_id", "pos", stretch=("sum", over))
    packed = _packed(stretches, "stretch", lambda: TokenPacker(size, overlap, count)).withColumn("chunk_type", F.lit("text")).withColumn("side", F.lit(0))
    last = F.lit((1 << 62) - 1)
    return _numbered(packed.unionByName(_table_chunks(tables.withColumn("_last", last), "_last", False)))


def tree_chunks(elements: DataFrame, cap: int = 512, count: Count = word_count) -> DataFrame:
    """(doc_id, chunk_index, total_chunks, chunk_type, section_title, section_path, start_page, end_page, token_count, content, error) along the tree of headings.

    elements: (doc_id, pos, type, content, page_number, level), level being that of headings. Neighbours under the same headings are merged up to the cap, longer ones
    split at sentences, then at words; the headings stand before each text and count. error says that a chunk has no page, or that its headings alone outlast the cap.
    """
    items = elements.select("doc_id", "pos", "type", "content", "page_number", F.col("level").cast("int").alias("level"), F.when(F.col("level").isNotNull(), F.col("content")).alias("heading"))
    paths = heading_paths(items)
    placed = running(items, "doc_id", "pos", section=("max", F.when(F.col("level").isNotNull(), F.col("pos"))))
    placed = placed.withColumn("section", F.coalesce(F.col("section"), F.lit(-1)).cast("bigint"))
    by_section = placed.where("level is not null").select("doc_id", "pos", "section").join(paths, ["doc_id", "pos"]).select("doc_id", "section", "path")
    body = placed.where("level is null").join(by_section, ["doc_id", "section"], "left").withColumn("path", F.coalesce("path", F.array().cast("array<string>")))
    # the packer needs the headings' tokens: they travel with the first column that it reads
    rows = body.select("doc_id", "pos", "section", F.to_json(F.struct(F.array_join("path", "\n").alias("h"), F.col("content").alias("c"))).alias("content"), "page_number", F.lit(False).alias("head"))
    packed = _packed(rows, "section", lambda: TreePacker(cap, count)).withColumn("side", F.lit(0)).withColumn("chunk_type", F.lit("text"))
    done = _numbered(packed.drop("section_title").withColumn("section_title", F.col("group").cast("string")))
    named = done.withColumn("section", F.col("section_title").cast("bigint")).join(by_section, ["doc_id", "section"], "left")
    error = F.when(F.col("start_page").isNull(), "chunk has no page").when(F.col("token_count") > cap, "headings outlast the cap")
    path = F.coalesce("path", F.array().cast("array<string>"))
    return named.select("doc_id", "chunk_index", "total_chunks", "chunk_type", F.try_element_at(path, F.lit(-1)).alias("section_title"), path.alias("section_path"), "start_page", "end_page", "token_count", "content", error.alias("error"))


class TreePacker:
    """Merges neighbours under the same headings up to the cap and splits what is longer; texts come as JSON with their headings."""

    def __init__(self, cap: int, count: Count = word_count):
        self.cap, self.count = cap, count
        self.parts: list[tuple[str, int | None]] = []
        self.total, self.headings = 0, ""

    def add(self, text: str, page: int | None, head: bool = False) -> Iterator[Packed]:
        x = json.loads(text)
        self.headings, content = x.get("h", ""), x.get("c", "")
        room = max(1, self.cap - self.count(self.headings))
        for piece in [content] if self.count(content) <= room else self._split(content, room):
            n = self.count(piece)
            if self.parts and self.total + n > room:
                yield from self.end()
            self.parts.append((piece, page))
            self.total += n

    def _split(self, content: str, room: int) -> Iterator[str]:
        now: list[str] = []
        for s in sentences(content):
            pieces = [s]
            if self.count(s) > room:
                words = s.split()
                pieces = [" ".join(words[i : i + room]) for i in range(0, len(words), room)]
            for p in pieces:
                if now and self.count(" ".join([*now, p])) > room:
                    yield " ".join(now)
                    now = []
                now.append(p)
        if now:
            yield " ".join(now)

    def end(self) -> Iterator[Packed]:
        if self.parts:
            pages = [p for _, p in self.parts if p is not None]
            text = "\n".join(t for t in (self.headings, *(t for t, _ in self.parts)) if t)
            yield text, min(pages, default=None), max(pages, default=None), None
        self.parts, self.total = [], 0


def split_sentences(documents: DataFrame) -> DataFrame:
    """(doc_id, sentence_no, sentence) by the rules of ``sentences``, in the JVM."""
    d = documents.select("doc_id", F.posexplode(F.split("text", r"\. ")).alias("sentence_no", "s")).withColumn("s", strip(F.col("s"))).where("s <> ''")
    return d.select("doc_id", "sentence_no", F.when(F.col("s").endswith("."), F.col("s")).otherwise(F.concat("s", F.lit("."))).alias("sentence"))


def chunk_statistics(chunks: DataFrame) -> DataFrame:
    """Per type, chunks, tokens and mean tokens of stored chunks, counted anew."""
    c = chunks.select("chunk_id", F.coalesce(F.lower(F.trim("chunk_type")), F.lit("unknown")).alias("chunk_type"), "content").distinct().withColumn("n", n_words(F.col("content")))
    return c.groupBy("chunk_type").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("n").cast("bigint").alias("n_tokens"), F.round(F.avg("n"), 6).alias("mean_tokens"))

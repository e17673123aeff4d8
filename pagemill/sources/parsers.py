"""Parsers of files as pluggable functions: registry, fallback chain and hooks for external libraries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.operators.elements import running

#: A parser: (path, content) -> (type, content, page) of each element; it may raise for one document.
Parse = Callable[[str, bytes], list[tuple[str, str, int | None]]]


@dataclass(frozen=True)
class Parser:
    """A parser under a name, for formats, tried in order of priority (the lowest first)."""

    name: str
    parse: Parse
    formats: tuple[str, ...] = ("pdf",)
    priority: int = 100
    check: Callable[[], bool] = lambda: True


@dataclass
class Registry:
    """The parsers of an application, in order of registration."""

    parsers: list[Parser] = field(default_factory=list)

    def add(self, parser: Parser) -> None:
        if any(p.name == parser.name for p in self.parsers):
            raise ValueError(f"parser {parser.name} is registered already")
        self.parsers.append(parser)

    def chain(self, format: str) -> list[Parser]:
        """Parsers of a format by priority, then registration."""
        return sorted((p for p in self.parsers if format in p.formats), key=lambda p: p.priority)

    def health(self) -> list[tuple[str, int, bool]]:
        """(name, priority, healthy) of every parser; a check that raises is unhealthy."""

        def ok(p: Parser) -> bool:
            try:
                return bool(p.check())
            except Exception:
                return False

        return [(p.name, p.priority, ok(p)) for p in self.parsers]


def optional(module: str) -> Callable[[], bool]:
    """Whether an external library can be imported, for a parser's check."""

    def check() -> bool:
        from importlib.util import find_spec

        return find_spec(module) is not None

    return check


_ROW = "path string, parser string, success boolean, error string, attempts array<string>, elements array<struct<pos:int,type:string,content:string,page_number:int>>"


def route(found: DataFrame, registry: Registry, skip: DataFrame | None = None) -> DataFrame:
    """(path, parser, success, error, attempts, elements) of files (path, format, content): the first parser of the format's chain that succeeds.

    A file whose parsers all fail, or whose format has none, is a row with an error, and attempts names what was tried. Files in ``skip`` (path), such as repeats of others, aren't
    parsed. Parsers run where the file is.
    """
    chains = {f: registry.chain(f) for p in registry.parsers for f in p.formats}
    todo = found if skip is None else found.join(skip.select("path"), "path", "left_anti")
    element = pa.struct([("pos", pa.int32()), ("type", pa.string()), ("content", pa.string()), ("page_number", pa.int32())])
    types = (pa.string(), pa.bool_(), pa.string(), pa.list_(pa.string()), pa.list_(element))

    def one(path: str, kind: str, content: bytes) -> tuple:
        tried, error = [], f"no parser for {kind}"
        for p in chains.get(kind, ()):
            tried.append(p.name)
            try:
                rows = [(t, c, n) for t, c, n in p.parse(path, content) if c and c.strip()]
                return p.name, True, None, tried, [{"pos": i, "type": t, "content": c, "page_number": n} for i, (t, c, n) in enumerate(rows)]
            except Exception as e:  # the next parser is tried
                error = f"{type(e).__name__}: {e}"
        return None, False, error, tried, []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [one(*x) for x in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names=["path", "parser", "success", "error", "attempts", "elements"])

    return todo.select("path", "format", "content").mapInArrow(run, _ROW)


def routed_elements(routed: DataFrame) -> DataFrame:
    """(path, pos, type, content, page_number) of parsed files."""
    return routed.select("path", F.inline("elements"))


def text_parser(path: str, content: bytes) -> list[tuple[str, str, int | None]]:
    """Markdown or plain text: "# " is a title, "## " and "### " are headings, anything else a paragraph."""
    out = []
    for line in content.decode("utf-8", "replace").splitlines():
        s = line.strip()
        kind = "title" if s.startswith("# ") else "heading" if s.startswith(("## ", "### ")) else "paragraph"
        out.append((kind, s if kind == "paragraph" else s.split(" ", 1)[1], None))
    return out


def pdf_text_parser(path: str, content: bytes) -> list[tuple[str, str, int | None]]:
    """Lines of a PDF's text layer by an external library, typed by font size and capitals; raises where the library is missing."""
    import pymupdf

    out = []
    for n, page in enumerate(pymupdf.open(stream=content, filetype="pdf"), 1):
        for block in page.get_text("dict")["blocks"]:
            for line in block.get("lines", ()):
                spans = line["spans"]
                text, size = "".join(s["text"] for s in spans).strip(), spans[-1]["size"] if spans else 0
                kind = "title" if size > 16 else "heading" if size > 14 or (text.isupper() and len(text) < 100) else "paragraph"
                out.append((kind, text, n))
    return out


def pdf_markdown_parser(path: str, content: bytes) -> list[tuple[str, str, int | None]]:
    """A PDF as Markdown by an external library, without pages."""
    import pymupdf
    import pymupdf4llm

    return text_parser(path, pymupdf4llm.to_markdown(pymupdf.open(stream=content, filetype="pdf")).encode())


def default_registry() -> Registry:
    """Parsers for text layers; those whose library is missing are unhealthy and fail over to the next."""
    r = Registry()
    r.add(Parser("pdf_markdown", pdf_markdown_parser, priority=10, check=optional("pymupdf4llm")))
    r.add(Parser("pdf_text", pdf_text_parser, priority=20, check=optional("pymupdf")))
    r.add(Parser("text", text_parser, ("html", "text", "unknown"), 50))
    return r


def first_attempt(*parse: Parse) -> Parse:
    """A parser that takes the first of several ways that succeeds, such as a model's main and spare address and none."""

    def run(path: str, content: bytes):
        error: Exception | None = None
        for p in parse:
            try:
                return p(path, content)
            except Exception as e:
                error = e
        raise error or ValueError("no way given")

    return run


def detected_languages(elements: DataFrame, detect: Callable[[str], list[str]], most: int = 1000) -> DataFrame:
    """(doc_id, languages) by a detector that reads the first characters of a document's text elements; without an answer the list is empty.

    The first ``most`` characters are what the detector is defined on.
    """
    body = elements.where(F.col("type").isin("paragraph", "narrative_text", "text", "title", "heading"))
    # only as many elements as the first characters need come together
    lengths = running(body, "doc_id", "pos", upto=("sum", F.length("content")))
    body = lengths.where(F.col("upto") - F.length("content") < most)
    first = body.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", F.substring("content", 1, most).alias("t")))).alias("r")).select("doc_id", F.substring(F.array_join(F.col("r.t"), " "), 1, most).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for t in b.column(1).to_pylist():
                try:
                    found.append(list(detect(t or "")))
                except Exception:
                    found.append([])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.string()))], names=["doc_id", "languages"])

    return first.mapInArrow(run, f"doc_id {dict(first.dtypes)['doc_id']}, languages array<string>")


def upscaled(found: DataFrame, resolution: DataFrame, upscale: Callable[[bytes], bytes]) -> DataFrame:
    """(path, content, needs_upscaling, used_upscaled, error) of files (path, content): those that resolution (path, needs_upscaling) marks, re-rendered by a function.

    Where that fails, the original stays.
    """
    j = found.select("path", "content").join(resolution.select("path", "needs_upscaling"), "path", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for _, content, need in zip(*(c.to_pylist() for c in b.columns)):
                try:
                    rows.append((upscale(content), need, True, None) if need else (content, bool(need), False, None))
                except Exception as e:
                    rows.append((content, need, False, f"{type(e).__name__}: {e}"))
            types = (pa.binary(), pa.bool_(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names=["path", "content", "needs_upscaling", "used_upscaled", "error"])

    return j.select("path", "content", "needs_upscaling").mapInArrow(run, "path string, content binary, needs_upscaling boolean, used_upscaled boolean, error string")

"""Elements from the JSON trees of a conversion service, one document a row."""

from __future__ import annotations

import html
import json
import re
from array import array
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame

#: Element type by item label; other texts are narrative.
TYPES = {"title": "title", "section_header": "title", "list_item": "list_item", "code": "code_snippet", "formula": "formula"}
SCHEMA = "pos int, type string, content string, page_number int, x0 double, y0 double, x1 double, y1 double, category_depth int, level int, section_title string, text_as_html string, error string"


def _grid(item: dict) -> list[list[str]]:
    return [[str(c.get("text", "")) for c in row] for row in item.get("data", {}).get("grid", [])]


def table_markdown(grid: list[list[str]]) -> str:
    """A pipe table whose first row is the head."""
    if not grid:
        return ""
    line = lambda cells: "| " + " | ".join(c.replace("|", "\\|").replace("\n", " ") for c in cells) + " |"
    return "\n".join([line(grid[0]), "|" + "---|" * len(grid[0]), *map(line, grid[1:])])


def table_html(grid: list[list[str]]) -> str:
    rows = ("".join(f"<{t}>{html.escape(c)}</{t}>" for c in row) for t, row in zip(["th"] + ["td"] * len(grid), grid))
    return "<table><tbody>" + "".join(f"<tr>{r}</tr>" for r in rows) + "</tbody></table>"


def box(bbox: dict, page_height: float | None) -> tuple[float, float, float, float]:
    """(left, top, right, bottom) from the top left corner, if the page's height is known."""
    x0, t, x1, b = (float(bbox[k]) for k in "ltrb")
    if page_height is not None and bbox.get("coord_origin", "TOPLEFT") != "TOPLEFT":
        t, b = page_height - t, page_height - b
    return x0, t, x1, b


def walk(tree: dict) -> Iterator[tuple[dict, int]]:
    """(item, depth) of the body in reading order; groups aren't items, furniture and what lies inside pictures is left out."""
    todo = [(iter(tree["body"]["children"]), 1)]
    while todo:
        refs, depth = todo[-1]
        for ref in refs:
            break
        else:
            todo.pop()
            continue
        _, kind, n = ref["$ref"].split("/")
        item = tree[kind][int(n)]
        if item.get("content_layer", "body") != "body":
            continue
        if kind != "groups":
            yield item, depth
        if kind != "pictures":
            todo.append((iter(item.get("children", [])), depth + 1))


def tree_elements(tree: dict) -> Iterator[tuple]:
    """Rows of SCHEMA without an error; headings are tracked before blank items are dropped."""
    heights = {int(k): p.get("size", {}).get("height") for k, p in tree.get("pages", {}).items()}
    stack: list[tuple[int, str]] = []
    n = 0
    for item, depth in walk(tree):
        label, as_html, level = item.get("label"), None, None
        if label in ("table", "document_index") and "data" in item:
            kind, grid = "table", _grid(item)
            content, as_html = table_markdown(grid), table_html(grid)
        elif "text" in item:
            kind, content = TYPES.get(label, "narrative_text"), item["text"]
        else:
            continue
        if label == "title" or label == "section_header":
            level = 0 if label == "title" else int(item.get("level", 1))
            while stack and stack[-1][0] >= level:
                stack.pop()
            stack.append((level, content))
        if not content.strip():
            continue
        prov = (item.get("prov") or [None])[0]
        page = prov["page_no"] if prov else None
        place = box(prov["bbox"], heights.get(page)) if prov else (None,) * 4
        yield n, kind, content, page, *place, depth if level is None else level, level, stack[-1][1] if stack else None, as_html, None
        n += 1


#: Bytes from which a tree's items are parsed one by one as they are reached; rows that become columns at once.
LARGE, SLICE = 1 << 20, 10_000
_MARK = re.compile(rb'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\],]', re.S)


class _Items:
    """A JSON array in a buffer, whose values are parsed as they are asked for."""

    def __init__(self, text: memoryview, bounds: array):
        self.text, self.bounds = text, bounds

    def __len__(self) -> int:
        return len(self.bounds) // 2

    def __getitem__(self, n: int):
        k = n if n >= 0 else n + len(self)
        if not 0 <= k < len(self):
            raise IndexError(n)
        return json.loads(str(self.text[self.bounds[2 * k] : self.bounds[2 * k + 1]], "utf-8"))


def parse_tree(text: memoryview, large: int = LARGE) -> dict:
    """The tree of a UTF-8 JSON text. In a large one the arrays under the root and in its objects are _Items, so that it isn't held as objects all at once.

    Each of their values is parsed here too, for what isn't JSON anywhere is an error.
    """
    if len(text) < large:
        return json.loads(str(text, "utf-8"))
    frame: list[bytes] = []  # the text with a number in place of what each such array holds
    lists: list[_Items] = []
    depth = inside = last = begin = 0
    bounds = None
    for m in _MARK.finditer(text):
        at, mark = m.start(), text[m.start()]
        if mark in b"{[":
            depth += 1
            if depth in (2, 3) and mark == ord("[") and bounds is None:
                frame.append(bytes(text[last : at + 1]))
                bounds, inside, begin = array("q"), depth, at + 1
        elif mark in b"}]":
            depth -= 1
            if bounds is not None and depth < inside:
                if len(bounds) or bytes(text[begin:at]).strip():
                    bounds.extend((begin, at))
                frame.append(b"%d" % len(lists))
                lists.append(_Items(text, bounds))
                bounds, last = None, at
        elif mark == ord(",") and bounds is not None and depth == inside:
            bounds.extend((begin, at))
            begin = at + 1
    tree = json.loads(str(b"".join([*frame, text[last:]]), "utf-8"))
    for items in lists:
        for k in range(len(items)):
            items[k]
    held = lambda v: lists[v[0]] if isinstance(v, list) else v
    return {k: {x: held(y) for x, y in v.items()} if isinstance(v, dict) else held(v) for k, v in tree.items()}


def docling_elements(documents: DataFrame) -> DataFrame:
    """(doc_id, pos, type, content, page_number, x0, y0, x1, y1, category_depth, level, section_title, text_as_html, error) of (doc_id, json).

    A document that isn't such a tree has one row with an error and nothing else; a null one has none. A tree is walked in the row
    that holds it, so documents aren't shuffled.
    """
    kind = dict(documents.dtypes)["doc_id"]
    names = ["doc_id", *(c.split()[0] for c in SCHEMA.split(", "))]
    types = [pa.int32(), pa.string(), pa.string(), pa.int32(), *[pa.float64()] * 4, pa.int32(), pa.int32(), *[pa.string()] * 3]

    def columns(ids: pa.Array, take: list[int], rows: list[tuple]) -> pa.RecordBatch:
        cols = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays([ids.take(pa.array(take, pa.int32())), *cols], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, take, rows = b.column(0), [], []
            for i, text in enumerate(b.column(1)):
                if not text.is_valid:
                    continue
                own, parts = [], []  # rows of a large document become columns, but wait until the whole of it is known to be valid
                try:
                    for row in tree_elements(parse_tree(memoryview(text.as_buffer()))):
                        own.append(row)
                        if len(own) == SLICE:
                            parts.append(columns(ids, [i] * SLICE, own))
                            own = []
                except (ValueError, KeyError, TypeError, IndexError, AttributeError):
                    own, parts = [(None,) * 12 + ("not a valid document tree",)], []
                yield from parts
                rows += own
                take += [i] * len(own)
                if len(rows) >= SLICE:
                    yield columns(ids, take, rows)
                    take, rows = [], []
            if rows:
                yield columns(ids, take, rows)

    return documents.select("doc_id", "json").mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


class Converter(Protocol):
    """Turns a file's bytes into a tree; may raise for one document without harm to others."""

    def __call__(self, name: str, content: bytes) -> dict: ...


#: The service's size limit and the states that carry a document.
MOST_BYTES, ACCEPTED = 100 * 1024 * 1024, ("success", "partial_success")


def http_converter(url: str, token: str | None = None, timeout: float = 300.0) -> Callable[[str, bytes], dict]:
    """A converter that posts the file to the service's /v1/convert/file; the address must be https or of this host."""
    from pagemill.sources.documents_api import checked_url

    base = checked_url(url)

    def convert(name: str, content: bytes) -> dict:
        import urllib.request
        import uuid

        mark = uuid.uuid4().hex
        head = f'--{mark}\r\nContent-Disposition: form-data; name="files"; filename="{name}"\r\nContent-Type: application/octet-stream\r\n\r\n'
        formats = f'\r\n--{mark}\r\nContent-Disposition: form-data; name="to_formats"\r\n\r\njson\r\n--{mark}--\r\n'
        headers = {"Content-Type": f"multipart/form-data; boundary={mark}"} | ({"Authorization": f"Bearer {token}"} if token else {})
        request = urllib.request.Request(f"{base}/v1/convert/file", head.encode() + content + formats.encode(), headers)
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return json.load(r)

    return convert


def converted(found: DataFrame, convert: Converter, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(path, status, json, error) of files (path, content): each file's tree by the converter; failures, oversized files and other states are rows with an error.

    A partial conversion carries its tree and the status ``requires_review``, so that it can be refused where it would be written.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    if content is None or len(content) > most_bytes:
                        raise ValueError("file is empty or exceeds the size limit")
                    answer = convert(path.rsplit("/", 1)[-1], content)
                    state = answer.get("status", "failure")
                    if state not in ACCEPTED:
                        raise ValueError(f"conversion ended with status {state}")
                    tree = answer["document"]["json_content"]
                    rows.append(("completed" if state == "success" else "requires_review", json.dumps(tree), None))
                except Exception as e:  # one document's failure is a row
                    rows.append(("failed", None, f"{type(e).__name__}: {e}"))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.string()) for c in zip(*rows))], names=["path", "status", "json", "error"])

    return found.select("path", "content").mapInArrow(run, "path string, status string, json string, error string")

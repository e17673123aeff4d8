"""Splitting oversized items at natural boundaries.

Method: recursive bisection. An item over the limit is cut at the strongest boundary near its
midpoint; halves that still exceed the limit less the overlap are cut again; then every piece but
the first gets the last tokens of the one before it as overlap.

A token is a maximal run of characters that are not Unicode white space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.arrow import map_batches

#: Fixed value: characters with the Unicode property White_Space, as Java's and regex's classes.
JAVA_SPACE = r"[\t-\r\x{85}\p{Z}]"
_TOKEN = regex.compile(r"[^\t-\r\x85\p{Z}]+")

#: Boundary strengths, strongest first; what counts as a line, row, entry or block depends on the type.
BLOCK, LINE, SENTENCE, CLAUSE, WORD = 4, 3, 2, 1, 0
_SENTENCE_END = tuple(".!?。！？…")
_CLAUSE_END = tuple(",;:)—、；：")
_CLOSERS = "\"'”’)]»"
_CODE_BLOCK = ("def ", "class ", "@", "SELECT ", "function ", "func ", "public ", "import ", "#", "```")
_LIST_ENTRY = regex.compile(r"(?:[-*•–]|\(?\d{1,3}[.)]|\(?[a-z][.)])$")


def n_tokens(c: Column) -> Column:
    """Number of tokens, in the JVM; 0 for null and blank text."""
    stripped = F.regexp_replace(c, f"^{JAVA_SPACE}+", "")
    parts = F.size(F.split(stripped, f"{JAVA_SPACE}+")) - F.when(F.regexp_like(stripped, F.lit(f"{JAVA_SPACE}$")), 1).otherwise(0)
    return F.when(F.coalesce(F.length(stripped), F.lit(0)) == 0, 0).otherwise(parts)


def kind_of(item_type: str | None) -> str:
    """table, list, code or prose, from a dirty chunk or element type."""
    t = (item_type or "").strip().lower()
    return "table" if t.startswith("table") else "list" if t.startswith("list") else "code" if t in ("code", "formula") else "prose"


def boundaries(text: str, spans: list[tuple[int, int]], kind: str) -> np.ndarray:
    """Strength of the boundary before each token; the first has none."""
    out = np.zeros(len(spans), np.int8)
    for i in range(1, len(spans)):
        gap = text[spans[i - 1][1] : spans[i][0]]
        last = text[spans[i - 1][0] : spans[i - 1][1]].rstrip(_CLOSERS)
        word = text[spans[i][0] : spans[i][1]]
        lines = gap.count("\n") + gap.count(" ") + (gap.count("\r") if "\n" not in gap else 0)
        ends = last.endswith(_SENTENCE_END) and not (word[:1].islower())
        if lines >= 2:
            out[i] = BLOCK
        elif lines and kind == "code":
            out[i] = BLOCK if text.startswith(_CODE_BLOCK, spans[i][0]) else LINE
        elif lines and (kind == "table" or (kind == "list" and _LIST_ENTRY.match(word)) or (kind == "prose" and ends)):
            out[i] = LINE
        elif ends and kind != "code":
            out[i] = SENTENCE
        elif lines or last.endswith(_CLAUSE_END) or (kind == "table" and word == "|"):
            out[i] = CLAUSE
    return out


def cut_places(strength: np.ndarray, limit: int) -> list[int]:
    """First token of every piece, by bisection: within the middle half, the strongest boundary nearest the midpoint."""
    starts, todo = [], [(0, len(strength))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= limit:
            starts.append(lo)
            continue
        mid, reach = (lo + hi) // 2, max(1, (hi - lo) // 4)
        a, b = max(lo + 1, mid - reach), min(hi, mid + reach + 1)
        window = strength[a:b]
        places = np.flatnonzero(window == window.max()) + a
        cut = int(places[np.argmin(np.abs(places - mid))])
        todo += [(lo, cut), (cut, hi)]
    return sorted(starts)


def split_text(text: str, kind: str = "prose", limit: int = 512, overlap: int = 0) -> list[dict]:
    """Pieces (content, n_tokens, n_overlap) of one text.

    Pieces keep the text between their first and last token exactly; a text within the limit
    is one piece. A null or blank text has none.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be at least 0 and under the limit")
    spans = [m.span() for m in _TOKEN.finditer(text or "")]
    if not spans:
        return []
    starts = [0] if len(spans) <= limit else cut_places(boundaries(text, spans, kind), limit - overlap)
    ends = starts[1:] + [len(spans)]
    out = []
    for i, (a, b) in enumerate(zip(starts, ends)):
        first = max(0, a - overlap) if i else a
        out.append({"content": text[spans[first][0] : spans[b - 1][1]], "n_tokens": b - first, "n_overlap": a - first})
    return out


def split_oversized(df: DataFrame, key_cols: list[str], content_col: str, type_col: str, limit: int = 512, overlap: int = 64) -> DataFrame:
    """(keys, item_tokens, piece_no, n_pieces, content, n_tokens, n_overlap) of every item over the limit.

    Only items that are too long leave the JVM; they are found by a length test, then by a count of
    tokens, whatever stored counts say. Null and blank contents and items within the limit
    give no row; a null type is prose; repeated rows count once; very long texts are cut whole in
    n log n time; other columns are ignored; empty tables give an empty result.
    """
    long = F.length(content_col) > 2 * limit  # limit + 1 tokens have at least limit spaces
    items = df.where(long).select(*key_cols, F.col(content_col).alias("_text"), F.col(type_col).alias("_type")).where(n_tokens(F.col("_text")) > limit).distinct()
    kinds = dict(items.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in key_cols) + ", item_tokens int, piece_no int, n_pieces int, content string, n_tokens int, n_overlap int"

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        texts, types = b.column(len(key_cols)).to_pylist(), b.column(len(key_cols) + 1).to_pylist()
        rows, take = [], []
        for i, (text, kind) in enumerate(zip(texts, types)):
            pieces = split_text(text, kind_of(kind), limit, overlap)
            total = sum(p["n_tokens"] - p["n_overlap"] for p in pieces)
            for n, p in enumerate(pieces):
                take.append(i)
                rows.append((total, n, len(pieces), p["content"], p["n_tokens"], p["n_overlap"]))
        keys = [b.column(k).take(pa.array(take, pa.int32())) for k in range(len(key_cols))]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32())
        cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(keys + cols, names=key_cols + ["item_tokens", "piece_no", "n_pieces", "content", "n_tokens", "n_overlap"])

    return map_batches(items, cut, schema)

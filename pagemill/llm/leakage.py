"""Evaluation passages that leak into training text.

Method: spaced-seed hashing. Fixed masks over a window of words hash some positions and ignore
the others, so that a changed word at an ignored position doesn't hide a match. Seeds of the test
passages are met by seeds of every document; around a hit the overlap is verified word by word
along the alignment, with a tolerated share of changed words.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.arrow import map_batches
from pagemill.llm.words import word_code, word_codes
from pagemill.plans.stages import stored

#: Masks (1: hashed, 0: ignored). In every 20 words with at most two changed, one of them has a hit (tests/llm).
MASKS = ("1101011", "11100101")
_WORD = regex.compile(r"[^\W_]+")
_MARKS = regex.compile(r"\p{M}+|(?<=\w)['’ʼ`´](?=\w)|\p{Cf}+")
_ASCII_WORD = re.compile("[a-z0-9]+").findall
_QUESTION = regex.compile(r"^\s*question\s*:", regex.I)


def normal_words(text: str | None) -> list[str]:
    """Words apart from case, punctuation, accents, quotation marks, zero-width characters and spacing."""
    if not text:
        return []
    if text.isascii():
        return _ASCII_WORD(text.replace("'", "").lower())
    return _WORD.findall(_MARKS.sub("", unicodedata.normalize("NFKD", text)).casefold())


def seed_hashes(codes: np.ndarray, masks: tuple[str, ...] = MASKS) -> list[np.ndarray]:
    """Per mask, the hash at each place where the whole mask fits."""
    out = []
    for k, mask in enumerate(masks):
        n = len(codes) - len(mask) + 1
        h = np.full(max(n, 0), 0x9E3779B97F4A7C15 + k, np.uint64)
        for i, bit in enumerate(mask):
            if bit == "1" and n > 0:
                h = (h ^ codes[i : i + n]) * np.uint64(0x9FB21C651E98DF25)
                h ^= h >> np.uint64(31)
        out.append(h)
    return out


def passages(benchmark: DataFrame, least_shared: int = 2) -> DataFrame:
    """(item_id, passage) without question lines and without first lines that several items share."""

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        rest, firsts, keys = [], [], []
        for text in b.column(1).to_pylist():
            lines = [x for x in text.splitlines() if x.strip() and not _QUESTION.match(x)]
            firsts.append(lines[0] if lines else "")
            keys.append(" ".join(normal_words(firsts[-1])))
            rest.append("\n".join(lines[1:]))
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.string()) for c in (firsts, keys, rest))], names=["item_id", "first", "key", "rest"])

    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    parts = stored(map_batches(items, cut, "item_id bigint, first string, key string, rest string"), "benchmark-items")
    shared = parts.where("rest <> ''").join(parts.groupBy("key").agg(F.countDistinct("item_id").alias("n")).where(F.col("n") >= least_shared).select("key"), "key", "left_semi")
    whole = parts.join(shared.select("item_id", "key", "rest").distinct(), ["item_id", "key", "rest"], "left_anti")
    return shared.select("item_id", F.col("rest").alias("passage")).unionByName(whole.select("item_id", F.concat_ws("\n", "first", F.nullif("rest", F.lit(""))).alias("passage")))


def passage_blocks(items: DataFrame, most_bytes: int) -> list[DataFrame]:
    """The passages in blocks of at most that many bytes by their measured sizes (a longer passage is a block of its own)."""
    total = items.agg(F.sum(F.octet_length("passage"))).first()[0] or 0
    if total <= most_bytes:
        return [items]
    w = Window.orderBy("item_id", "passage")  # one row per item of the benchmark, ids and sizes only
    sizes = items.select("item_id", F.xxhash64("passage").alias("_h"), F.octet_length("passage").alias("size"), "passage").select("item_id", "_h", F.sum("size").over(w).alias("upto"), "size")
    blocks = stored(sizes.withColumn("block", F.floor((F.col("upto") - F.col("size")) / most_bytes).cast("int")), "benchmark-blocks")
    placed = items.withColumn("_h", F.xxhash64("passage")).join(blocks.select("item_id", "_h", "block"), ["item_id", "_h"]).drop("_h")
    placed = stored(placed, "benchmark-placed")
    return [placed.where(F.col("block") == k).drop("block") for k in sorted(r[0] for r in placed.select("block").distinct().collect())]


class Index:
    """Seeds of the test passages: a sorted array for the test of membership and the places of each seed."""

    def __init__(self, items: list[tuple[int, str]], masks: tuple[str, ...] = MASKS):
        self.masks, self.ids, self.codes = masks, [], []
        keys: list[np.ndarray] = []
        places: list[np.ndarray] = []
        for n, (item, text) in enumerate(items):
            codes = np.frombuffer(b"".join(map(word_code, normal_words(text))), np.uint64)
            self.ids.append(item)
            self.codes.append(codes)
            for h in seed_hashes(codes, masks):
                keys.append(h)
                places.append(np.stack([np.full(len(h), n), np.arange(len(h))], 1))
        key = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.place = (np.concatenate(places) if places else np.empty((0, 2), int))[order]
        # one bit per value of the low 20 bits: most seeds of the corpus end here
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.key & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, codes: np.ndarray, ends: np.ndarray) -> dict[tuple[int, int], set[int]]:
        """(document, item) -> diagonals of the seed hits; codes holds the documents one after another, ends where each ends.

        A diagonal is the place in the document less the place in the passage.
        """
        found: dict[tuple[int, int], set[int]] = {}
        starts = np.concatenate([[0], ends[:-1]])
        for mask, h in zip(self.masks, seed_hashes(codes, self.masks)):
            at = np.flatnonzero(self.filter[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
            lo, hi = np.searchsorted(self.key, h[at], "left"), np.searchsorted(self.key, h[at], "right")
            at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
            doc = np.searchsorted(ends, at, "right")
            inside = at + len(mask) <= ends[doc] if len(at) else np.empty(0, bool)
            for p, a, b, k in zip(at[inside].tolist(), lo[inside].tolist(), hi[inside].tolist(), doc[inside].tolist()):
                first = int(starts[k])
                for n, q in self.place[a:b].tolist():
                    found.setdefault((k, n), set()).add(p - first - q)
        return found


def longest_overlap(same: np.ndarray, tolerance: float) -> int:
    """Length of the longest stretch that begins and ends with equal words and has at most that share of changed ones."""
    good = np.flatnonzero(same)
    if not len(good):
        return 0
    # score(i) = sum over words up to i of (tolerance - changed); a stretch is allowed where it doesn't fall
    s = np.concatenate([[0.0], np.cumsum(np.where(same, tolerance, tolerance - 1.0))])
    lowest = np.minimum.accumulate(s)
    best = 0
    for e in good[::-1]:
        if e + 1 <= best:
            break
        first = int(np.searchsorted(-lowest[: e + 2], -(s[e + 1] + 1e-9), "left"))
        while first <= e and not same[first]:
            first += 1
        if s[e + 1] - s[first] >= -1e-9:
            best = max(best, e + 1 - first)
    return best


def overlap_length(index: Index, n: int, codes: np.ndarray, diagonals: list[int], tolerance: float, slip: int = 2) -> int:
    """Longest verified overlap with passage n along the hit diagonals.

    Diagonals that differ by a few inserted or lost words are joined in order: the words of a chain are those of its diagonals' stretches,
    each word of the document standing for one of the passage at most and later ones for later ones.
    """
    p = index.codes[n]
    best = 0
    chain: list[int] = []
    for d in [*sorted(diagonals), None]:
        if chain and (d is None or d - chain[-1] > slip):
            places = np.full(len(p), -1, np.int64)  # of the document, by word of the passage
            for x in chain:
                lo, hi = max(0, -x), min(len(p), len(codes) - x)
                if hi > lo:
                    at = np.arange(lo, hi)
                    own = at[(p[lo:hi] == codes[lo + x : hi + x]) & (places[lo:hi] < 0)]
                    places[own] = own + x
            taken = np.flatnonzero(places >= 0)
            if len(taken):
                # only what goes on in the document counts: a place at or before an earlier one is a repeat
                upto = np.maximum.accumulate(places[taken])
                ahead = np.append(True, places[taken][1:] > upto[:-1])
                same = np.zeros(len(p), bool)
                same[taken[ahead]] = True
                best = max(best, longest_overlap(same, tolerance))
            chain = []
        if d is not None:
            chain.append(d)
    return best


@lru_cache(maxsize=4)
def _index(items: tuple[tuple[int, str], ...]) -> Index:
    return Index(list(items))


def leaked_items(documents: DataFrame, benchmark: DataFrame, least_words: int = 20, tolerance: float = 0.1, id_col: str = "doc_id", text_col: str = "text", most_benchmark_bytes: int = 64 << 20) -> DataFrame:
    """(doc_id, item_id, overlap_words) of every document that holds a long enough part of a test passage.

    The benchmark's passages are broadcast in blocks of at most most_benchmark_bytes, measured before they are collected; each block is matched in its own
    pass over the documents, and a fixed held-out set is one block.
    Documents are not shuffled.

    Null and empty texts and passages under least_words give no row; repeated rows add
    none; every text is read whole; other columns are ignored; empty tables give an empty result.
    """
    kind = dict(documents.dtypes)[id_col]
    out = None
    for block in passage_blocks(stored(passages(benchmark), "passages"), most_benchmark_bytes):
        shipped = documents.sparkSession.sparkContext.broadcast(tuple(sorted((r["item_id"], r["passage"]) for r in block.collect())))

        def match(b: pa.RecordBatch, shipped=shipped) -> pa.RecordBatch | None:
            index = _index(shipped.value)
            memo = word_codes()
            rows, take = [], []
            parts = [b"".join(map(memo.__getitem__, normal_words(text))) for text in b.column(1).to_pylist()]
            ends = np.cumsum([len(p) // 8 for p in parts])
            codes = np.frombuffer(b"".join(parts), np.uint64)
            for (k, n), diagonals in index.hits(codes, ends).items():
                own = codes[ends[k] - len(parts[k]) // 8 : ends[k]]
                length = overlap_length(index, n, own, list(diagonals), tolerance)
                if length >= least_words:
                    rows.append((index.ids[n], length))
                    take.append(k)
            if not rows:
                return None
            return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(take, pa.int32())), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32())], names=[id_col, "item_id", "overlap_words"])

        part = map_batches(documents.select(id_col, text_col), match, f"`{id_col}` {kind}, item_id bigint, overlap_words int")
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def leaks_per_item(leaks: DataFrame) -> DataFrame:
    """Per leaked item, the number of documents and the longest overlap."""
    return leaks.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("overlap_words").alias("longest_overlap"))

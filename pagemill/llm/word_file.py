"""Known words beyond what a worker holds as objects: a sorted file that is mapped into memory, shared by a machine's workers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.arrow import Memo

_PARTS = ("text", "ends", "counts", "keys")


def write_words(known: DataFrame, trusted) -> tuple[str, tuple[int, int]]:
    """Sends (word, n_digital, n_scanned) in sorted order to every machine's disk; the file's name, and the sums of both counts.

    trusted(n_digital, n_scanned, sums) tells which words may be meant by others; those without a hyphen are the trie's keys. The
    driver holds a partition of the words at a time.
    """
    sums = tuple(int(x or 0) for x in known.agg(F.sum("n_digital"), F.sum("n_scanned")).first())
    name, folder, end = f"words-{uuid.uuid4().hex}", Path(tempfile.mkdtemp(prefix="pagemill-words-")), 0
    files = {p: (folder / f"{name}.{p}").open("wb") for p in _PARTS}
    for n, r in enumerate(known.select("word", "n_digital", "n_scanned").orderBy("word").toLocalIterator()):
        text = r[0].encode()
        end += len(text)
        files["text"].write(text)
        files["ends"].write(np.int64(end).tobytes())
        files["counts"].write(np.array(r[1:], np.int64).tobytes())
        if "-" not in r[0] and trusted(r[1], r[2], sums):
            files["keys"].write(np.int64(n).tobytes())
    for p, f in files.items():
        f.close()
        known.sparkSession.sparkContext.addFile(str(folder / f"{name}.{p}"))
    return name, sums


class _Words(Sequence):
    """Words of the file at the given places (all: None), sorted."""

    def __init__(self, text: np.ndarray, ends: np.ndarray, at: np.ndarray | None = None):
        self.text, self.ends, self.at = text, ends, at

    def __len__(self) -> int:
        return len(self.ends if self.at is None else self.at)

    def __getitem__(self, n: int) -> str:
        k = n if self.at is None else int(self.at[n])
        return self.text[(int(self.ends[k - 1]) if k else 0) : int(self.ends[k])].tobytes().decode()


class WideCounts(dict):
    """Counts of the most frequent words as a dict; those of the others come from the file as they are asked for."""

    def __init__(self, head: dict[str, tuple[int, int]], name: str, sums: tuple[int, int]):
        super().__init__(head)
        read = lambda p, t: np.memmap(at, t, "r") if Path(at := SparkFiles.get(f"{name}.{p}")).stat().st_size else np.empty(0, t)
        text, ends = read("text", np.uint8), read("ends", np.int64)
        self.sums, self.words, self.pairs, self.keys_in_order = sums, _Words(text, ends), read("counts", np.int64).reshape(-1, 2), _Words(text, ends, read("keys", np.int64))
        self.rest = Memo(self._find, 300_000)

    def _find(self, word: str) -> tuple[int, int] | None:
        lo, hi = 0, len(self.words)
        while lo < hi:
            mid = (lo + hi) // 2
            if self.words[mid] < word:
                lo = mid + 1
            else:
                hi = mid
        return tuple(self.pairs[lo].tolist()) if lo < len(self.words) and self.words[lo] == word else None

    def get(self, word, default=None):
        return super().get(word) or self.rest[word] or default

    def __missing__(self, word):
        if (found := self.rest[word]) is None:
            raise KeyError(word)
        return found

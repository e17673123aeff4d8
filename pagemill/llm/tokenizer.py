"""Encoding of text with a public byte-pair tokenizer.

Method: bytes are mapped to Latin-1 characters, so that pyahocorasick finds every vocabulary
entry in a piece of text in one pass. The encoder takes the longest entry at each place and goes back
to shorter ones where two adjacent tokens could not stand beside each other; whether they can
is derived from the merge ranks and memoised. A place from which no encoding goes on is marked
and never tried again, so the work is linear in the text and the result is that of the merges.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.arrow import Memo, map_batches

#: Fixed value: the pre-tokenisation pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What PATTERN means for ASCII text, which the standard library matches faster.
ASCII_PATTERN = r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
_NO_LIMIT = 1 << 40


class BacktrackingBpe:
    """Exact byte-pair encoding of one vocabulary {token bytes: rank}, in which ranks are the ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, bound: int = 200_000):
        import ahocorasick
        import regex

        self.tokens = sorted(ranks, key=ranks.get)
        self.size = {r: len(t) for t, r in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.split_ascii = re.compile(ASCII_PATTERN).findall if pattern == PATTERN else self.split
        text = {r: t.decode("latin-1") for t, r in ranks.items()}
        ids = {t: r for r, t in text.items()}
        self.automaton = ahocorasick.Automaton()
        for r, t in text.items():
            self.automaton.add_word(t, (r, len(t)))
        self.automaton.make_automaton()
        self.shorter = {r: next((ids[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in ids), -1) for r, t in text.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.fits = Memo(self._fits, 4 * bound)
        for token in self.tokens:
            self._learn_parts(ranks[token], text[ranks[token]], ids)
        self.fits.clear()
        self.packed = Memo(self._pack, bound)

    def _learn_parts(self, r: int, t: str, ids: dict[str, int]) -> None:
        left = self.shorter[r]
        while left >= 0:
            right = ids.get(t[self.size[left] :])
            if right is not None and left < r and right < r and self._fits((left, right)):
                self.parts[r] = (left, right)
                self.merged[left, right] = r
                return
            left = self.shorter[left]
        self.parts[r] = (r, r)

    def _fits(self, pair: tuple[int, int]) -> bool:
        """Whether encoding the concatenation of two tokens keeps the border between them.

        Undoes merges of either side in reverse rank order and looks for a merge across the border that
        would have come first.
        """
        a, b = pair
        limit = _NO_LIMIT
        while True:
            if self.merged.get((a, b), _NO_LIMIT) < limit:
                return False
            left_first = a > b
            for undo_left in (left_first, not left_first):
                if undo_left:
                    inner = self.parts[a][1]
                    if inner != a:
                        limit, a = a, inner
                        break
                else:
                    inner = self.parts[b][0]
                    if inner != b:
                        limit, b = b + 1, inner
                        break
            else:
                return True

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one pre-token."""
        raw = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        longest = [-1] * len(raw)
        for end, (r, n) in self.automaton.iter(raw):
            longest[end - n + 1] = r  # ends come in rising order: the last is the longest
        size, shorter, fits = self.size, self.shorter, self.fits
        dead = bytearray(len(raw) + 1)
        out: list[int] = []
        pos, candidate = 0, longest[0] if raw else -1
        while pos < len(raw):
            while candidate >= 0:
                end = pos + size[candidate]
                if not dead[end] and (not out or fits[out[-1], candidate]):
                    break
                candidate = shorter[candidate]
            if candidate >= 0:
                out.append(candidate)
                pos = end
                candidate = longest[pos] if pos < len(raw) else -1
            else:
                if not out:
                    raise ValueError("the vocabulary lacks a byte of the text")
                dead[pos] = 1
                candidate = out.pop()
                pos -= size[candidate]
        return out

    def _pack(self, piece: str) -> bytes:
        ids = self.encode_piece(piece)
        return struct.pack(f"<{len(ids)}i", *ids)

    def encode_packed(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a whole text."""
        pieces = self.split_ascii(text) if text.isascii() else self.split(text)
        return b"".join(map(self.packed.__getitem__, pieces))

    def encode(self, text: str) -> list[int]:
        b = self.encode_packed(text)
        return list(struct.unpack(f"<{len(b) // 4}i", b))


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """A vocabulary file with one base64 token and its rank per line."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in raw.splitlines() if line.strip())}


@lru_cache(maxsize=2)
def _built(digest: str, holder) -> BacktrackingBpe:
    return BacktrackingBpe(parse_ranks(holder.raw))


class _Raw:
    """Bytes that hash by content, so that a worker builds each vocabulary once."""

    def __init__(self, raw: bytes):
        self.raw, self.digest = raw, hashlib.sha256(raw).hexdigest()

    def __hash__(self):
        return hash(self.digest)

    def __eq__(self, other):
        return self.digest == other.digest


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> str:
    """Where a public vocabulary lies; folder is a parameter, by default the installed package's."""
    if folder is None:
        try:
            import public_tokenizers

            folder = str(Path(public_tokenizers.__file__).parent)
        except ImportError:
            folder = "/opt/tokenizers"
    return str(Path(folder) / name)


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(id, ids ARRAY<INT>) of every text, without special tokens; strings of special tokens are ordinary text.

    Null and empty texts give an empty list; a null id keeps its row; very long texts are
    encoded whole in linear time; repeated rows give one row per id only where the whole row is repeated and the caller removes it
    (see one_row_per_id); other columns, whatever their names, are ignored; an empty table gives an empty result. The
    vocabulary (about 1 MB, a fixed file) is the only thing broadcast.
    """
    raw = Path(vocabulary or vocabulary_path()).read_bytes()
    shipped = df.sparkSession.sparkContext.broadcast(raw)

    def encode(b: pa.RecordBatch) -> pa.RecordBatch:
        holder = _Raw(shipped.value)
        model = _built(holder.digest, holder)
        parts, offsets, total = [], [0], 0
        for t in b.column(1).to_pylist():
            if t:
                p = model.encode_packed(t)
                parts.append(p)
                total += len(p) // 4
            offsets.append(total)
        values = pa.Array.from_buffers(pa.int32(), total, [None, pa.py_buffer(b"".join(parts))])
        return pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], names=[id_col, "ids"])

    kind = dict(df.dtypes)[id_col]
    return map_batches(df.select(id_col, text_col), encode, f"`{id_col}` {kind}, ids array<int>")


def one_row_per_id(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one row per id (the smallest text, nulls last); without a shuffle of texts where ids are already unique.

    Only ids that occur more than once go through an aggregation of their texts.
    """
    repeated = df.groupBy(id_col).count().where("count > 1").select(F.col(id_col).alias("_rep"))
    if repeated.limit(1).count() == 0:
        return df.select(id_col, text_col)
    again = F.broadcast(repeated) if repeated.count() <= 100_000 else repeated
    same = df[id_col].eqNullSafe(F.col("_rep"))
    once = df.join(again, same, "left_anti").select(id_col, text_col)
    more = df.join(again, same, "left_semi").groupBy(id_col).agg(F.min(text_col).alias(text_col))
    return once.unionByName(more)


def decode_corpus(encoded: DataFrame, id_col: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """(id, text) of (id, ids): the text that ids spell, a null list spelling none."""
    from functools import partial

    path = vocabulary or vocabulary_path()
    shipped = encoded.sparkSession.sparkContext.broadcast(open(path, "rb").read())  # the vocabulary file, of fixed size
    kind = dict(encoded.dtypes)[id_col]

    def decode(b: pa.RecordBatch, memo: dict) -> pa.RecordBatch:
        if not memo:
            memo.update((i, t) for t, i in parse_ranks(shipped.value).items())
        texts = [None if ids is None else b"".join(map(memo.__getitem__, ids)).decode() for ids in b.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return map_batches(encoded.select(id_col, "ids"), partial(decode, memo={}), f"`{id_col}` {kind}, text string")

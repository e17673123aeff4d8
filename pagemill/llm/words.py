"""Words and their codes, shared by the operators that compare texts."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pagemill.llm.arrow import Memo

#: Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ѐ": "e", "ё": "e", "ї": "i", "ı": "i", "ɑ": "a", "ɡ": "g", "օ": "o", "ո": "n", "ս": "u",
}
_ASCII = re.compile("[a-z0-9]+").findall
_WORD = re.compile(r"[^\W_]+").findall
_DROPPED = re.compile(r"(?<=\w)['’ʼ`´](?=\w)|[­​-‏⁠﻿]")
_M64 = (1 << 64) - 1


class _Folding(dict):
    """For str.translate on decomposed text: combining marks go, look-alikes become Latin; filled as characters occur."""

    def __missing__(self, code: int):
        c = chr(code)
        value = self[code] = None if unicodedata.combining(c) else LOOK_ALIKES.get(c, c)
        return value


_FOLDING = _Folding()
#: ASCII bytes: capitals as small letters, all but letters and digits as blanks; apostrophes are deleted.
_BYTES = bytes(ord(chr(b).lower()) if chr(b).isalnum() and b < 128 else 32 for b in range(256))


def folded_codes(text: str | None) -> bytes:
    """Codes of folded_words(text), 8 bytes each."""
    memo = word_codes()
    if text and text.isascii():
        return b"".join(map(memo.__getitem__, text.encode().translate(_BYTES, b"'").split()))
    return b"".join(map(memo.__getitem__, folded_words(text)))


def folded_words(text: str | None) -> list[str]:
    """Words apart from case, punctuation, white space, accents and look-alike characters."""
    if not text:
        return []
    if text.isascii():
        return _ASCII(text.lower().replace("'", ""))
    t = unicodedata.normalize("NFKD", _DROPPED.sub("", text)).casefold()
    return _WORD(t.translate(_FOLDING))


def word_code(w: str | bytes) -> bytes:
    """A 64-bit code of a word (text or its UTF-8), the same in every process, as 8 bytes."""
    h = 0xCBF29CE484222325
    for b in w.encode("utf-8", "surrogatepass") if isinstance(w, str) else w:
        h = ((h ^ b) * 0x100000001B3) & _M64
    h ^= h >> 29
    return ((h * 0xBF58476D1CE4E5B9) & _M64).to_bytes(8, "little")


@lru_cache(maxsize=1)
def word_codes() -> Memo:
    return Memo(word_code)

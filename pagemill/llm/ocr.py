"""Noise in text from scanned pages.

Method: the words of the whole corpus give a vocabulary, kept as a trie; a Levenshtein automaton
that runs along the trie finds every vocabulary word near a suspicious token, with characters that recognisers
confuse as one letter; candidates are ranked by how the confusions explain the token, by
neighbouring words and by frequency. Then running heads and page numbers go, broken words are joined and paragraphs
are put together in reading order.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter, defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.arrow import Memo, map_batches
from pagemill.llm.word_file import WideCounts, write_words
from pagemill.plans.stages import stored

#: True letters and what a recogniser reads for them.
CONFUSIONS = {
    "o": ("0",), "s": ("5",), "l": ("1", "|", "!", "i"), "i": ("1", "!", "|", "l"), "a": ("à", "á", "4", "@"), "c": ("¢",), "t": ("†", "f"), "e": ("c", "é"), "h": ("b", "li", "ii"),
    "y": ("v",), "g": ("q", "9"), "b": ("6", "8"), "z": ("2",), "f": ("t",), "u": ("v", "ii"), "m": ("rn", "nn"), "d": ("cl",), "w": ("vv",), "n": ("ri", "ii"), "k": ("lc",),
    "in": ("m",), "li": ("h",), "ti": ("h",), "rn": ("m",), "cl": ("d",), "ri": ("n",), "fi": ("\ue000l", "h"),
}
_SINGLE = {t: r for t, r in CONFUSIONS.items() if len(t) == 1}
_PAIRS_BY_FIRST: dict[str, list] = {}
for _t, _r in CONFUSIONS.items():
    if len(_t) == 2:
        _PAIRS_BY_FIRST.setdefault(_t[0], []).append((_t, _r))
_ONE = str.maketrans({"0": "o", "5": "s", "1": "l", "|": "l", "!": "l", "i": "l", "¢": "c", "e": "c", "†": "t", "f": "t", "b": "h", "v": "y", "q": "g", "9": "g", "4": "a", "@": "a", "6": "h", "8": "h", "2": "z", "u": "h"})

HYPHENS = "-‐‑¬­"
_TOKEN = re.compile(r"[^\W_](?:[^\s.,;:()\[\]{}\"“”„…/\\—–_=<>]*[^\W_])?[|!†¢]?|[|!†¢][^\W\d_][^\s.,;:()\[\]{}\"“”]*")
_NUMBER = r"[0-9lIOoSs|!]{1,4}"
_ROMAN = r"[ivxlcdm]{1,8}"
_PAGE_NO = re.compile(rf"^(?:[—–-]\s*{_NUMBER}\s*[—–-]|\[\s*{_NUMBER}\s*\]|(?:p\.|p[gq]\.?|p[aà][gq][ec]|seite)\s*{_NUMBER}(?:\s*(?:of|/|von)\s*{_NUMBER})?|{_NUMBER}\s*/\s*{_NUMBER}|{_NUMBER}|{_ROMAN})$", re.I)
_MARKED_NO = rf"(?:[—–-]\s*{_NUMBER}\s*[—–-]|\[\s*{_NUMBER}\s*\]|(?:p\.|p[gq]\.?|p[aà][gq][ec]|seite)\s*{_NUMBER}(?:\s*(?:of|/|von)\s*{_NUMBER})?|{_NUMBER}\s*/\s*{_NUMBER})"
_BEFORE = re.compile(rf"^({_MARKED_NO}|{_NUMBER}|{_ROMAN})\s{{2,}}(\S.*)$", re.I)
_AFTER = re.compile(rf"^(.*\S)\s{{2,}}({_MARKED_NO}|{_NUMBER}|{_ROMAN})$", re.I)
_BROKEN = re.compile(rf"([^\W\d_]+)([{HYPHENS}])[ \t]*\n[ \t]*([^\W\d_]+)")
_OPEN_END = re.compile(rf"([^\W\d_]+)([{HYPHENS}])\s*$")
_HYPHEN_BREAK = re.compile(rf"[{HYPHENS}][ \t]*\n")
_HYPHEN_SET = frozenset(HYPHENS)
_FIRST_WORD = re.compile(r"^\s*([^\W\d_]+)")
_MIXED = re.compile(r"^[^\W\d_]*[a-z][01345689|!¢†][a-z][^\W\d_]*$|^[A-Z]?[a-z]{3,}[015|¢†]$|^[015|!¢†][a-z]{3,}$")


def fold(word: str) -> str:
    """A word with letters that recognisers confuse as one, for the comparison of lines that return."""
    w = word.casefold()
    if not w.isascii():
        w = "".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c))
    w = w.translate(_ONE)
    for a, b in (("ll", "h"), ("rn", "m"), ("ln", "m"), ("yy", "w"), ("cl", "d"), ("rl", "n"), ("tl", "h")):
        w = w.replace(a, b)
    return w


#: How much more frequent than a token a word must be that an edit makes of it.
NEAR_RATIO = 25


def _clean(n_digital: int, n_scanned: int) -> bool:
    """Whether there is enough born-digital text to go by."""
    return n_digital >= 0.02 * max(1, n_scanned)


def _trusted(a: int, b: int, clean: bool) -> bool:
    return a >= 2 or (not clean and a + b >= 3)


class Vocabulary:
    """Known words with their counts, as a trie of their folded spellings; ranges of a sorted list stand for its nodes."""

    def __init__(self, counts: dict[str, tuple[int, int]]):
        self.counts = counts  # word: (in born-digital, in scanned documents)
        wide = isinstance(counts, WideCounts)
        self.clean = _clean(*(counts.sums if wide else (sum(a for a, _ in counts.values()), sum(b for _, b in counts.values()))))
        # what needs no second look as it stands
        self.plain = frozenset(x for w in counts if self.trusted(w) for x in (w, w.capitalize(), w.upper()))
        self.keys = counts.keys_in_order if wide else sorted(w for w in counts if "-" not in w and self.trusted(w))
        self.judge = Memo(self._judge, 300_000)
        self.nearest = Memo(self.near, 300_000)

    def trusted(self, w: str) -> bool:
        """Whether a word stands in born-digital text, or, where there is too little of that, is frequent."""
        a, b = self.counts.get(w, (0, 0))
        return _trusted(a, b, self.clean)

    def candidates(self, read: str, confusions: int = 3, edits: int = 0) -> list[tuple[str, int]]:
        """Every vocabulary word that ``read`` may stand for, with the number of confusions and edits.

        A Levenshtein automaton that also knows confusions runs along the trie: its states are places in ``read`` with the
        costs so far and letters of a confused pair still to come; the trie's nodes are ranges of the sorted words. Branches
        without a state are left at once, so all candidates within the bounds are found and little else is visited.
        """
        n, keys, out = len(read), self.keys, []
        todo = [(0, len(keys), 0, {(0, 0, 0, ""): None})]
        while todo:
            lo, hi, depth, states = todo.pop()
            if len(keys[lo]) == depth:
                ends = [c + 2 * e + 2 * (n - p) for p, c, e, rest in states if not rest and e + n - p <= edits]
                if ends:
                    out.append((keys[lo], min(ends)))
                lo += 1
            while lo < hi:
                ch = keys[lo][depth]
                end = bisect_left(keys, keys[lo][:depth] + chr(ord(ch) + 1), lo, hi)
                new: dict = {}
                spread = list(states)
                while spread:
                    p, c, e, rest = spread.pop()
                    if rest:
                        if rest == ch:
                            new[p, c, e, ""] = None
                        continue
                    if p < n and read[p] == ch:
                        new[p + 1, c, e, ""] = None
                    if c < confusions:
                        for g in _SINGLE.get(ch, ()):
                            if read.startswith(g, p):
                                new[p + len(g), c + 1, e, ""] = None
                        for pair, groups in _PAIRS_BY_FIRST.get(ch, ()):
                            for g in groups:
                                if read.startswith(g, p):
                                    new[p + len(g), c + 1, e, pair[1]] = None
                    if e < edits:
                        new[p, c, e + 1, ""] = None  # a lost letter
                        if p < n:
                            new[p + 1, c, e + 1, ""] = None  # a wrong letter
                            spread.append((p + 1, c, e + 1, ""))  # an added letter
                if new:
                    todo.append((lo, end, depth + 1, new))
                lo = end
        return out

    def prefix_cost(self, read: str, confusions: int = 2) -> int | None:
        """Fewest confusions by which ``read`` begins a vocabulary word, None if it begins none."""
        n, keys, best = len(read), self.keys, None
        todo = [(0, len(keys), 0, {(0, 0, ""): None})] if keys else []
        while todo:
            lo, hi, depth, states = todo.pop()
            if len(keys[lo]) == depth:
                lo += 1
            while lo < hi:
                ch = keys[lo][depth]
                end = bisect_left(keys, keys[lo][:depth] + chr(ord(ch) + 1), lo, hi)
                new: dict = {}
                for p, c, rest in states:
                    if rest:
                        if rest == ch:
                            new[p, c, ""] = None
                        continue
                    if p < n and read[p] == ch:
                        new[p + 1, c, ""] = None
                    if c < confusions:
                        for g in _SINGLE.get(ch, ()):
                            if read.startswith(g, p):
                                new[p + len(g), c + 1, ""] = None
                        for pair, groups in _PAIRS_BY_FIRST.get(ch, ()):
                            for g in groups:
                                if read.startswith(g, p):
                                    new[p + len(g), c + 1, pair[1]] = None
                done = [c for p, c, _ in new if p == n]
                if done:
                    best = min(done) if best is None else min(best, *done)
                elif new:
                    todo.append((lo, end, depth + 1, new))
                lo = end
        return best

    def near(self, token: str) -> list[str]:
        """Vocabulary words one edit (and at most one confusion) from a token that no confusion explains, the most frequent first.

        Only tokens in small letters from five letters on, as names are seldom known, and words that are NEAR_RATIO times as frequent as the token.
        """
        w = token.casefold().strip("'’")
        if len(w) < 5 or not token[0].islower() or sum(c.isalpha() for c in w) < len(w) - 1 or self.trusted(w):
            return []
        least = NEAR_RATIO * max(1, sum(self.counts.get(w, (0, 0))))
        found = [v for v, cost in self.candidates(w, 1, 1) if cost and abs(len(v) - len(w)) <= 1 and sum(self.counts[v]) >= least]
        return sorted(found, key=lambda v: (-sum(self.counts[v]), v))

    def misread(self, token: str, before: str, after: str, pairs: set) -> str | None:
        """The word a token stands for if it is misread: by confusions, else by an edit, where of several words the neighbours in this document decide."""
        fix = self.judge[token]
        if fix is None and (near := self.nearest[token]):
            seen = [v for v in near if (before, v) in pairs or (v, after) in pairs]
            fix = seen[0] if seen else near[0] if len(near) == 1 else None
        return fix

    def _judge(self, token: str) -> str | None:
        """The best correction of a token if it is misread, else None."""
        w = token.replace("ﬁl", "\ue000l").casefold().strip("'’")  # a ligature that swallowed a letter isn't the same as its letters
        if "\ue000" in w and self.trusted(w.replace("\ue000", "fi")):
            return None
        letters = sum(c.isalpha() for c in w)
        if letters < 2 or sum(c.isdigit() for c in w) > max(1, letters // 2) or self.trusted(w):
            return None
        own = sum(self.counts.get(w, (0, 0)))
        ranked = [(cost - 0.1 * math.log10(sum(self.counts[v]) + 1), v) for v, cost in self.candidates(w, 1 if len(w) < 4 else 3) if cost and sum(self.counts[v]) >= 2 * own]
        if ranked:
            return min(ranked)[1]
        if _MIXED.match(token) and letters >= 3:
            near = self.candidates(w, 2, 1)
            return min(((c, -sum(self.counts[v]), v) for v, c in near), default=(0, 0, w))[2]
        return None

    def corrected(self, token: str, before: str, after: str, pairs: Counter) -> str | None:
        """judge, with ties of several explained readings decided by the neighbours seen in this document."""
        best = self.judge[token]
        if best is None:
            return self.misread(token, before, after, pairs)
        w = token.casefold()
        options = [v for v, cost in self.candidates(w) if cost]
        if len(options) > 1:
            best = max(options, key=lambda v: (pairs[before, v] + pairs[v, after], sum(self.counts[v]), v))
        return best


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text)


def is_page_number(line: str) -> bool:
    s = line.strip()
    return bool(s) and len(s) <= 24 and bool(_PAGE_NO.match(s)) and (any(c.isdigit() for c in s) or len(s) <= 8)


def split_head(line: str) -> tuple[str, bool]:
    """A line without a page number at either end, and whether there was one."""
    s = line.strip()
    if m := _BEFORE.match(s):
        return m.group(2), True
    if m := _AFTER.match(s):
        return m.group(1), True
    return s, False


def head_key(line: str) -> str:
    """What makes two running heads equal: folded letters and signs without white space."""
    return "".join(fold(w) for w in line.split())


_ABBREVIATED = re.compile(r"\b[A-Z][\w|!¢†]{1,3}\.$")


#: Longest running head in characters; longer lines are body text.
MOST_HEAD = 200


def _may_be_head(line: str) -> bool:
    return 3 <= len(line) <= MOST_HEAD and (line[-1] not in ".,;:-‐­¬" or bool(_ABBREVIATED.search(line))) and sum(c.isalpha() for c in line) >= 3 and not line[0].islower()


class Element:
    __slots__ = ("pos", "type", "page", "content", "confidence", "own", "lines", "head_lines", "number_lines", "inner_number", "_body")

    def __init__(self, pos, type_, page, content, confidence, own):
        self.pos, self.type, self.page, self.content, self.confidence, self.own = pos, type_, page, content, confidence, own
        self.lines = (content or "").splitlines()
        self._body: str | None = None
        self.head_lines: list[int] = []
        self.number_lines: list[int] = []
        self.inner_number: list[int] = []


def mark_furniture(elements: list[Element], least: int = 2) -> None:
    """Finds running heads and page numbers of the elements of one document in reading order.

    A running head is a line, without its page number, that stands at the beginning or end of elements on at
    least ``least`` pages. As bodies repeat headings by chance, one page number beside the line, an own element of a furniture type, or three pages
    are asked for.
    """
    seen: dict[str, set] = defaultdict(set)
    strong: Counter = Counter()
    edge: dict[int, list[tuple[int, str, bool]]] = {}
    page = 0
    for n, e in enumerate(elements):
        page = e.page if e.page and e.page > 0 else page
        filled = [i for i, x in enumerate(e.lines) if x.strip()]
        picked = []
        for i in dict.fromkeys([*filled[:2], *filled[-2:]]):
            line = e.lines[i].strip()
            # the second line counts only beside a page number
            if i not in (filled[0], filled[-1]):
                beside = filled[0] if i == filled[1] else filled[-1]
                if not is_page_number(e.lines[beside]):
                    continue
            if is_page_number(line):
                if i in (filled[0], filled[-1]):
                    e.number_lines.append(i)
                continue
            rest, numbered = split_head(line)
            if _may_be_head(rest):
                key = head_key(rest)
                picked.append((i, key, numbered))
                seen[key].add(page)
                furniture = (e.type or "").strip().lower() in ("header", "footer", "page_header", "page_footer")
                strong[key] += numbered or (furniture and len(filled) == 1)
        edge[n] = picked
    for n, e in enumerate(elements):
        for i, key, numbered in edge[n]:
            if len(seen[key]) >= least and (strong[key] or len(seen[key]) > least):
                e.head_lines.append(i)
                if numbered:
                    e.inner_number.append(i)


def body_of(e: Element) -> str:
    """The element's text without furniture lines; to be asked after mark_furniture."""
    if e._body is None:
        if e.head_lines or e.number_lines:
            drop = {*e.head_lines, *e.number_lines}
            e._body = "\n".join(x for i, x in enumerate(e.lines) if i not in drop)
        else:
            e._body = e.content or ""
    return e._body


def open_end(body: str):
    """The match of a word that a hyphen breaks at the end of a text."""
    return _OPEN_END.search(body[-60:]) if body.rstrip()[-1:] in _HYPHEN_SET else None


def broken_words(body: str) -> list[re.Match]:
    """Matches of words that a hyphen breaks at the end of a line."""
    return list(_BROKEN.finditer(body)) if _HYPHEN_BREAK.search(body) else []


def joined(first: str, mark: str, second: str, vocabulary: Vocabulary) -> str | None:
    """The whole word if a line end broke it, or None for a compound that keeps its own hyphen."""
    whole, compound = (first + second).casefold(), f"{first}-{second}".casefold()
    if mark == "­" or mark == "¬":
        return first + second
    a, b = sum(vocabulary.counts.get(whole, (0, 0))), sum(vocabulary.counts.get(compound, (0, 0)))
    if b > a:
        return None
    if not a and vocabulary.trusted(first.casefold()) and vocabulary.trusted(second.casefold()) and len(first) > 3 and len(second) > 3 and not vocabulary.judge[first + second]:
        return None
    return first + second


def find_noise(elements: list[Element], vocabulary: Vocabulary, tail: bool = False) -> list[tuple[int, str, str | None]]:
    """(pos, kind, word) of the own elements of one scanned document: hyphen, misread, running_head, page_no.

    word is null, but with ``tail``, where there are more known words than the vocabulary holds, that of each misread one.
    """
    mark_furniture(elements)
    out: list[tuple[int, str, str | None]] = []
    misread: dict[int, set] = defaultdict(set)
    bodies = [body_of(e) for e in elements]
    lines = [[w.casefold() for w in tokens(b)] for b in bodies] if any(vocabulary.nearest[t] for e, b in zip(elements, bodies) if e.own for t in tokens(b) if t not in vocabulary.plain) else []
    pairs = {p for ws in lines for p in zip(ws, ws[1:])}
    for n, e in enumerate(elements):
        if not e.own or not e.content:
            continue
        if e.head_lines:
            out.append((e.pos, "running_head", None))
        if e.number_lines or e.inner_number:
            out.append((e.pos, "page_no", None))
        body = bodies[n]
        broken = False
        for m in broken_words(body):
            broken = broken or (m.group(3)[0].islower() or m.group(1).isupper()) and joined(*m.groups(), vocabulary) is not None
        end = open_end(body)
        if end:
            first = end.group(1)
            at, second = next_half(elements, n)
            if second is None:  # the other half is lost or misread
                broken = broken or not vocabulary.trusted(first.casefold())
                if len(first) > 3 and not vocabulary.trusted(first.casefold()) and vocabulary.prefix_cost(first.casefold()):
                    misread[e.pos].add(first.casefold())
            else:
                broken = broken or joined(first, end.group(2), second, vocabulary) is not None
                if fix := vocabulary.judge[first + second]:
                    # the half that doesn't stand in the word is the misread one
                    if not fix.startswith(first.casefold()):
                        misread[e.pos].add((first + second).casefold())
                    if not fix.endswith(second.casefold()) and elements[at].own:
                        misread[elements[at].pos].add((first + second).casefold())
        if broken:
            out.append((e.pos, "hyphen", None))
        words = checkable(e, body, n, elements)
        for k, t in enumerate(words):
            if t in vocabulary.plain:
                continue
            # what begins an element in small letters may be the half of a word
            if vocabulary.judge[t] if not k and t[0].islower() else vocabulary.misread(t, words[k - 1].casefold() if k else "", words[k + 1].casefold() if k + 1 < len(words) else "", pairs):
                misread[e.pos].add(t.casefold())
                if not tail:
                    break
    return out + [(pos, "misread", w) for pos, ws in misread.items() for w in (ws if tail else (None,))]


def next_half(elements: list[Element], n: int, reach: int = 8) -> tuple[int, str] | tuple[None, None]:
    """Place and first word of the next element whose body goes on in lower case."""
    for k in range(n + 1, min(n + 1 + reach, len(elements))):
        body = body_of(elements[k])
        if body.strip():
            m = _FIRST_WORD.match(body)
            if m and m.group(1)[0].islower():
                return k, m.group(1)
            if (elements[k].type or "").lower().startswith(("para", "narr", "text", "list")):
                return None, None
    return None, None


def checkable(e: Element, body: str, n: int, elements: list[Element]) -> list[str]:
    """Tokens of an element that can be misread: words joined over line ends, without halves at its ends, and without page numbers."""
    whole = _BROKEN.sub(lambda m: m.group(1) + m.group(3) if m.group(3)[0].islower() else m.group(), body) if _HYPHEN_BREAK.search(body) else body
    if open_end(whole):
        whole = whole[: _OPEN_END.search(whole).start()]
    if whole[:1].islower() and n and any(open_end(body_of(x)) for x in elements[max(0, n - 6) : n]):
        whole = _FIRST_WORD.sub("", whole, count=1)
    out = tokens(whole)
    for i in e.head_lines:
        out += tokens(split_head(e.lines[i])[0])
    return out


def clean_paragraphs(elements: list[Element], vocabulary: Vocabulary) -> list[tuple[int, int, str]]:
    """(first pos, page, text) of the repaired paragraphs of one scanned document, in reading order."""
    mark_furniture(elements)
    pairs: Counter = Counter()
    for e in elements:
        ws = [w.casefold() for w in tokens(e.content or "")]
        pairs.update(zip(ws, ws[1:]))
    out: list[list] = []
    open_half = False
    for e in elements:
        body = body_of(e).strip()
        if not body:
            continue
        body = _BROKEN.sub(lambda m: (joined(*m.groups(), vocabulary) or f"{m.group(1)}-{m.group(3)}"), body)
        body = " ".join(x.strip() for x in body.splitlines() if x.strip()) if (e.type or "").lower() not in ("table", "code") else body
        goes_on = out and body[:1].islower() and (open_half or out[-1][2].rstrip()[-1:] not in ".!?:")
        if goes_on:
            m, first = _OPEN_END.search(out[-1][2]), _FIRST_WORD.match(body)
            if m and first:
                word = joined(m.group(1), m.group(2), first.group(1), vocabulary) or f"{m.group(1)}-{first.group(1)}"
                out[-1][2] = out[-1][2][: m.start()] + word + body[first.end() :]
            else:
                out[-1][2] += " " + body
        else:
            out.append([e.pos, e.page, body, e.own])
        open_half = bool(_OPEN_END.search(body))
    done = []
    for pos, page, text, own in out:
        if not own:
            continue
        spans = list(_TOKEN.finditer(text))
        words = [m.group().casefold() for m in spans]
        parts, last = [], 0
        for k, m in enumerate(spans):
            fix = vocabulary.corrected(m.group(), words[k - 1] if k else "", words[k + 1] if k + 1 < len(words) else "", pairs)
            if fix:
                t = m.group()
                fix = fix.upper() if t.isupper() and len(t) > 1 else fix[:1].upper() + fix[1:] if t[0].isupper() else fix
                parts += [text[last : m.start()], fix]
                last = m.end()
        done.append((pos, page, "".join(parts) + text[last:]))
    return done


#: Elements of a document are handled in blocks of this many, with neighbours as context before and after.
BLOCK, BEFORE, AFTER = 256, 64, 16


def document_blocks(elements: DataFrame) -> DataFrame:
    """(doc_id, block, is_scan, rows): elements in reading order, at most BLOCK of them and their context in a row.

    So no task has to hold a whole document, however many elements one has. A document is a scan if any of its elements has a confidence, as only recognised text has. Repeated rows count once; rows without doc_id or pos
    have no place in reading order and are left out.
    """
    pos = F.col("pos").cast("bigint")
    own = F.floor(pos / BLOCK)
    whole = elements.where(F.col("doc_id").isNotNull() & F.col("pos").isNotNull())
    e = whole.select(
        "doc_id", pos.alias("pos"), F.lower(F.trim("element_type")).alias("type"), F.col("page_number").alias("page"), "content", F.col("confidence").cast("double").alias("confidence"),
        F.explode(F.array_distinct(F.array(own, F.greatest(F.floor((pos + BEFORE) / BLOCK), own), F.greatest(F.floor((pos - AFTER) / BLOCK), F.lit(0))))).alias("block"),
    )
    row = F.struct("pos", "type", "page", "content", "confidence")
    rows = e.groupBy("doc_id", "block").agg(F.sort_array(F.collect_set(row)).alias("rows")).where(F.exists("rows", lambda r: F.floor(r["pos"] / BLOCK) == F.col("block")))
    scans = whole.where("confidence is not null").select("doc_id").distinct().withColumn("is_scan", F.lit(True))
    scans = F.broadcast(scans) if scans.count() <= 200_000 else scans
    return rows.join(scans, "doc_id", "left").select("doc_id", "block", F.coalesce("is_scan", F.lit(False)).alias("is_scan"), "rows")


_FIELDS = ("pos", "type", "page", "content", "confidence")


def _rows(lists: pa.ListArray) -> list[list[tuple]]:
    """Rows of each block as tuples, by whole columns, which is much faster than row by row."""
    values = lists.flatten()
    columns = [values.field(_FIELDS.index(f)).to_pylist() for f in _FIELDS]
    flat = list(zip(*columns))
    offsets = lists.offsets.to_pylist()
    return [flat[a - offsets[0] : b - offsets[0]] for a, b in zip(offsets, offsets[1:])]


def _elements(block: int, rows: list[tuple]) -> list[Element]:
    """Elements of a block, one per pos."""
    out, last = [], None
    for r in rows:
        if r[0] != last:
            out.append(Element(*r, r[0] // BLOCK == block))
            last = r[0]
    return out


_WORDLIKE = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")


def word_counts(blocks: DataFrame) -> DataFrame:
    """(word, n_digital, n_scanned): words and intact compounds of all elements, summed in each batch before the shuffle."""

    def count(b: pa.RecordBatch) -> pa.RecordBatch:
        by = (Counter(), Counter())
        for block, scan, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _rows(b.column(2))):
            text = "\n".join(r[3] for r in rows if r[3] and r[0] // BLOCK == block)
            by[scan].update(_WORDLIKE.findall(text.casefold()))
        for c in by:
            for w in [w for w in c if "-" in w]:
                for p in w.split("-"):
                    c[p] += c[w]
        words = list(by[0].keys() | by[1].keys())
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([by[0][w] for w in words], pa.int64()), pa.array([by[1][w] for w in words], pa.int64())], names=["word", "n_digital", "n_scanned"])

    return map_batches(blocks.select("block", "is_scan", "rows"), count, "word string, n_digital bigint, n_scanned bigint").groupBy("word").agg(F.sum("n_digital").alias("n_digital"), F.sum("n_scanned").alias("n_scanned"))


#: Most words of the broadcast vocabulary; where there are more, all of them are in a sorted file on each machine too.
MOST_WORDS = 1_000_000


def build_vocabulary(counts: DataFrame, least: int = 2, most: int = MOST_WORDS) -> tuple[dict[str, tuple[int, int]], DataFrame | None]:
    """The words that occur ``least`` times or more, whatever the corpus's size: the ``most`` frequent ones for the automaton, and a table (word) of the rest that born-digital text has, None if there is none."""
    counts = stored(counts, "word-counts")
    known = counts.where((F.col("n_digital") + F.col("n_scanned") >= least) & (F.length("word") >= 2))
    tail = None
    if known.count() > most:
        ranked = known.orderBy(F.desc(F.col("n_digital") + F.col("n_scanned")), "word")
        head = stored(ranked.limit(most), "vocabulary")
        tail = known.where(F.col("n_digital") >= least).join(head.select("word"), "word", "left_anti").select("word")
        known = head
    rows = known.toPandas()
    return {w: (int(a), int(b)) for w, a, b in zip(rows["word"], rows["n_digital"], rows["n_scanned"])}, tail


def whole_vocabulary(blocks: DataFrame) -> tuple[dict[str, tuple[int, int]], tuple[str, tuple[int, int]] | None]:
    """The vocabulary to broadcast, and where it can't hold all known words, the file of all of them (write_words)."""
    counts = word_counts(blocks)
    head, tail = build_vocabulary(counts, most=MOST_WORDS)
    if tail is None:
        return head, None
    known = stored(counts.where((F.col("n_digital") + F.col("n_scanned") >= 2) & (F.length("word") >= 2)), "known-words")
    return head, write_words(known, lambda a, b, sums: _trusted(a, b, _clean(*sums)))


@lru_cache(maxsize=2)
def _vocabulary(holder) -> Vocabulary:
    return Vocabulary(WideCounts(holder.counts, *holder.file) if holder.file else holder.counts)


class _Counts:
    """Counts that hash by size and sum, so that a worker builds a vocabulary once."""

    def __init__(self, counts: dict, file: tuple | None = None):
        self.counts, self.file = counts, file
        self.id = (len(counts), sum(a + 31 * b for a, b in counts.values()), file)

    def __hash__(self):
        return hash(self.id)

    def __eq__(self, other):
        return self.id == other.id


def _per_block(blocks: DataFrame, vocabulary: dict, file: tuple | None, fn, types: list, schema: str) -> DataFrame:
    shipped = blocks.sparkSession.sparkContext.broadcast(vocabulary)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(b: pa.RecordBatch) -> pa.RecordBatch | None:
        voc = _vocabulary(_Counts(shipped.value, file))
        take, rows = [], []
        for i, (block, r) in enumerate(zip(b.column(1).to_pylist(), _rows(b.column(2)))):
            for x in fn(_elements(block, r), voc):
                take.append(i)
                rows.append(x)
        if not rows:
            return None
        cols = [pa.array([x[k] for x in rows], t) for k, t in enumerate(types)]
        return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(take, pa.int32())), *cols], names=["doc_id", *names])

    return map_batches(blocks.where("is_scan").select("doc_id", "block", "rows"), run, f"doc_id {dict(blocks.dtypes)['doc_id']}, {schema}")


def scan_noise(elements: DataFrame) -> DataFrame:
    """(doc_id, pos, kind) of the noise in elements of scanned documents, those that have any confidence.

    Null and empty contents show no noise; null page numbers take that of the element before; null types are body text;
    repeated rows count once; very long texts are read whole; other columns are ignored; an empty
    table gives an empty result. The vocabulary is the only thing broadcast, see whole_vocabulary for words beyond its bound.
    """
    blocks = stored(document_blocks(elements), "blocks")
    noise = _per_block(blocks, *whole_vocabulary(blocks), find_noise, [pa.int64(), pa.string(), pa.string()], "pos bigint, kind string, word string")
    return noise.select("doc_id", "pos", "kind").distinct()


def repaired_paragraphs(elements: DataFrame) -> DataFrame:
    """(doc_id, first_pos, page_number, text): continuous clean paragraphs of scanned documents in reading order; the cases are those of scan_noise."""
    blocks = stored(document_blocks(elements), "blocks")
    return _per_block(blocks, *whole_vocabulary(blocks), clean_paragraphs, [pa.int64(), pa.int32(), pa.string()], "first_pos bigint, page_number int, text string")

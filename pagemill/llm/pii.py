"""Personal information in free text.

Method: information-theoretic sanitisation. One pass over the texts takes out every candidate: runs of capitalised words,
which may be persons, places or companies, values with a form of their own (addresses of all kinds), and clusters of digits. The
co-occurrence of the whole corpus then tells how many bits a term (a first word, the words before or after, the label of a
number) tells about a protected value, first against sure ones (names with a title, numbers in a strict form), then against all
found so far; words that the corpus also writes small are plain words. Candidates whose terms exceed the disclosure threshold are found by
joins with the kept terms; only redaction reads the texts again.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.arrow import Memo, map_batches
from pagemill.llm.words import LOOK_ALIKES
from pagemill.plans.stages import stored

KINDS = ("email", "id_number", "phone", "street_address", "person_name")

_PLAIN = str.maketrans(
    {k: v for k, v in LOOK_ALIKES.items()}
    | {k.upper(): v.upper() for k, v in LOOK_ALIKES.items() if len(k.upper()) == 1}
    | {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}
    | dict.fromkeys(map(chr, [0xA0, 0x2007, 0x2009, 0x200A, 0x202F, 0x3000, *range(0x2000, 0x2007)]), " ")
    | dict.fromkeys("‐‑‒–−", "-")
    | dict.fromkeys("’‘", "'")
)


_FOREIGN = re.compile("[" + re.escape("".join(map(chr, _PLAIN))) + "]").sub


def plain(text: str) -> str:
    """The text with look-alike letters, wide forms, special spaces and dashes as ASCII; every character keeps its place."""
    return text if text.isascii() else _FOREIGN(lambda m: _PLAIN[ord(m.group())], text)


_AT = r"(?:\s?@\s?|\s?[\[({<]\s?at\s?[\])}>]\s?)"
_DOT = r"(?:\.|\s?[\[({<]\s?dot\s?[\])}>]\s?|\s+dot\s+)"
_EMAIL = re.compile(rf"(?<![\w.+-])[\w+-](?:[\w.+-]*[\w+-])?(?:{_AT}[\w-]+(?:{_DOT}[\w-]+)*{_DOT}[a-z]{{2,24}}\b|\s+at\s+[\w-]+(?:\s+dot\s+[\w-]+)+)", re.I)

#: What every match of _EMAIL holds: a sign, an "at" in brackets, or "at" and "dot" as words.
_AT_BRACKETS = re.compile(r"[\[({<]\s?at\s?[\])}>]", re.I).search


def _emails(text: str, folded: str) -> list[re.Match]:
    """Matches of _EMAIL, searched only around signs unless other spellings may be there."""
    if (" dot " in folded and " at " in folded) or _AT_BRACKETS(text):
        return list(_EMAIL.finditer(text))
    out: list[re.Match] = []
    at, done = text.find("@"), 0
    while at >= 0:
        if _AFTER_SIGN(text, at + 1):
            start = at - 1 if text[at - 1 : at].isspace() else at
            while start > done and (text[start - 1].isalnum() or text[start - 1] in "_.+-"):
                start -= 1
            if start < at and (m := _EMAIL.search(text, start, min(len(text), at + 330))) and m.start() <= at:
                out.append(m)
                done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


_AFTER_SIGN = re.compile(r"\s?[\w-]").match


_DIGIT_WORD = r"(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)"
_SEP = r"[ \n.\-/]"
_PHONE = re.compile(
    rf"(?<![\w+])(?:\+\s?\d{{1,3}}(?:{_SEP}?\(?[\dO]{{1,5}}\)?){{2,6}}"
    rf"|00{_SEP}?[1-9]\d{{0,2}}(?:{_SEP}[\dO]{{2,5}}){{2,5}}"
    rf"|(?:1{_SEP})?(?:\([2-9]\d\d\)\s?|[2-9]\d\d{_SEP})[\dO]{{3}}{_SEP}[\dO]{{4}}"
    rf"|1[2-9]\d\d[2-9]\d{{6}}"
    rf"|0\d(?:[ .\n]\d\d){{4}}"
    rf"|(?:\(0\d{{1,4}}\)|0\d{{2,4}})[ /\n]\d{{3,5}}[ \-\n]\d{{3,5}})(?![\w]|-\d|\.\d)(?:,?\s?(?:ext\.?|x|extension)\s?\d{{1,5}})?"
)
_DIGIT_WORDS = ("zero", "oh", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
#: Clusters that hold every number of at least six digits, whatever signs and capitals part them.
_CLUSTER = re.compile(r"[\dO](?:[\s.\-/()]{0,3}[\dOA-Z]){5,}")
_DATE = re.compile(r"\d{4}-\d\d-\d\d(?!\d)").match
_SPOKEN = re.compile(rf"\b(?:(?:double|triple)\s+)?{_DIGIT_WORD}(?:[\s,-]+(?:(?:double|triple)\s+)?{_DIGIT_WORD}){{6,}}\b", re.I)
_PHONE_LABEL = re.compile(r"\b(?:tel(?:ephone)?|phone|mobile|cell|fax|call|ring)\b[.:]?\s*$", re.I).search
_LABELLED_PHONE = re.compile(r"(?:\(?[\dO]{2,5}\)?[ .\-/]?){2,5}(?![\w])").match
_NOT_PHONE = re.compile(r"(?:parcel|docket|invoice|account|case|order|folio|inv|kr|ein|no\.?|#)[\s.:-]*$", re.I)

#: Labels of identity numbers of persons.
_ID_LABEL = (
    r"(?:ssn|s\.\s?s\.\s?n\.?|social\s+security(?:\s+(?:no\.?|number|nr\.?))?|tax\s?payer\s+(?:id|identification)(?:\s+(?:no\.?|number))?|(?:personal\s+)?tax\s+id(?:entification)?(?:\s+(?:no\.?|number))?|tin|itin"
    r"|national\s+(?:id(?:entity)?|insurance)(?:\s+(?:no\.?|number|card))?|ni\s+(?:number|no\.?)|nino|passport(?:\s+(?:no\.?|number))?|driver'?s?\s+licen[cs]e(?:\s+(?:no\.?|number))?|driving\s+licen[cs]e(?:\s+(?:no\.?|number))?"
    r"|identity\s+(?:card|number)|id\s+card|steuer-?id(?:nr\.?)?|personalausweis(?:nummer)?|reisepass(?:nummer)?|numéro\s+de\s+sécurité\s+sociale|passeport|pasaporte|nif|dni|nie)"
)
_ID = re.compile(rf"\b{_ID_LABEL}\s*[:#]?\s*(?-i:(?=(?:[\w .\-]*\d){{5}})[A-Z]{{0,2}} ?[\dO](?:[ .\-]?[\dA-Z]){{5,15}}(?![\w]))", re.I)
def _may_hold_id(near: str) -> bool:
    """What every match of _ID_LABEL holds, in small letters without white space."""
    return (
        "ssn" in near or "s.s." in near or "soci" in near or "tax" in near or "payer" in near or "tin" in near or "national" in near or "ni" in near
        or "pass" in near or "driv" in near or "identity" in near or "idcard" in near or "steuer" in near or "personala" in near or "sécurité" in near or "pasaporte" in near or "dni" in near
    )


_BARE_ID = re.compile(r"(?<![\w.\-])(?:\d{3}-\d\d-\d{4}|\d{3}\.\d\d\.\d{4}|[A-CEGHJ-PR-TW-Z]{2} ?\d\d ?\d\d ?\d\d ?[A-D]|[A-Z]\d{3}-\d{4}-\d{4}|\d{6}-\d{3}-\d\d|[A-Z]\d{9})(?![\w\-]|\.\d)")
_ID_VALUE = re.compile(rf"^{_ID_LABEL}\s*[:#]?\s*", re.I)
_NOT_ID = re.compile(r"(?:ein|parcel|docket|invoice|case|v|account|tracking|shipment)[\s.:#-]*$", re.I)

#: Street words.
_STREET = r"(?:street|st\.?|avenue|ave\.?|road|rd\.?|lane|ln\.?|drive|dr\.?|boulevard|blvd\.?|court|ct\.?|terrace|ter\.?|way|place|pl\.?|square|sq\.?|parkway|pkwy\.?|highway|hwy\.?|circle|close|crescent|row|walk)"
_CAP = r"(?:[^\W\d_a-z][\w'\-]*)"
_ADDRESS = re.compile(
    rf"\d(?<![\w.,$\-/]\d)\d{{0,4}}[a-z]?\s+(?:[NSEW]{{1,2}}\.?\s+)?(?:{_CAP}\s+){{1,3}}(?i:{_STREET})(?!\w)(?:,?\s+(?i:apt\.?|unit|suite|flat|#)\s*\w{{1,5}})?(?:,\s+{_CAP}(?:\s{_CAP})?,\s+[A-Z]{{2}}\s+\d{{5}}|\s+{_CAP}\s+[A-Z]{{2}}\b)?"
)
_UNIT_BEFORE = re.compile(r"\b(?:unit|apt\.?|suite|flat)\s+\w{1,5},\s+$", re.I)
#: Hints in lower case and the pattern to try where one stands in the text.
_OTHER_ADDRESSES = (
    (("straße", "strasse", "str.", "weg", "gasse", "allee", "platz", "ufer", "damm", "stieg"), re.compile(rf"\b{_CAP}(?:(?i:straße|strasse|str\.|weg|gasse|allee|platz|ufer|damm|stieg))\s+\d{{1,4}}\s?[a-z]?\b(?:,\s+\d{{5}}\s+{_CAP})?")),
    (("calle ", "avenida ", "avda", "plaza ", "paseo ", "carrera ", "viale ", "rua "), re.compile(rf"\b(?i:calle|avenida|avda\.?|plaza|paseo|carrera|viale|rua)\s+(?:(?:de|del|la|las|los)\s+)*{_CAP}(?:\s{_CAP})?,?\s+(?:n[.º°]*\s*)?\d{{1,4}}\b(?:,\s+\d{{1,2}}\.?[ºª°]\s?\w?)?(?:,\s+{_CAP})?")),
    ((" rue ", " avenue ", " boulevard ", " bd ", " place ", " quai ", " chemin ", " allée ", " impasse ", " route ", " cours "), re.compile(rf"\d(?<![\w.,$\-/]\d)\d{{0,3}}(?:\s?(?i:bis|ter|quater))?,?\s+(?i:rue|avenue|boulevard|bd|place|quai|chemin|allée|impasse|route|cours)\s+(?:(?:de|du|des|la|le|les)\s+|d'|l')*{_CAP}(?:[\s\-]{_CAP})?(?:,\s+(?:\d{{5}}\s+)?{_CAP})?")),
)

#: Titles before names, and words that end the name of a company or a place.
_TITLES = frozenset("mr mrs ms miss mx dr prof sir madam herr frau hr fr m mme mlle sr sra srta señor señora don doña".split())
_COMPANY = frozenset(
    "llc llp lp ltd inc corp co company gmbh ag kg sa sarl plc group trust holdings holding analytics foundation systems realty partners capital logistics bank sons county warehouse avenue street road lane drive terrace court boulevard blvd way association committee office department agency university council".split()
)
_RUN = re.compile(r"(?:[^\W\d_a-zà-öø-ÿ][\w'\-]*\.?)(?:(?:[ \t]+|[ \t]*\n[ \t]*|,[ \t]+)(?:[^\W\d_a-zà-öø-ÿ][\w'\-]*\.?))*")
_PART = re.compile(r"([^\W\d_][\w'\-]*)(\.?)")


def _context(low: str, start: int, end: int) -> tuple[str, str]:
    """The two words before and after, in the same line, of a text in lower case, with numbers as #; ^ after the end of a sentence or line, $ at the end."""
    left = "^"
    if not (start > 1 and low[start - 1] == " " and low[start - 2] in _STOPS):
        near = low[start - 40 if start > 40 else 0 : start]
        words = (near[near.rfind("\n") + 1 :] if "\n" in near else near).split()
        if words and words[-1][-1] not in _STOPS:
            left = " ".join(["#" if w[0] in _NUMERIC else w for w in words[-2:]])
    near = low[end : end + 36]
    words = (near[: near.find("\n")] if "\n" in near else near).split(None, 2)[:2]
    return left, " ".join(["#" if w[0] in _NUMERIC else w for w in words]) or "$"


_STOPS, _NUMERIC = frozenset(".!?;|"), frozenset("0123456789$")


def _lower(text: str) -> str:
    """Lower case of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _parts_of(run: str, joined: bool) -> tuple[tuple[int, int, bool, str, str, str, int | None], ...]:
    """Mentions in a run of capitalised words: (start, end, title, first, last, shape, cut), see candidates for cut; joined says that an & stands beside the run."""
    parts = [(p.group(1), bool(p.group(2)), p.start(), p.end()) for p in _PART.finditer(run)]
    lower = [_lower(p[0]) for p in parts]
    if run.isalpha():
        return () if joined or lower[0] in _NEVER else ((0, len(run), False, lower[0], lower[0], "one", None),)
    company = [i for i, w in enumerate(lower) if w in _COMPANY]
    segments = [(0, len(parts))]
    if company or joined:
        # what stands before a company word in the same run belongs to it; a run may go on after it
        head = 0
        for i in range(len(parts) - 1):
            gap = run[parts[i][3] : parts[i + 1][2]]
            if ("\n" in gap or "," in gap or (parts[i][1] and len(parts[i][0]) > 2)) and company and i + 1 <= company[0]:
                head = i + 1
        # of three or more words before a company word, the first may be a person named just before it
        if company and head == 0 and company[0] >= 3:
            head = company[0] - 1
        segments = [(0, head), (company[-1] + 1, len(parts))] if company else []
    out = []

    def mention(start: int, end: int, title: bool, first: str, last: str, shape: str) -> None:
        short = run[start:end].rstrip(".").rpartition(" ")[0].rstrip() if shape != "one" else ""
        out.append((start, end, title, first, last, shape, start + len(short) if short and (shape != "initial" or " " in short) else None))

    for a, b in segments:
        i = a
        while i < b:
            title = lower[i] in _TITLES and i + 1 < b and "\n" not in run[parts[i][3] : parts[i + 1][2]]
            j = i + 1 if title else i
            k = j + 1
            # take following words of the same line or broken line, up to two more, without full stops between
            while k < b and k - j < 3 and not (parts[k - 1][1] and len(parts[k - 1][0]) > 1) and not {"\n", ","} & set(run[parts[k - 1][3] : parts[k][2]]):
                k += 1
            if k == j + 1 and k < b and run[parts[j][3] : parts[k][2]].strip() == "," and not parts[j][1] and len(parts[j][0]) > 2:
                mention(parts[i][2], parts[k][3] - parts[k][1], title, lower[k], lower[j], "reversed")  # Last, First
                i = k + 1
                continue
            n = k - j
            end_of = lambda p: p[3] - (p[1] and len(p[0]) > 1)
            if len(parts[j][0]) == 1 and parts[j][1] and n >= 2:
                mention(parts[i][2], end_of(parts[k - 1]), title, lower[j], lower[k - 1], "initial")
            elif n < 3 or len(parts[j + 1][0]) == 1:
                mention(parts[i][2], end_of(parts[k - 1]), title, lower[j], lower[k - 1], ("one", "two", "three")[n - 1])
            else:
                for x in range(j, k - 1):
                    mention(parts[x][2], end_of(parts[x + 1]), title and x == j, lower[x], lower[x + 1], "two")
            i = k
    return tuple(out)


@lru_cache(maxsize=1)
def _runs() -> Memo:
    return Memo(lambda key: _parts_of(*key))


def mentions(text: str, low: str) -> Iterator[tuple[int, int, bool, str, str, str, int | None, str, str]]:
    """Candidate mentions in plain text, with low its lower case: (start, end, title, first, last, shape, cut, left, right).

    Runs of capitalised words are cut at company words, which take the whole run with them; a run gives its one or two (with middle initials
    three) words, a pair "Last, First", or each pair inside a long run of capitals.
    """
    memo = _runs()
    joins = "&" in text
    for m in _RUN.finditer(text):
        at, end = m.span()
        joined = joins and (text[end : end + 12].lstrip()[:1] == "&" or text[max(0, at - 3) : at].rstrip()[-1:] == "&")
        for a, b, title, first, last, shape, cut in memo[m.group(), joined]:
            yield at + a, at + b, title, first, last, shape, None if cut is None else at + cut, *_context(low, at + a, at + b)


#: Function words, months and days, which are written with a capital but never names.
_PLAIN_WORDS = frozenset(
    "the a an this that these those in of on at by for from to with as is are was were it its no not when where while each every both neither nor or and but if then than our their his her your my we they he she you some any all one two first second january february march april may june july august september october november december monday tuesday wednesday thursday friday saturday sunday der die das le la les el los las und et y am im per".split()
)


#: Single words that are no candidates.
_NEVER = _PLAIN_WORDS | _COMPANY | _TITLES


class Spans:
    """Spans (start, end, kind) without overlaps, in order; what is added first wins."""

    def __init__(self):
        self.starts: list[int] = []
        self.items: list[tuple[int, int, str]] = []

    def free(self, a: int, b: int) -> bool:
        i = bisect_left(self.starts, b)
        return a < b and (i == 0 or self.items[i - 1][1] <= a)

    def add(self, a: int, b: int, kind: str) -> bool:
        if not self.free(a, b):
            return False
        insort(self.items, (a, b, kind))
        insort(self.starts, a)
        return True


def typed_values(text: str, low: str | None = None, folded: str | None = None) -> tuple[Spans, list[tuple[int, int, str, str]]]:
    """Values that have a form of their own in plain text, and numbers with their label (start, end, kind or "", label).

    Kinds earlier in KINDS win where values overlap. Only tests that every match passes stand before the costly patterns. Numbers whose form says phone or identity number without a
    label are in both; numbers of another form have the kind "".
    """
    out = Spans()
    low = low or _lower(text)
    folded = folded or " ".join(low.split())
    for m in _emails(text, folded):
        out.add(*m.span(), "email")
    clusters = [m.span() for m in _CLUSTER.finditer(text)]
    # a date alone has neither form
    formed = [(a, b) for a, b in clusters if b - a != 10 or text[a - 1 : a] == "+" or not _DATE(text, a)]
    last = 0
    for a, b in clusters:
        near = "".join(low[a - 80 if a > 80 else 0 : b].split())
        if _may_hold_id(near):
            for m in _matches(_ID, text, max(last, a - 80), b, 40):
                last = m.end()
                out.add(m.start() + _ID_VALUE.match(m.group()).end(), m.end(), "id_number")
    numbers: list[tuple[int, int, str, str]] = []
    last = 0
    for a, b in formed:
        for m in _matches(_BARE_ID, text, max(last, a - 4), b, 8):
            last = m.end()
            if not _NOT_ID.search(text[max(0, m.start() - 14) : m.start()]) and out.add(*m.span(), "id_number"):
                numbers.append((*m.span(), "id_number", _label(text, m.start())))
    last = 0
    for a, b in formed:
        before = last
        for m in _matches(_PHONE, text, max(last, a - 4), b, 24):
            last = m.end()
            if 7 <= sum(c.isdigit() or c == "O" for c in m.group()) <= 17 and not _NOT_PHONE.search(text[max(0, m.start() - 12) : m.start()]) and out.add(*m.span(), "phone"):
                numbers.append((*m.span(), "phone", _label(text, m.start())))
        if last == before and out.free(a, b):
            start = a - (text[a - 1 : a] == "(")
            if _PHONE_LABEL(text[max(0, start - 40) : start]) and (m := _LABELLED_PHONE(text, start)):
                v = m.group().rstrip(" .-/")
                if 7 <= sum(c.isdigit() for c in v) <= 15:
                    out.add(start, start + len(v), "phone")
                    continue
            if not _DATE(text, a):
                numbers.append((a, b, "", _label(text, a)))
    if _may_be_spoken(low):
        for m in _SPOKEN.finditer(text):
            out.add(*m.span(), "phone")
    for m in _ADDRESS.finditer(text):
        unit = _UNIT_BEFORE.search(text[max(0, m.start() - 16) : m.start()])
        out.add(m.start() - (len(unit.group()) if unit else 0), m.end(), "street_address")
    for hints, pattern in _OTHER_ADDRESSES:
        for h in hints:
            if h in folded:
                for m in pattern.finditer(text):
                    out.add(*m.span(), "street_address")
                break
    return out, numbers


def _may_be_spoken(low: str) -> bool:
    """Whether there are seven digit words."""
    n = low.count
    if "two" in low or "three" in low or "four" in low or "five" in low or "six" in low or "seven" in low or "eight" in low or "nine" in low or "zero" in low:
        return sum(map(n, _DIGIT_WORDS)) >= 7
    return n("one") + n("oh") >= 7


def _matches(pattern: re.Pattern, text: str, start: int, end: int, room: int) -> list[re.Match]:
    """Matches that begin between start and end and may go on beyond for the room."""
    return [m for m in pattern.finditer(text, start, min(len(text), end + room)) if m.start() < end]


def _label(text: str, start: int) -> str:
    """The two words before a number, in small letters, numbers as #; ^ where the last is none."""
    words = text[max(0, start - 40) : start].lower().split()[-2:]
    if not words or not any(c.isalpha() for c in words[-1]) or words[-1][0].isdigit():
        return "^"
    return " ".join("#" if w[0] in "0123456789$" else w for w in words)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span (start, end, kind) replaced by [KIND]; all else is kept as it was."""
    parts, last = [], 0
    for a, b, kind in sorted(spans):
        if a >= last:
            parts += [text[last:a], f"[{kind.upper()}]"]
            last = b
    return "".join(parts) + text[last:]


_MAIL_NAME = re.compile(rf"(?<![\w.+-])([A-Za-z]{{3,}})[.+][\w.+-]*{_AT}", re.I)
_ROLE = re.compile(r"[.+](?:office|info|team|desk|mail|admin|service|support)\b", re.I)
#: Contexts that tell nothing.
_NOTHING = ("$", ".", ",")
_CANDIDATE = "src_table string, row_key string, text_id bigint, kind string, title boolean, first string, last string, shape string, left string, right string, start int, end int, cut int, n bigint, gid bigint, gids array<bigint>"
_TYPES = (pa.string(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()))


def _group_id(group: tuple) -> int:
    """A number of 64 bits for a mention's words and contexts, the same in every process."""
    return int.from_bytes(blake2b("\x1f".join(map(str, group)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def candidates(texts: DataFrame, places: bool = True) -> DataFrame:
    """Everything in texts (src_table, row_key, text) that may be personal, in one pass, one row each.

    kind: a typed value's kind, with shape ``form`` for numbers that only their form gives (first is the word before), ``number`` for other
    numbers, ``mention`` for runs of capitalised words outside typed values, ``inside`` for those inside and, summed per batch, single words without any
    context, ``email_name`` for the given name that an address begins with; ``word`` rows count words written small (title false) and with a capital, per batch. cut is
    where a mention ends without its last word, null where no name is left. Without ``places`` text_id, start and end are left out, mentions that are alike
    come as one row per batch with their number n and a group id, and a ``text`` row lists the groups of each text.
    """

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        words: Counter = Counter()
        opening: Counter = Counter()
        inside: Counter = Counter()
        outside: Counter = Counter()
        listed: list[tuple[int, list[tuple]]] = []
        at: list[int | None] = []
        rows: list[tuple] = []
        for i, text in enumerate(b.column(3).to_pylist()):
            if not text:
                continue
            t = plain(text)
            low, tokens = _lower(t), t.split()
            words.update(tokens)
            typed, numbers = typed_values(t, low, " ".join(tokens).lower())
            formed = {x[:2] for x in numbers if x[2]}
            rows += [(kind, False, None, None, "labelled", None, None, a, e, None, 1, None, None) for a, e, kind in typed.items if (a, e) not in formed]
            rows += [(kind or "number", False, label, None, "form", None, None, a, e, None, 1, None, None) for a, e, kind, label in numbers]
            free = typed.free if typed.items else None
            own: list[tuple] = []
            for start, end, title, first, last, shape, cut, left, right in mentions(t, low):
                if shape == "one" and left == "^" and right in _NOTHING:
                    opening[first] += 1
                elif places:
                    kind = "mention" if free is None or free(start, end) else "inside"
                    rows.append((kind, title, first, last, shape, left, right, start, end, cut, 1, None, None))
                else:
                    group = (title, first, last, shape, left, right, cut is None)
                    if free is None or free(start, end):
                        own.append(group)
                    else:
                        inside[group] += 1
            if own:
                outside.update(own)
                listed.append((len(rows), own))
                rows.append(())
            if "@" in t or _AT_BRACKETS(t):
                rows += [("email_name", False, m.group(1).lower(), m.group(1).lower(), "email", "^", "$", None, None, None, 1, None, None) for m in _MAIL_NAME.finditer(t) if not _ROLE.search(m.group())]
            at += [i] * (len(rows) - len(at))
        ids = {g: _group_id(g) for g in outside}
        for i, own in listed:
            rows[i] = ("text", False, None, None, None, None, None, None, None, None, 1, None, [ids[g] for g in own])
        for kind, groups in (("mention", outside), ("inside", inside)):
            rows += [(kind, *g[:6], None, None, None if g[6] else 0, c, ids.get(g), None) for g, c in groups.items()]
        rows += [("inside", False, w, w, "one", "^", "$", None, None, None, c, None, None) for w, c in opening.items()]
        rows += [("word", w[0].isupper(), w.lower(), None, "word", None, None, None, None, None, c, None, None) for w, c in words.items() if len(w) > 1 and w.isalpha() and w[1:].islower()]
        at += [None] * (len(rows) - len(at))
        index = pa.array(at, pa.int32())
        cols = [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)] if rows else [pa.array([], t) for t in _TYPES]
        out = dict(zip(every, [*(b.column(k).take(index) for k in range(3)), *cols]))
        return pa.RecordBatch.from_arrays([out[c] for c in names], names=names)

    every = [c.split()[0] for c in _CANDIDATE.split(", ")]
    names = [c for c in every if c not in (("gid", "gids") if places else ("text_id", "start", "end"))]
    identity = F.xxhash64("text") if places else F.lit(0).cast("bigint")
    schema = ", ".join(c for c in _CANDIDATE.split(", ") if c.split()[0] in names)
    return map_batches(texts.select("src_table", "row_key", identity.alias("text_id"), "text"), run, schema)


#: Rows up to which a table of terms is broadcast.
FEW = 200_000


def _listed(df: DataFrame) -> DataFrame:
    """df, marked for broadcast where its checked number of rows allows it."""
    return F.broadcast(df) if df.count() <= FEW else df


class Terms:
    """What the corpus tells: stored tables of any size, broadcast only where their checked number of rows allows it.

    words (word, is_first, is_opener, is_plain): given names, words that open sentences, plain words; contexts (slot, term); labels (label, told, vetoed)
    of numbers.
    """

    def __init__(self, words: DataFrame, contexts: DataFrame, labels: DataFrame):
        self.words, self.labels = _listed(words), labels
        few = contexts.count() <= FEW
        slots = {s: contexts.where(F.col("slot") == s).select("term") for s in ("left", "right", "both")}
        self.slots = {s: F.broadcast(t) if few else t for s, t in slots.items()}

    def persons(self, mentions: DataFrame) -> DataFrame:
        """mentions with the columns ``person``, whether a person is named, and ``bare``, whether the last word opens the next sentence and goes."""
        known = lambda c: F.coalesce(F.col(c), F.lit(False))
        m = mentions.withColumn("both", F.concat_ws(" _ ", "left", "right"))
        for side in ("first", "last"):
            m = m.join(self.words.select(F.col("word").alias(side), *(F.col(k).alias(f"{side}_{k}") for k in ("is_first", "is_opener", "is_plain"))), side, "left")
        for slot, terms in self.slots.items():
            m = m.join(terms.select(F.col("term").alias(slot), F.lit(True).alias(f"in_{slot}")), slot, "left")
        shape, one = F.col("shape"), F.col("shape") == "one"
        told = known("in_left") | known("in_right") | known("in_both")
        person = (
            F.when(one & ~F.col("title") & known("first_is_opener"), False).when(F.col("title") | (shape == "initial"), True)
            .when(shape.isin("two", "three", "reversed") & known("first_is_first"), True).when(one & (F.col("left") == "^") & ~known("in_right"), False)
            .when((shape == "many") | known("first_is_plain") | known("last_is_plain"), False).otherwise(told)
        )
        bare = known("last_is_opener") & (F.col("first") != F.col("last")) & (shape != "reversed")
        return m.withColumn("bare", bare).withColumn("person", person & ~(bare & ~F.col("title") & (known("first_is_opener") | ((shape == "initial") & F.col("cut").isNull()))))


def plain_words(counts: DataFrame, share: float = 0.3) -> DataFrame:
    """(word) of the ``word`` rows of candidates that are written small in at least that share of their places, and the fixed ones."""
    c = counts.groupBy(F.col("first").alias("word")).agg(F.sum(F.when(F.col("title"), 0).otherwise(F.col("n"))).alias("small"), F.sum("n").alias("n"))
    fixed = counts.sparkSession.createDataFrame([(w,) for w in sorted(_PLAIN_WORDS)], "word string")
    return c.where((F.col("small") >= 3) & (F.col("small") >= share * F.col("n"))).select("word").unionByName(fixed).distinct()


def number_labels(numbers: DataFrame, told: float = 0.9, vetoed: float = 0.1, least: int = 5) -> DataFrame:
    """(label, told, vetoed) of the words before numbers: the kind that nearly all numbers after it have by their form, and kinds that nearly none has.

    numbers: candidates that only their form or nothing gives. A label needs ``least`` numbers of the kind to tell, four times that to veto.
    """
    kinds = ("phone", "id_number")
    g = numbers.where("first <> '^'").groupBy(F.col("first").alias("label")).agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col("kind") == k).alias(k) for k in kinds))
    kind = F.coalesce(*(F.when((F.col(k) >= least) & (F.col(k) >= told * F.col("n")), k) for k in kinds))
    no = F.array_compact(F.array(*(F.when((F.col("n") >= 4 * least) & (F.col(k) <= vetoed * F.col("n")), k) for k in kinds)))
    return g.select("label", kind.alias("told"), no.alias("vetoed")).where((F.col("told").isNotNull()) | (F.size("vetoed") > 0))


def _contexts(spans: DataFrame) -> DataFrame:
    """(slot, term, n, n_seed) of spans with a column seed."""
    two = F.col("shape").isin("two", "three", "reversed", "email")
    left, right = F.col("left") != "^", ~F.col("right").isin("$", ".", ",")
    term = lambda c, slot, t: F.when(c, F.struct(F.lit(slot).alias("slot"), t.alias("term")))
    terms = F.array(
        term(left, "left", F.col("left")), term(right, "right", F.col("right")),
        term(left & (F.col("right") != "$"), "both", F.concat_ws(" _ ", "left", "right")), term(two, "first", F.col("first")),
    )
    t = spans.select(F.explode(terms).alias("t"), "n", "seed").where("t is not null")
    return t.groupBy("t.slot", "t.term").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("seed"), F.col("n")).otherwise(0)).alias("n_seed"))


def learn_terms(found: DataFrame, bits: float = 4.0, posterior: float = 0.6, rounds: int = 3) -> Terms:
    """Terms that disclose persons and kinds of numbers, from all candidates of the whole corpus.

    In the first round the protected mentions are those with a title: a term is kept when their share among its mentions is at
    least 2**bits times the share in the corpus. In later rounds they are all mentions that kept terms
    disclose, and a term must make a person likelier than ``posterior``. Words that open at least one in 2,000 sentences as single capitalised words
    are openers. A term needs two protected mentions, at every size of the corpus.
    """
    spans = found.where(F.col("kind").isin("mention", "inside", "email_name")).groupBy("title", "first", "last", "shape", "left", "right").agg(F.sum("n").alias("n"))
    spans = stored(spans, "mentions")
    words = plain_words(found.where("kind = 'word'")).withColumn("is_plain", F.lit(True))
    opening = spans.where("shape = 'one' and left = '^' and not title").groupBy(F.col("first").alias("word")).agg(F.sum("n").alias("n"))
    opened = opening.agg(F.sum("n")).first()[0] or 0
    openers = opening.where(F.col("n") >= max(5, math.ceil(opened * 5e-4))).select("word", F.lit(True).alias("is_opener"))
    words = stored(words.join(openers, "word", "full"), "plain-words")
    opener_words = F.broadcast(words.where("is_opener").select(F.col("word").alias("opener")))  # at most 2,000
    labels = _listed(stored(number_labels(found.where("shape = 'form'")), "labels"))
    seed = F.col("title") | (F.col("shape") == "email")
    marked = spans.withColumn("seed", seed)
    for k in range(rounds):
        row = marked.agg(F.sum("n"), F.sum(F.when(F.col("seed"), F.col("n")).otherwise(0))).first()
        total, seeds = row[0] or 0, row[1] or 0
        share = F.col("n_seed") / F.col("n")
        strong = share >= min(0.5, seeds / max(total, 1) * 2**bits) if k == 0 else share >= posterior
        kept = stored(_contexts(marked).where((F.col("n_seed") >= 2) & strong).select("slot", "term"), "terms")
        given = kept.where("slot = 'first'").select(F.col("term").alias("word"), F.lit(True).alias("is_first"))
        # words that only begin the next sentence tell nothing about the mention
        after = F.regexp_replace(F.element_at(F.split("term", " "), 1), r"^[,.;:()]+|[,.;:()]+$", "")
        contexts = kept.where("slot <> 'first'").withColumn("opener", F.when(F.col("slot") == "right", after)).join(opener_words, "opener", "left_anti").drop("opener")
        terms = Terms(stored(words.join(given, "word", "full").fillna(False), "words"), contexts, labels)
        if k + 1 < rounds:
            m = terms.persons(spans.withColumn("cut", F.lit(0)))
            plain_one = F.coalesce("first_is_plain", F.lit(False)) | F.coalesce("last_is_plain", F.lit(False))
            seen = F.coalesce("in_left", "in_right", "in_both", F.when(F.col("shape").isin("two", "three", "reversed"), F.col("first_is_first")), F.lit(False))
            marked = stored(m.select(*spans.columns, (F.col("title") | F.col("shape").isin("initial", "email") | (seen & ~plain_one)).alias("seed")), "mentions")
    return terms


def decided(found: DataFrame, terms: Terms) -> DataFrame:
    """(src_table, row_key, text_id, kind, start, end) of the candidates that disclose something; without places in found, (src_table, row_key, kind)."""
    places = "start" in found.columns
    out = ["src_table", "row_key", *(["text_id"] if places else []), "kind", *(["start", "end"] if places else [])]
    typed = found.where(F.col("kind").isin(*KINDS, "number")).join(terms.labels.withColumnRenamed("label", "first"), "first", "left")
    vetoed = (F.col("shape") == "form") & F.coalesce(F.array_contains("vetoed", F.col("kind")), F.lit(False))
    numbers = typed.withColumn("kind", F.when(F.col("kind") == "number", F.col("told")).when(~vetoed, F.col("kind"))).where("kind is not null").select(*out)
    persons = terms.persons(found.where("kind = 'mention'")).where("person")
    if places:
        m = persons.withColumn("end", F.when(F.col("bare"), F.coalesce("cut", "end")).otherwise(F.col("end")))
    else:
        groups = stored(persons.select("gid").distinct(), "person-groups")
        m = found.where("kind = 'text'").select("src_table", "row_key", F.explode("gids").alias("gid")).join(_listed(groups), "gid", "left_semi")
    return numbers.unionByName(m.withColumn("kind", F.lit("person_name")).select(*out))


def personal_candidates(texts: DataFrame, places: bool = True) -> tuple[DataFrame, Terms]:
    """The stored candidates of texts (src_table, row_key, text) and the terms that they give."""
    found = stored(candidates(texts, places), "candidates")
    return found, learn_terms(found)


def find_personal(texts: DataFrame) -> DataFrame:
    """(src_table, row_key, kind, n) per row and kind with any value.

    texts: (src_table, row_key, text). Null and empty texts hold nothing; a null row_key keeps its rows; very long texts are
    searched whole; repeated rows add to n; an empty table gives an empty result.
    """
    return decided(*personal_candidates(texts, places=False)).groupBy("src_table", "row_key", "kind").agg(F.count(F.lit(1)).alias("n"))


def redact_texts(texts: DataFrame) -> DataFrame:
    """(src_table, row_key, text) with placeholders, each distinct row once; null texts stay null; the cases are those of find_personal."""
    spans = decided(*personal_candidates(texts)).select("src_table", "row_key", "text_id", F.struct("start", "end", "kind").alias("s"))
    keys = ["src_table", "row_key", "text_id"]
    by_row = spans.groupBy(*keys).agg(F.collect_set("s").alias("spans")).select(*(F.col(k).alias(f"_{k}") for k in keys), "spans")
    own = texts.select("src_table", "row_key", F.xxhash64("text").alias("text_id"), "text").distinct()
    same = F.col("text_id") == F.col("_text_id")
    for k in keys[:2]:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        done = [redact(t, [(x["start"], x["end"], x["kind"]) for x in s]) if t and s else t for t, s in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(done, pa.string())], names=["src_table", "row_key", "text"])

    return map_batches(own.join(by_row, same, "left").select("src_table", "row_key", "text", "spans"), run, "src_table string, row_key string, text string")

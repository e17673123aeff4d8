"""Abusive, hateful and sexual passages.

Method: maximum-scoring segment search. Every token gets its log-odds between documents labelled
toxic and clean, with a Dirichlet prior; a linear scan finds all maximal segments of positive total score; extreme-value
theory (Karlin and Altschul) turns the score of a segment into the number of such segments
expected by chance in a text of that length, which is what documents are ranked and judged by.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.arrow import Memo, map_batches
from pagemill.plans.stages import stored

#: Words that a reader takes for abusive, degrading or sexually explicit; the informative part of the prior.
SEED_WORDS = (
    "fuck fucking fucker motherfucker fuckwit fucked shit bullshit shithead asshole arsehole ass bastard bitch whore slut cunt dick dickhead cock pussy tits boobs "
    "wanker twat prick idiot moron imbecile cretin loser scumbag scum vermin filthy subhuman stupid dumbass retard goddamn damn hell pathetic worthless useless brainless disgusting ugly "
    "nude nudes naked horny porn xxx blowjob moaning moaned orgasm cum thighs breasts "
    "arschloch scheiße scheisse fotze hure schlampe wichser vollidiot idiotin fresse verpiss untermensch ungeziefer "
    "merde putain connard connasse salope enculé abruti gueule crétin ordure vermine "
    "mierda puta cabrón gilipollas imbécil pendejo coño basura follar ratas "
    "блядь сука хуй пизда мудак дебил тварь ублюдок"
).split()

_TOKEN = re.compile(r"[\w*@$!|'’\-]+").findall
_SPACED_HINT = re.compile(r" [^\W\d_] [^\W\d_] [^\W\d_](?!\w)").search
_SPACED = re.compile(r"(?<![^\s\"'(])(?:[^\W_] ){2,}[^\W_](?![^\s,.!?;:\"')])")
_EDGES = "_'’-!|"
#: Scripts without spaces between words: their runs are sentences, not words, and are read as pairs of characters.
_UNSPACED = re.compile(r"[\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff]")
_SCRIPTS = re.compile(r"[\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff]+|[^\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff]+").findall
#: Digits and signs that stand for letters.
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})
_RUN = re.compile(r"(.)\1{2,}")
_PLAIN = re.compile(r"[^\W\d_]+")


def _base(token: str) -> str:
    """Lower case without accents."""
    if token.isascii():
        return token
    return "".join(c for c in unicodedata.normalize("NFKD", token) if not unicodedata.combining(c))


def raw_tokens(text: str | None) -> list[str]:
    """Lower-case tokens; letters that are spaced out are joined; scripts without spaces give pairs of characters."""
    t = text or ""
    if not t.isascii():
        t = unicodedata.normalize("NFKC", t)
    t = t.lower()
    if _SPACED_HINT(t):
        t = _SPACED.sub(lambda m: m.group().replace(" ", ""), t)
    found = _TOKEN(t)
    if t.isascii() or not _UNSPACED.search(t):
        return found
    return [p for raw in found for p in _pairs(raw)]


def _pairs(raw: str) -> list[str]:
    """A token, cut where its script changes to one without spaces between words, whose runs give their overlapping pairs of characters."""
    if not _UNSPACED.search(raw):
        return [raw]
    out = []
    for part in _SCRIPTS(raw):
        out += [part[i : i + 2] for i in range(max(1, len(part) - 1))] if _UNSPACED.match(part) else [part]
    return out


def readings(raw: str) -> list[tuple[str, ...]]:
    """What a token may stand for, the plainest reading first: as written, parts of a compound, digits and signs as letters, without hyphens, with shortened runs."""
    raw = raw.strip(_EDGES)
    if _PLAIN.fullmatch(raw):
        b = _base(raw)
        run = _RUN.search(b)
        return [(b,), (_RUN.sub(r"\1", b),), (_RUN.sub(r"\1\1", b),)] if run else [(b,)]
    b = _base(raw.replace("’", "'"))
    out = [tuple(p for p in re.split(r"[-'*@$!|]+", b) if p)]
    joined = re.sub(r"[-']", "", b)
    for v in (joined, joined.translate(_LEET), joined.replace("1", "l").translate(_LEET)):
        for w in (v, _RUN.sub(r"\1", v), _RUN.sub(r"\1\1", v)):
            if (w,) not in out:
                out.append((w,))
    return out


def _terms_of(raw: str) -> tuple[str, ...]:
    return tuple({p for r in readings(raw) for p in r if (len(p) > 1 or p == "u") and not p.isdigit()})


def training_terms(text: str | None) -> set[str]:
    """Terms of a labelled text: whatever its tokens may stand for, without numbers."""
    memo = _term_memo()
    return {t for raw in set(raw_tokens(text)) for t in memo[raw]}


@lru_cache(maxsize=1)
def _term_memo() -> Memo:
    return Memo(_terms_of)


class Lexicon:
    """Scores of terms and the calibration; small: only terms with evidence are kept."""

    def __init__(self, scores: dict[str, float], neutral: float, lam: float, k: float):
        self.scores, self.neutral, self.lam, self.k = scores, neutral, lam, k
        self.by_length: dict[int, list[str]] = {}
        for t, s in scores.items():
            if s > 0:
                self.by_length.setdefault(len(t), []).append(t)
        self.raw_score = Memo(self._raw_score)

    def _raw_score(self, raw: str) -> float:
        """Highest score among the readings; a masked token stands for the terms of its shape."""
        best = None
        for r in readings(raw):
            s = sum((self.scores.get(p, self.neutral) for p in r), 0.0) if len(r) <= 3 else self.neutral
            best = s if best is None or s > best else best
        if "*" in raw and sum(c.isalpha() for c in raw) >= 2:
            shape = re.compile("".join("." if c == "*" else re.escape(c) for c in _base(raw).translate(_LEET)))
            for t in self.by_length.get(len(raw), ()):
                if shape.fullmatch(t):
                    best = max(best, self.scores[t])
        return self.neutral if best is None else best

    def segments(self, text: str | None) -> tuple[int, list[tuple[float, int, int]]]:
        """Number of tokens and (score, first token, end) of every maximal segment (Ruzzo and Tompa)."""
        s = list(map(self.raw_score.__getitem__, raw_tokens(text)))
        return len(s), maximal_segments(s) if s and max(s) > 0 else []

    def expected(self, score: float, n: int) -> float:
        """Segments of at least that score that a clean text of n tokens is expected to have."""
        return self.k * max(n, 1) * math.exp(-self.lam * score)


def maximal_segments(scores: Iterable[float]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments in one linear scan."""
    stack: list[list] = []  # start, end, sum before, sum at the end
    total = 0.0
    for i, s in enumerate(scores):
        before = total
        total += s
        if s <= 0:
            continue
        seg = [i, i + 1, before, total]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= seg[2]:
                j -= 1
            if j < 0 or stack[j][3] >= seg[3]:
                stack.append(seg)
                break
            seg = [stack[j][0], seg[1], stack[j][2], seg[3]]
            del stack[j:]
    return [(b - a, i, e) for i, e, a, b in stack]


def log_odds(counts: dict[str, tuple[int, int]], n_toxic: int, n_clean: int, prior: float = 0.5, seed_weight: float = 3.0, confidence: float = 1.5, most: float = 4.0) -> dict[str, float]:
    """Scores of terms from the numbers of toxic and clean documents that hold them.

    Log-odds with a Dirichlet prior of ``prior`` documents in all on each side, in proportion to the class sizes, plus ``seed_weight``
    toxic documents for seed words; towards zero by ``confidence`` standard deviations, so that rare terms count little.
    """
    share = n_toxic / max(n_toxic + n_clean, 1)
    seeds = {_base(w) for w in SEED_WORDS}
    out = {}
    for t in counts.keys() | seeds:
        a, b = counts.get(t, (0, 0))
        a1 = a + prior * share * 2 + (seed_weight if t in seeds else 0)
        b1 = b + prior * (1 - share) * 2
        delta = math.log(a1 / (n_toxic + 1)) - math.log(b1 / (n_clean + 1)) if n_toxic and n_clean else (2.0 if t in seeds else 0.0)
        sd = math.sqrt(1 / a1 + 1 / b1)
        s = max(0.0, delta - confidence * sd) if delta > 0 else min(0.0, delta + confidence * sd)
        if s:
            out[t] = min(most, s)
    return out


def karlin_lambda(scores: dict[float, float]) -> float:
    """The positive root of sum p(s) exp(lambda s) = 1 for token scores of clean text; their mean must be negative."""
    f = lambda x: sum(p * math.exp(x * s) for s, p in scores.items()) - 1.0
    if not any(s > 0 for s in scores):
        return 1.0
    hi = 0.01
    while f(hi) < 0 and hi < 50:
        hi *= 1.5
    lo = 0.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return hi


def _labelled(documents: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(text, toxic) of a sample of at most ``bound`` labelled documents, the same in every run; contradictory labels count as toxic."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    return documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", F.col("_toxic").alias("toxic"))


def train_lexicon(documents: DataFrame, labels: DataFrame, bound: int = 20_000, neutral: float = -0.6) -> Lexicon:
    """Fits scores and calibration on at most ``bound`` labelled documents (the documented bound of this classifier).

    Term counts are summed in Spark; what reaches the driver are the distinct terms of the sample and a histogram of
    token scores. Without labels of both classes the seed words alone score.
    """
    sample = stored(_labelled(documents, labels, bound), "labelled")

    def count(b: pa.RecordBatch) -> pa.RecordBatch:
        toxic, clean = Counter(), Counter()
        for text, y in zip(*(c.to_pylist() for c in b.columns)):
            (toxic if y else clean).update(training_terms(text))
            (toxic if y else clean)["\n"] += 1  # the documents themselves
        terms = list(toxic.keys() | clean.keys())
        return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()), pa.array([clean[t] for t in terms], pa.int64())], names=["term", "n_toxic", "n_clean"])

    totals = map_batches(sample, count, "term string, n_toxic bigint, n_clean bigint").groupBy("term").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
    rows = totals.where("n_toxic > 0 or term = '\n'").toPandas()
    counts = {t: (int(a), int(b)) for t, a, b in zip(rows["term"], rows["n_toxic"], rows["n_clean"])}
    n_toxic, n_clean = counts.pop("\n", (0, 0))
    lexicon = Lexicon({t: s for t, s in log_odds(counts, n_toxic, n_clean).items() if s > 0 or counts.get(t, (0, 0))[1] > 0}, neutral, 1.0, 0.1)
    shipped = documents.sparkSession.sparkContext.broadcast(lexicon.scores)

    def histogram(b: pa.RecordBatch) -> pa.RecordBatch:
        lex = _lexicon(_Scores(shipped.value), neutral, 1.0, 0.1)
        h: Counter = Counter()
        for text in b.column(0).to_pylist():
            scores = list(map(lex.raw_score.__getitem__, raw_tokens(text)))
            h.update(("token", round(x, 1)) for x in scores)
            h.update(("segment", round(x, 1)) for x, _, _ in maximal_segments(scores))
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in h], pa.string()), pa.array([x for _, x in h], pa.float64()), pa.array(list(h.values()), pa.int64())], names=["what", "score", "n"])

    rows = map_batches(sample.where("toxic = 0").select("text"), histogram, "what string, score double, n bigint").groupBy("what", "score").agg(F.sum("n").alias("n")).collect()
    tokens, found = ({r["score"]: r["n"] for r in rows if r["what"] == w} for w in ("token", "segment"))
    n = sum(tokens.values())
    if n:
        lexicon.lam = min(5.0, karlin_lambda({x: c / n for x, c in tokens.items()}))
        lexicon.k = karlin_k(found, n, lexicon.lam)
    return lexicon


def karlin_k(segments: dict[float, int], n: int, lam: float, share: float = 0.1) -> float:
    """K of the expectation K n exp(-lambda s), from the segments of clean text with n tokens: by the number that reach the score which ``share`` of all reach.

    Within 0.01 and 1, where it lies for every scoring scheme in use; 0.1 without segments.
    """
    total, upto = sum(segments.values()), 0
    for score in sorted(segments, reverse=True):
        upto += segments[score]
        if upto >= share * total:
            return min(1.0, max(0.01, upto * math.exp(lam * score) / max(n, 1)))
    return 0.1


class _Scores(dict):
    """Scores that hash by identity of their content's size and sum, so that a worker builds a lexicon once."""

    def __hash__(self):
        return hash((len(self), round(sum(self.values()), 6)))


@lru_cache(maxsize=4)
def _lexicon(scores: _Scores, neutral: float, lam: float, k: float) -> Lexicon:
    return Lexicon(scores, neutral, lam, k)


def score_documents(documents: DataFrame, lexicon: Lexicon, most_expected: float = 0.0003) -> DataFrame:
    """(doc_id, source, n_tokens, n_passages, score, is_toxic) of every row.

    score is -log10 of the number of passages as bad as the worst one that a clean text of that length
    is expected to have, 0 at least; n_passages counts the passages that are expected less than ``most_expected`` times;
    is_toxic says that there is one, which by chance is so in one of some 3,000 clean documents. Null and empty texts score 0; very long texts are scored whole in one scan;
    repeated rows give equal rows; other columns are ignored; an empty table gives an empty result. No shuffle.
    """
    kinds = dict(documents.dtypes)
    scores, neutral, lam, k = lexicon.scores, lexicon.neutral, lexicon.lam, lexicon.k
    shipped = documents.sparkSession.sparkContext.broadcast(scores)

    def score(b: pa.RecordBatch) -> pa.RecordBatch:
        lex = _lexicon(_Scores(shipped.value), neutral, lam, k)
        sizes, counts, best = [], [], []
        for text in b.column(2).to_pylist():
            n, segments = lex.segments(text)
            e = [lex.expected(s, n) for s, _, _ in segments]
            sizes.append(n)
            counts.append(sum(x < most_expected for x in e))
            best.append(max(0.0, -math.log10(max(min(e), 1e-300))) if e else 0.0)
        cols = [b.column(0), b.column(1), pa.array(sizes, pa.int32()), pa.array(counts, pa.int32()), pa.array(best, pa.float64()), pa.array([c > 0 for c in counts])]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "source", "n_tokens", "n_passages", "score", "is_toxic"])

    return map_batches(documents.select("doc_id", "source", "text"), score, f"doc_id {kinds['doc_id']}, source {kinds['source']}, n_tokens int, n_passages int, score double, is_toxic boolean")


def rates_by_source(scored: DataFrame) -> DataFrame:
    """Per source (a null source is one too), the number of documents, of toxic ones and their rate."""
    return scored.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if("is_toxic").alias("n_toxic"), F.avg(F.col("is_toxic").cast("double")).alias("toxic_rate"))

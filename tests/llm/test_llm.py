import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.llm import history, leakage, ocr, pii, splitting, tokenizer, toxicity
from pagemill.llm.words import word_code

# --- tokenizer


@pytest.fixture(scope="module")
def bpe():
    return tokenizer.BacktrackingBpe(tokenizer.parse_ranks(open(tokenizer.vocabulary_path(), "rb").read()))


def test_tokenizer_equals_public_library(bpe):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rnd = random.Random(0)
    texts = ["".join(rnd.choice("abcdeABs \t\x1c\x0b1.\n'éтя漢🙂‍") for _ in range(rnd.randint(0, 50))) for _ in range(800)] + ["<|endoftext|> it's we'll", "a" * 5000, " " * 999, "﷽ﬁ"]
    for text, e in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert bpe.encode(text) == e.ids, text


def test_encode_corpus(spark):
    df = spark.createDataFrame([(1, "hello world", "x"), (2, "", "x"), (3, None, "x"), (None, "a", "x"), (1, "hello world", "x")], "doc_id bigint, text string, ids string")
    got = {r.doc_id: r.ids for r in tokenizer.encode_corpus(tokenizer.one_row_per_id(df)).collect()}
    assert got[1] == [31373, 995] and got[2] == [] and got[3] == [] and got[None] == [64] and len(got) == 4
    assert tokenizer.encode_corpus(df.limit(0)).count() == 0


# --- splitting


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.", "c,", "\n\n", "\n", "  ", " ", "|", "-"]), max_size=300), st.integers(2, 40), st.integers(0, 10), st.sampled_from(["prose", "table", "list", "code"]))
def test_split_round_trip(parts, limit, overlap, kind):
    overlap = min(overlap, limit - 1)
    text = " ".join(parts)
    pieces = splitting.split_text(text, kind, limit, overlap)
    words = [w for p in pieces for w in p["content"].split()[p["n_overlap"] :]]
    assert words == text.split()
    assert all(p["n_tokens"] <= limit and p["n_tokens"] == len(p["content"].split()) for p in pieces)
    for a, b in zip(pieces, pieces[1:]):
        n = b["n_overlap"]
        assert n == 0 or b["content"].split()[:n] == text.split()[: len(text.split())][0:0] + (a["content"].split()[-n:] if n <= a["n_tokens"] else b["content"].split()[:n])


def test_split_at_natural_boundary():
    text = "\n\n".join(" ".join(["w"] * 40) for _ in range(4))
    assert [p["n_tokens"] for p in splitting.split_text(text, "prose", 100)] == [80, 80]


def test_split_oversized(spark):
    long = " ".join(["w"] * 513)
    rows = [(1, 0, long, "text", 1), (1, 0, long, "text", 1), (1, 1, " ".join(["w"] * 512), None, 600), (1, 2, None, None, None), (1, 3, "", None, 0), (1, 4, "x​" * 2000, None, 9), (1, 5, "x  " * 600, None, 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, no int, content string, kind string, n_tokens int")
    out = splitting.split_oversized(df, ["doc_id", "no"], "content", "kind").collect()
    assert {r.no for r in out} == {0, 5} and all(r.n_tokens <= 512 for r in out) and sum(r.n_tokens - r.n_overlap for r in out if r.no == 0) == 513
    assert splitting.split_oversized(df.limit(0), ["doc_id", "no"], "content", "kind").count() == 0


# --- leakage


def test_masks_find_every_twenty_words_with_two_changes():
    for changed in itertools.combinations(range(20), 2):
        assert any(not any(m[i] == "1" and p + i in changed for i in range(len(m))) for m in leakage.MASKS for p in range(21 - len(m))), changed


def test_leaks(spark):
    passage = " ".join(f"word{i}" for i in range(40))
    bench = spark.createDataFrame([(1, "s", "Read this and answer now.\n" + passage + "\nQuestion: why?"), (2, "s", "Read this and answer now.\n" + " ".join(f"other{i}" for i in range(30))), (3, "s", None)], "item_id bigint, suite string, text string")
    w = passage.split()
    noisy = [x if i % 11 else "changed" for i, x in enumerate(w[:30], 1)]
    docs = [(1, "x " + passage.upper() + " y"), (2, "a " + " ".join(noisy)), (3, " ".join(w[:19])), (4, "Read this and answer now."), (5, None), (6, ""), (7, "“" + "” — ".join(w[5:30])), (1, "x " + passage.upper() + " y")]
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id bigint, text string, item_id int")
    assert {(r.doc_id, r.item_id) for r in leakage.leaked_items(df, bench).collect()} == {(1, 1), (2, 1), (7, 1)}
    assert leakage.leaked_items(df.limit(0), bench).count() == 0 and leakage.leaked_items(df, bench.limit(0)).count() == 0


def test_overlaps_follow_the_document():
    words = [f"w{i}" for i in range(12)]
    index = leakage.Index([(1, " ".join(words))])
    codes = lambda ws: np.frombuffer(b"".join(map(word_code, ws)), np.uint64)
    assert leakage.overlap_length(index, 0, codes(words), [0], 0.1) == 12
    assert leakage.overlap_length(index, 0, codes(words[:6] + ["x"] + words[6:]), [0, 1], 0.1) == 12
    assert leakage.overlap_length(index, 0, codes(words[6:] + words[:6]), [-6, 6], 0.1) == 6


def test_benchmark_blocks_by_bytes(spark):
    bench = spark.createDataFrame([(i, "s", " ".join(f"ä{i}.{k}" for k in range(30))) for i in range(6)], "item_id bigint, suite string, text string")
    docs = spark.createDataFrame([(i, " ".join(f"ä{i}.{k}" for k in range(30))) for i in range(6)], "doc_id bigint, text string")
    assert len(leakage.passage_blocks(leakage.passages(bench), 500)) > 1
    want = {(i, i) for i in range(6)}
    assert {(r.doc_id, r.item_id) for r in leakage.leaked_items(docs, bench, most_benchmark_bytes=500).collect()} == want
    assert {(r.doc_id, r.item_id) for r in leakage.leaked_items(docs, bench).collect()} == want


# --- history


def variants(rnd, words, share):
    return [w if rnd.random() > share else f"{w}x" for w in words]


def admitted(spark, path, df, key, content, batch, at_once=1000, **kw):
    """(key, accepted_key) of the refused, batches being admitted in groups."""
    store = history.HashHistory(spark, str(path), **kw)
    for label, part in history.successive(df, batch, at_once):
        store.admit(df.where(part), key, content, batch, label)
    return {(r.key, r.accepted_key) for r in store.refused().collect()}


@pytest.fixture(scope="module")
def intake():
    rnd = random.Random(3)
    base = [[f"w{rnd.randrange(4000)}" for _ in range(90)] for _ in range(25)]
    rows = [(k, k % 5, " ".join(variants(rnd, rnd.choice(base), rnd.choice([0, 0, 0.04, 0.08])))) for k in range(120)]
    rows += [(900, 1, None), (901, 1, ""), (902, 1, " . "), (903, None, rows[3][2].upper()), (5, 0, rows[5][2]), (None, 1, rows[3][2])]
    accepted, want = [], set()
    for k, b, t in sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[1] is None, r[1] or 0, r[0])):
        hits = [a for a, u in accepted if history.is_repeat((t or "").lower().replace(".", "").split(), u)]
        want |= {(k, a) for a in hits}
        if not hits and (t or "").strip(" ."):
            accepted.append((k, (t or "").lower().split()))
    return rows, want


@pytest.mark.parametrize("at_once", [1000, 2, 1])
def test_history_against_brute_force(spark, tmp_path, intake, at_once):
    rows, want = intake
    df = spark.createDataFrame(rows, "chunk_id bigint, batch_no int, content string").withColumn("key", F.lit(1)).withColumn("o", F.lit("x"))
    assert admitted(spark, tmp_path / "h", df, "chunk_id", "content", "batch_no", at_once) == want
    assert admitted(spark, tmp_path / "e", df.limit(0), "chunk_id", "content", "batch_no") == set()


def test_history_survives_a_failed_admission(spark, tmp_path, intake):
    rows, want = intake
    df = spark.createDataFrame(rows, "chunk_id bigint, batch_no int, content string")
    store = history.HashHistory(spark, str(tmp_path / "h"))
    for b in (0, 1):
        store.admit(df.where(f"batch_no = {b}"), "chunk_id", "content", "batch_no", f"week {b}")
    store._append(spark.createDataFrame([(1, 1, 1, 1)], "h bigint, o bigint, n_words int, n_runs int"), "runs", 3)  # a generation without a mark
    again = store.admit(df.where("batch_no = 1"), "chunk_id", "content", "batch_no", "week 1")
    assert len(store.generations()) == 2 and again.count() == len({r for r in want if r[0] % 5 == 1 and r[0] < 900})
    rest = history.HashHistory(spark, str(tmp_path / "h"), n_buckets=99)  # reopened: the buckets stay as they are
    assert rest.n_buckets == store.n_buckets
    for b in (2, 3, 4):
        rest.admit(df.where(f"batch_no = {b}"), "chunk_id", "content", "batch_no", f"week {b}")
    rest.admit(df.where("batch_no is null"), "chunk_id", "content", "batch_no", "undated")
    assert {(r.key, r.accepted_key) for r in rest.refused().collect()} == want


def test_history_is_not_shuffled(spark, tmp_path, intake):
    df = spark.createDataFrame(intake[0], "chunk_id bigint, batch_no int, content string")
    store = history.HashHistory(spark, str(tmp_path / "h"))
    store.admit(df.where("batch_no < 2"), "chunk_id", "content", "batch_no", "a")
    plan = store._met(2, [1])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount" in plan


@pytest.mark.parametrize("bucket", [2048, 16])
def test_hot_group_of_near_copies(spark, tmp_path, monkeypatch, bucket):
    monkeypatch.setattr(history, "BUCKET", bucket)
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = [(k, 0, " ".join(base[:30] + [f"n{k}"] + base[30:])) for k in range(150)] + [(500 + k, 0, " ".join(base[:25] + [f"z{k}.{i}" for i in range(40)])) for k in range(80)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k bigint, b int, content string")
    assert admitted(spark, tmp_path / "h", df, "k", "content", "b") == {(k, 0) for k in range(1, 150)}


def test_hot_group_finds_what_a_small_group_would(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "BUCKET", 32)
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    copy = lambda: [f"{w}x{rnd.randrange(10**9)}" if i in changed else w for changed in [set(rnd.sample(range(200), 30))] for i, w in enumerate(base)]
    texts = {0: base} | {k: copy() for k in range(1, 300)}

    def runs_of(words):
        codes = np.frombuffer(b"".join(map(word_code, words)), np.uint64).astype(np.uint32).astype(np.uint64)
        return set(history.paragraph_hashes(codes, np.array([0]), np.array([len(codes)]))[1].tolist())

    runs = {k: runs_of(t) for k, t in texts.items()}
    want = {k for k in texts if k and len(runs[0] & runs[k]) >= history.COVERAGE * max(len(runs[0]), len(runs[k]))}
    df = spark.createDataFrame([(k, 0, " ".join(t)) for k, t in texts.items()], "k bigint, b int, content string")
    got = admitted(spark, tmp_path / "h", df, "k", "content", "b")
    assert len(want) > 200 and {(k, 0) for k in want} <= got and {a for _, a in got} == {0}


@pytest.mark.parametrize("bucket", [2048, 8])
def test_refused_leader_of_a_hot_group(spark, tmp_path, monkeypatch, bucket):
    """A and L, L and X, X and Y repeat each other, and nothing else: L is refused, so X stays and refuses Y."""
    monkeypatch.setattr(history, "BUCKET", bucket)
    lead = [f"w{i}" for i in range(200)]
    first = [f"p{i}" if i >= 24 and i % 7 == 0 else w for i, w in enumerate(lead)]
    texts = [first, lead] + [[f"u{k}y{i}" for i in range(24)] + lead[24:] for k in range(2, 60)]
    df = spark.createDataFrame([(k, 0, " ".join(t)) for k, t in enumerate(texts)], "k bigint, b int, content string")
    assert admitted(spark, tmp_path / "h", df, "k", "content", "b") == {(1, 0)} | {(k, 2) for k in range(3, 60)}


def test_chain_through_two_groups(spark, tmp_path):
    a = [f"a{i}" for i in range(100)]
    steps = [a]
    for n in range(1, 4):  # every text changes another fifth less one word of the one before
        steps.append([f"c{n}x{i}" if (i + 7 * n) % 100 in range(20 * n, 20 * n + 19) else w for i, w in enumerate(steps[-1])])
    df = spark.createDataFrame([(k, 0, " ".join(t)) for k, t in enumerate(steps)], "k bigint, b int, content string")
    accepted, want = [], set()
    for k, t in enumerate(steps):
        hits = [j for j in accepted if history.is_repeat(t, steps[j])]
        want |= {(k, j) for j in hits}
        accepted += [] if hits else [k]
    assert admitted(spark, tmp_path / "h", df, "k", "content", "b") == want and want


def test_keys_out_of_range_are_an_error(spark, tmp_path):
    df = spark.createDataFrame([(-1, 0, "some words")], "k bigint, b int, content string")
    with pytest.raises(Exception, match="keys must lie"):
        history.HashHistory(spark, str(tmp_path / "h")).admit(df, "k", "content", "b")


def test_common_words_is_the_longest_common_subsequence():
    rnd = random.Random(1)
    for _ in range(200):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randrange(12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert history.common_words(a, b) == t[-1][-1]
        longer = max(len(a), len(b))
        assert history.is_repeat(a, b) == (longer > 0 and t[-1][-1] >= 0.8 * longer - 1e-9)


@pytest.mark.parametrize("at_once", [100, 1])
def test_files(spark, tmp_path, at_once):
    h = "ab" * 32
    rows = [(1, 1, 1, h), (2, 1, 1, "SHA256:" + h.upper()), (3, 1, 0, h + " "), (4, 1, 1, None), (5, 1, 1, ""), (6, 1, 1, "0" * 64), (7, 1, 1, "0" * 64), (3, 2, 9, "cd" * 32), (1, 1, 1, h), (8, 1, None, "cd" * 32), (9, 1, None, "cd" * 32)]
    first = history.first_versions(spark.createDataFrame(rows, "doc_id bigint, version_no int, batch_no int, sha256 string"))
    store = history.HashHistory(spark, str(tmp_path / "f"))
    for label, part in history.successive(first, "batch_no", at_once):
        store.admit_files(first.where(part), label)
    assert {(r.key, r.accepted_key) for r in store.refused().collect()} == {(1, 3), (2, 3), (9, 8)}


# --- scanned pages


def test_candidates_are_complete():
    words = {w: (5, 5) for w in ("statement", "the", "then", "held", "heading", "each", "medium", "modern", "until", "filing", "between", "will", "well")}
    v = ocr.Vocabulary(words)
    for read, true in (("5tatement", "statement"), ("fhe", "the"), ("hcld", "held"), ("headmg", "heading"), ("eacli", "each"), ("meclium", "medium"), ("modem", "modern"), ("iintil", "until"), ("8etween", "between"), ("vvill", "will"), ("ﬁlling", "filing")):
        assert v.judge[read] == true, read
    assert v.judge["KR-0473"] is None and v.judge["Velford"] is None and v.judge["then"] is None
    assert {w for w, _ in v.candidates("wxll", 0, 1)} == {"will", "well"}


def test_real_edits_need_a_single_word_or_neighbours():
    v = ocr.Vocabulary({w: (60, 5) for w in ("payment", "lease", "contract", "tenant", "house", "agreement", "horse", "the")})
    for read, true in (("paymemt", "payment"), ("leose", "lease"), ("contraxt", "contract"), ("tenan7", "tenant"), ("houze", "house"), ("payrnent", "payment"), ("c0ntract", "contract"), ("agreernent", "agreement")):
        assert v.misread(read, "", "", set()) == true, read
    assert v.misread("Leose", "", "", set()) is None and v.misread("hoxse", "", "", set()) is None
    assert v.misread("hoxse", "the", "", {("the", "horse")}) == "horse" and v.misread("house", "", "", set()) is None
    assert v.prefix_cost("contr") == 0 and v.prefix_cost("c0ntr") == 1 and v.prefix_cost("xyz") is None


def test_words_beyond_the_vocabulary_are_known(spark):
    counts = spark.createDataFrame([("the", 9, 0), ("cat", 5, 0), ("dog", 4, 0), ("odd", 0, 4), ("once", 1, 0)], "word string, n_digital bigint, n_scanned bigint")
    head, tail = ocr.build_vocabulary(counts, most=2)
    assert set(head) == {"the", "cat"} and {r.word for r in tail.collect()} == {"dog"}
    assert ocr.build_vocabulary(counts)[1] is None


def test_words_beyond_the_vocabulary_are_corrected_to(spark, monkeypatch):
    digital = [(9, p, "paragraph", "the the the cat sees a duplicate statement of long-term payment", 1, None) for p in range(3)]
    scans = [(1, 0, "paragraph", "The 5tatement has a paymemt", 1, 0.9), (1, 1, "paragraph", "a dupl-\nicate c0t and the odd pay-", 1, 0.9), (1, 2, "paragraph", "rnent sees the cat", 2, 0.9)]
    df = spark.createDataFrame(digital + scans, "doc_id bigint, pos int, element_type string, content string, page_number int, confidence double")
    run = lambda: (sorted(map(tuple, ocr.scan_noise(df).collect())), sorted(map(tuple, ocr.repaired_paragraphs(df).collect())))
    whole = run()
    monkeypatch.setattr(ocr, "MOST_WORDS", 1)
    monkeypatch.setattr(ocr.build_vocabulary, "__defaults__", (2, 1))
    assert run() == whole and (1, 0, "misread") in whole[0] and "statement" in str(whole[1]).lower()


def scan(rows):
    return [ocr.Element(p, t, g, c, 0.9, True) for p, t, g, c in rows]


def test_noise_and_repair(spark):
    digital = [(9, p, "paragraph", "the boundary of the duplicate statement is long-term and non-exclusive for each page of it", 1, None, 7) for p in range(3)]
    page = [(1, 0, "header", "Acme Trust / Copy", 1), (1, 1, "paragraph", "The 5tatement keeps the dupl-\nPage 1 of 2", 1), (1, 2, "header", "Acme Trust / Copy   Page 2 of 2", 2), (1, 3, "paragraph", "icate boundary of each long-\nterm page.", 2), (1, 4, "paragraph", None, None), (1, 4, "paragraph", None, None)]
    df = spark.createDataFrame(digital + [(*r, 0.9, 7) for r in page], "doc_id bigint, pos int, element_type string, content string, page_number int, confidence double, kind int")
    got = {(r.pos, r.kind) for r in ocr.scan_noise(df).collect()}
    assert got == {(0, "running_head"), (1, "misread"), (1, "hyphen"), (1, "page_no"), (2, "running_head"), (2, "page_no")}
    text = [r.text for r in ocr.repaired_paragraphs(df).orderBy("first_pos").collect()]
    assert text == ["The statement keeps the duplicate boundary of each long-term page."] or text == ["The Statement keeps the duplicate boundary of each long-term page."]
    assert ocr.scan_noise(df.limit(0)).count() == 0


# --- toxicity


def test_maximal_segments_against_brute_force():
    rnd = random.Random(2)
    for _ in range(100):
        s = [rnd.choice([-2, -1, 1, 2]) for _ in range(rnd.randrange(1, 14))]
        best = max((sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)))
        segs = toxicity.maximal_segments(s)
        assert (max(x for x, _, _ in segs) if segs else 0) == max(best, 0)
        assert all(sum(s[i:j]) == x for x, i, j in segs)


def test_disguises():
    lex = toxicity.Lexicon({"fuckwit": 3.0, "naked": 2.0, "vermin": 3.0}, -0.5, 1.0, 0.1)
    for t in ("f u c k w i t", "fuck-wit", "FUUUUUCKWIT", "f**kwit", "fuckw1t"):
        assert max((s for s, _, _ in lex.segments("you " + t + " there")[1]), default=0) == 3.0, t
    assert lex.segments("nak3d")[1][0][0] == 2.0 and lex.segments("v**min")[1][0][0] == 3.0 and lex.segments(None) == (0, [])


def test_toxicity_on_held_out_rows(spark):
    rnd = random.Random(4)
    clean = lambda: " ".join(rnd.choice("the lease of a unit was signed and filed by board in records with notice on".split()) for _ in range(60))
    bad = lambda: rnd.choice(["you useless imbecile shut your mouth", "those people are vermin and should burn", "she stripped naked on the desk"])
    rows = [(i, f"{clean()} {bad()} {clean()}" if i % 5 == 0 else clean(), "s" if i % 2 else None) for i in range(800)] + [(1000, None, "s"), (1001, "", "s"), (1001, "", "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)] + [(5, None), (None, 1)], "doc_id bigint, toxic int")
    s = toxicity.score_documents(docs, toxicity.train_lexicon(docs, labels))
    held = {r.doc_id: r.is_toxic for r in s.collect() if r.doc_id >= 600}
    assert sum(held[i] == (i % 5 == 0) for i in range(600, 800)) >= 190 and not held[1000] and not held[1001]
    assert sum(r.n_docs for r in toxicity.rates_by_source(s).collect()) == 803
    assert toxicity.score_documents(docs.limit(0), toxicity.train_lexicon(docs, labels.limit(0))).count() == 0


def test_scripts_without_spaces_give_pairs():
    assert toxicity.raw_tokens("Du 你好世界 percentは") == ["du", "你好", "好世", "世界", "percent", "は"]
    assert toxicity.training_terms("你好世") == {"你好", "好世"} and toxicity.raw_tokens("") == []


def test_karlin_k_by_simulation():
    rnd = random.Random(6)
    values, p = [-1.0, 1.0], [0.75, 0.25]
    lam = toxicity.karlin_lambda(dict(zip(values, p)))
    found, n = {}, 200_000
    for x, _, _ in toxicity.maximal_segments(rnd.choices(values, p, k=n)):
        found[x] = found.get(x, 0) + 1
    k = toxicity.karlin_k(found, n, lam)
    many = sum(c for x, c in found.items() if x >= 4)
    assert abs(lam - np.log(3)) < 1e-6 and 0.5 < k * n * np.exp(-lam * 4) / many < 2


# --- personal information


def kinds(text):
    return sorted(k for _, _, k in pii.typed_values(pii.plain(text))[0].items)


def test_typed_values():
    text = "Mail a.b+c@x.example or bill (at) acme dot test, call (731) 555-0110, ring 226 555 O144, SSN: 000866917, 666–41–4890, parcel 036-087-0032, EIN 00-9391659, XXX-XX-232; 1014 Brannakov Blvd; Calle Nueva 47, 4.º B; Bergstraße 19"
    assert kinds(text) == ["email"] * 2 + ["id_number"] * 2 + ["phone"] * 2 + ["street_address"] * 3


@pytest.mark.parametrize("text, kind", [("jane.roe {at} acme.example", "email"), ("jane.roe <at> acme.example", "email"), ("jane at acme\ndot example", "email"), ("Tel\n5551 2345", "phone"), ("Social\nSecurity No: 123456789", "id_number"), ("tax  id 12 345 678 901", "id_number"), ("Passeport 12AB34567", "id_number"), ("12 place Carnot", "street_address"), ("3 bd Voltaire", "street_address")])
def test_spellings(text, kind):
    assert kinds(text) == [kind]


_BLANK = st.sampled_from([" ", "\n", "  ", "\t"])


@settings(max_examples=150, deadline=None)
@given(st.sampled_from(["a.b@c.example", "a @ c.example", "a (at) c.example", "x[at]y [dot] com", "a at b dot com", "SSN 123456789", "national insurance AB123456C", "s. s. n. 123 45 6789", "nif 12345678Z", "driver licence F000-391-378", "+49 30 23125 311", "(731) 555-0110", "1-212-555-0199", "01 99 00 99 21", "666-41-4890", "QQ 12 34 56 C", "2014-09-09", "Call +1 631 555 0109", "steuer-id 12 345 678 901"]), _BLANK, st.sampled_from(["", "the lease of 12,000 for ", "2014-09-09. ", "(", "parcel "]), st.sampled_from(["", " to", ".", " 2020-01-01", ", 12"]))
def test_hints_lose_nothing(value, blank, before, after):
    """What the costly patterns match in the whole text is found behind the tests that spare them."""
    text = pii.plain(before + value.replace(" ", blank) + after)
    found = pii.typed_values(text)[0]
    covered = lambda m: any(a < m.end() and m.start() < e for a, e, _ in found.items)
    assert all(covered(m) for m in pii._EMAIL.finditer(text))
    assert all(covered(m) for m in pii._ID.finditer(text))
    assert all(covered(m) or pii._NOT_ID.search(text[max(0, m.start() - 14) : m.start()]) for m in pii._BARE_ID.finditer(text))
    digits = lambda m: sum(c.isdigit() or c == "O" for c in m.group())
    assert all(covered(m) or not 7 <= digits(m) <= 17 or pii._NOT_PHONE.search(text[max(0, m.start() - 12) : m.start()]) for m in pii._PHONE.finditer(text))


def test_spans_stay_sorted_and_apart():
    rnd = random.Random(2)
    s, kept = pii.Spans(), []
    for _ in range(300):
        a = rnd.randrange(1000)
        b = a + rnd.randrange(1, 12)
        free = not any(a < y and x < b for x, y in kept)
        assert s.add(a, b, "k") == free
        kept += [(a, b)] if free else []
    assert [x[:2] for x in s.items] == sorted(kept)


def test_names_and_redaction(spark):
    names = ["Velbeck", "Kestholm", "Tavmund", "Jarvik", "Norford"]
    rows = [("chunks", str(i), f"The file was checked. Prepared by {'Mr ' if i % 2 else ''}{'Elif ' if i % 3 else ''}{names[i % 5]} on Monday. The unit near {names[i % 5]} belongs to {names[(i + 1) % 5]} Trust.") for i in range(60)]
    rows += [("records", "n", None), ("records", "e", ""), ("records", None, "Mail x.y@z.example"), ("chunks", "0", rows[0][2])]
    df = spark.createDataFrame(rows, "src_table string, row_key string, text string").selectExpr("*", "1 as kind", "2 as start")
    got = {(r.row_key, r.kind) for r in pii.find_personal(df).collect()}
    assert got == {(str(i), "person_name") for i in range(60)} | {(None, "email")}
    out = {r.row_key: r.text for r in pii.redact_texts(df).collect()}
    assert {(k, kind) for k, t in out.items() for kind in pii.KINDS if f"[{kind.upper()}]" in (t or "")} == got
    assert out["n"] is None and out["e"] == "" and out[None] == "Mail [EMAIL]"
    assert "near Tavmund belongs to Jarvik Trust" in out["2"] and "Prepared by [PERSON_NAME]" in out["2"]
    assert pii.find_personal(df.limit(0)).count() == 0 and pii.redact_texts(df.limit(0)).count() == 0


def test_labels_of_numbers_are_learned(spark):
    rows = [("chunks", f"a{i}", f"reach durchwahl (731) 555-01{i:02d} now") for i in range(12)] + [("chunks", "b", "reach durchwahl 7315550 now")]
    rows += [("chunks", f"c{i}", f"waybill ref 44 {i + 10} 55 66 77 88 99") for i in range(30)] + [("chunks", "d", "waybill ref (731) 555-0199 x")]
    got = {(r.row_key, r.kind) for r in pii.find_personal(spark.createDataFrame(rows, "src_table string, row_key string, text string")).collect()}
    assert got == {(f"a{i}", "phone") for i in range(12)} | {("b", "phone")}

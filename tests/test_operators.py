import math
import random
import uuid

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.operators import benchmark, chunking, elements, scores, sync
from pagemill.operators.evaluation import LayoutEvaluator
from pagemill.sources.documents_api import checked_url, retry_delay

EL = "doc_id bigint, pos int, element_type string, content string, page_number int, category_depth int, confidence double"


def els(spark, rows):
    return spark.createDataFrame([(d, p, t, c, pg, None, None) for d, p, t, c, pg in rows], EL)


def test_text_scores(spark):
    df = spark.createDataFrame([("abc", "xyz"), ("hello", "hella"), ("kitten", "sitting"), ("", ""), ("a", ""), (None, "a")], "p string, r string")
    got = [round(r[0], 6) for r in df.select(scores.cer(F.col("p"), F.col("r"))).collect()]
    assert got == [1.0, 0.2, round(3 / 7, 6), 0.0, 1.0, 1.0]
    pairs = spark.createDataFrame([(1, "the cat sat on the mat", "the cat sat on the mat"), (2, "a b", "a b"), (3, "x y z w", "the cat sat on")], "id int, pred string, ref string")
    assert {r.id: round(r.bleu, 6) for r in scores.bleu(pairs).collect()} == {1: 1.0, 2: 0.0, 3: 0.0}
    assert {r.id: round(r.chrf, 6) for r in scores.chrf(pairs).collect()}[1] == 1.0


def test_structure_scores(spark):
    order = lambda rows: spark.createDataFrame(rows, "id int, ord int, item string")
    a, b = order([(1, 0, "a"), (1, 1, "b"), (1, 2, "c")]), order([(1, 0, "c"), (1, 1, "b"), (1, 2, "a")])
    assert scores.kendall_tau(a, b).first().tau == -1.0
    assert math.isclose(scores.order_f1(a, b).first().f1, 1 / 3)
    head = lambda rows: spark.createDataFrame(rows, "id int, level int, title string")
    assert math.isclose(scores.section_f1(head([(1, 1, " A"), (1, 1, "a")]), head([(1, 1, "A")])).first().f1, 4 / 3)


def test_layout(spark):
    box = lambda rows: spark.createDataFrame(rows, "id string, ord int, class string, x0 double, y0 double, x1 double, y1 double")
    t = box([("p", 0, "a", 0.0, 0.0, 10.0, 10.0), ("p", 1, "b", 20.0, 20.0, 30.0, 30.0)])
    assert scores.layout_map(t, t).first()["map"] == 1.0
    best = scores.best_overlaps(box([("p", 5, "a", 0.0, 0.0, 10.0, 10.0)]), t).first()
    assert (best.match_ord, best.iou) == (0, 1.0)
    assert scores.layout_map(box([]), t).first()["map"] == 0.0


def test_sections_and_chunks(spark):
    rows = [(1, 0, "paragraph", "preface", 1), (1, 1, "TITLE", "One", 1), (1, 2, "paragraph", "w " * 5, 1), (1, 3, "table", "a | b", 2), (1, 4, "heading", "Two", 2), (1, 5, None, "x " * 5, 2), (1, 5, None, "x " * 5, 2), (2, 0, "paragraph", "  ", 1)]
    s = {r.pos: r.section for r in chunking.sections(els(spark, rows)).collect()}
    assert s == {0: 0, 1: 1, 2: 1, 3: 1, 4: 2, 5: 2}
    c = chunking.by_title_chunks(els(spark, rows), size=6, under=0).orderBy("chunk_index").collect()
    assert [(r.chunk_type, r.section_title) for r in c] == [("text", None), ("text", "One"), ("table", None), ("text", "Two")]
    assert all(r.total_chunks == 4 for r in c)
    assert chunking.by_title_chunks(els(spark, [])).count() == 0


def reference_packer(parts, size, overlap):
    """The definition, on word counts only."""
    out, now = [], []
    for p in parts:
        if now and sum(map(len, now)) + len(p) > size:
            out.append([w for x in now for w in x])
            keep = []
            for x in reversed(now):
                if sum(map(len, keep)) + len(x) > overlap:
                    break
                keep.insert(0, x)
            now = keep
        now.append(p)
    return out + ([[w for x in now for w in x]] if now else [])


@given(st.lists(st.integers(1, 8), max_size=30), st.integers(8, 20), st.integers(0, 7))
def test_packer_follows_its_definition(sizes, size, overlap):
    parts = [[f"w{i}.{k}" for k in range(n)] for i, n in enumerate(sizes)]
    packer = chunking.TokenPacker(size, overlap)
    got = [c for p in parts for c in packer.add(" ".join(p), None)] + list(packer.end())
    assert [c[0].split() for c in got] == reference_packer(parts, size, overlap)
    assert all(len(c[0].split()) <= size + overlap for c in got)


def test_sentences():
    assert chunking.sentences("a. b. c.") == ["a.", "b.", "c."] and chunking.sentences(" . ") == []


def test_token_chunks(spark):
    rows = [(d, p, "table" if p == 3 else "paragraph", "w " * 4, 1) for d in (1, 2) for p in range(6)]
    c = chunking.token_chunks(els(spark, rows), size=8, overlap=4).where("doc_id = 1").orderBy("chunk_index").collect()
    assert [r.chunk_type for r in c] == ["text"] * 4 + ["table"] and c[-1].start_page is None


def test_rich_markdown(spark):
    text = "# T\n{1}\n----------\na | b\nc | d\n\n$$x$$\n$$\n- e\n#### f"
    got = [(r.type, r.page_number, r.content) for r in elements.rich_markdown_elements(spark.createDataFrame([(1, text), (2, None)], "doc_id int, text string")).orderBy("pos").collect()]
    assert got == [("title", 1, "T"), ("table", 2, "a | b\nc | d"), ("formula", 2, "x"), ("list", 2, "- e"), ("paragraph", 2, "#### f")]


def test_uuid5_and_consent(spark):
    df = spark.createDataFrame([("chunk:1:0:ä",)], "n string")
    assert df.select(sync.uuid5(F.col("n"))).first()[0] == str(uuid.uuid5(uuid.UUID(hex=sync.ID_NAMESPACE), "chunk:1:0:ä"))
    rec = spark.createDataFrame([("a", "Tax_Returns", None, True), ("b", "tax-return", None, None), ("c", "tax return", None, False), ("d", "lease", None, True), ("e", None, "TAX RETURN", True)], "id string, category string, document_type string, consent_on_file boolean")
    st_ = spark.createDataFrame([("a", True), ("c", True), ("e", False)], "document_id string, consent boolean")
    assert {r.id: r.action for r in sync.consent_actions(rec, st_).collect()} == {"a": "unchanged", "b": "skip", "c": "withdrawn", "d": "not_required", "e": "chunk"}


def test_benchmark(spark):
    runs = spark.createDataFrame([("p", "c", float(v)) for v in (4, 1, 3, 2)] + [("p", "c", None)], "parser string, config string, total_time double")
    r = benchmark.run_statistics(runs).first()
    assert (r.n, r.mean, r.median, r.p95) == (4, 2.5, 3.0, 4.0)
    c = benchmark.compare_baselines(runs, runs).first()
    assert c.change == 0 and c.t == 0 and math.isclose(benchmark.t_two_sided(2.0, 10), 0.0733880, abs_tol=1e-6)


def test_streaming(spark, tmp_path):
    from pagemill.streaming.updates import newest_updates

    spark.sql("select 'a' id, timestamp'2025-01-01 00:00:00' updated_at union all select 'a', timestamp'2025-01-01 00:00:00' union all select 'b', timestamp'2025-01-01 00:01:00'").write.parquet(str(tmp_path / "in"))
    stream = newest_updates(spark.readStream.schema("id string, updated_at timestamp").parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("newest").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    q.awaitTermination(60)
    assert spark.table("newest").count() == 2


def test_windowed_counts(spark, tmp_path):
    from pagemill.streaming.updates import requests_per_window

    spark.sql("select * from values (timestamp'2025-01-01 00:00:05', 'u'), (timestamp'2025-01-01 00:00:09', 'u'), (timestamp'2025-01-01 00:00:09', 'v') t(ts, user_id)").write.parquet(str(tmp_path / "in"))
    stream = requests_per_window(spark.readStream.schema("ts timestamp, user_id string").parquet(str(tmp_path / "in")), "10 seconds", "5 seconds")
    q = stream.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    q.awaitTermination(60)
    got = {(r.window.start.second, r.user_id): r.n for r in spark.table("windows").collect()}
    assert got == {(0, "u"): 2, (5, "u"): 2, (0, "v"): 1, (5, "v"): 1}


def test_hot_keys_are_salted(spark):
    from pagemill.plans.stages import salted_join

    facts = spark.createDataFrame([("hot", i) for i in range(50)] + [("cold", 99), (None, 7), ("none", 8)], "k string, i int")
    lookup = spark.createDataFrame([("hot", "h"), ("cold", "c"), ("other", "o")], "k string, v string")
    plain = sorted(map(str, facts.join(lookup, "k", "left").select("k", "i", "v").collect()))
    assert sorted(map(str, salted_join(facts, lookup, "k", F.col("i"), rows_per_task=10).select("k", "i", "v").collect())) == plain
    assert salted_join(facts, lookup, "k", F.col("i"), "inner", rows_per_task=10).count() == 51


def test_api_guards():
    assert checked_url("http://localhost:1/") == "http://localhost:1" and retry_delay("900", 1) == 60 and retry_delay(None, 3) == 8
    with pytest.raises(ValueError):
        checked_url("http://example.org")


def test_crowded_boxes_match_as_by_the_join(spark, monkeypatch):
    rng = random.Random(7)

    def side(n, numbers):
        rows = []
        for k in range(n):
            x, y, w, h = rng.randrange(40, 44), rng.randrange(40, 300), rng.randrange(-1, 9) * 64, rng.randrange(0, 8) * 16
            rows.append((rng.choice(("p", "q", None)), rng.randrange(numbers), rng.choice("ab"), float(x), float(y), float(x + w), float(y + h) if k % 50 else None))
        return spark.createDataFrame(rows, "id string, ord int, class string, x0 double, y0 double, x1 double, y1 double")

    pred, truth = side(500, 400).cache(), side(450, 350).cache()
    run = lambda: [sorted(map(tuple, d.collect()), key=str) for d in (scores.best_overlaps(pred, truth), scores.best_overlaps(pred, truth, 0.5, strict=False), scores.layout_map(pred, truth, 0.5), scores.layout_map(pred, truth, 0.3))]
    by_join = run()
    monkeypatch.setattr(scores, "MOST_PAIRS", 10)
    assert run() == by_join and len(by_join[0]) > 100
    schemas = [scores.best_overlaps(pred, truth).schema.simpleString(), scores.layout_map(pred, truth).schema.simpleString()]
    assert schemas == ["struct<id:string,ord:int,match_ord:int,iou:double>", "struct<id:string,map:double>"]


def test_no_pairs_are_listed_for_crowded_boxes(spark):
    """A document of 4,000 equal boxes on each side has 16 million pairs."""
    side = spark.range(4000).selectExpr("'d' id", "cast(id as int) ord", "'a' class", "0D x0", "0D y0", "10D x1", "10D y1")
    assert scores._crowded(side, side, ["id", "class"], 0.5).count() == 1 and scores.layout_map(side, side).first()["map"] == 1.0
    best = scores.best_overlaps(side, side)
    assert best.where("match_ord = 0 and iou = 1").count() == 4000


def test_layout_metrics_are_stored_before_their_union(spark):
    """One plan of all metrics (some 18 joins) took the driver's memory; only the documents without truth are left to join."""
    box = lambda k: (10.0, 100.0 * k, 90.0, 100.0 * k + 50)
    elements = spark.createDataFrame([(d, k, "title", box(k)) for d in "ab" for k in range(3)] + [("c", 0, "text", None), ("e", 0, "text", None)], "doc_id string, pos int, type string, bbox struct<x0 double, y0 double, x1 double, y1 double>")
    places = {"a": (0, 1, 2), "b": (0, 2, 1), "d": (0,), "e": (0,)}
    truth = [(d, n, f"{d}{k}", "Title", *box(k), float(n)) for d, ks in places.items() for n, k in enumerate(ks)]
    out = LayoutEvaluator().evaluate(elements, spark.createDataFrame(truth, "document_id string, ord int, annotation_id string, category string, x0 double, y0 double, x1 double, y1 double, reading_order double"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Window" not in plan
    rows = {(r.id, r.metric, None if r.value is None else round(r.value, 4), r.success) for r in out.collect()}
    tau, f1 = {"a": 1.0, "b": 0.3333}, {"a": 1.0, "b": 0.3333}
    assert rows == {("c", "none", None, False), *((d, m, v, True) for d in "ab" for m, v in (("map", 1.0), ("reading_order_f1", f1[d]), ("kendall_tau", tau[d])))}
    assert out.count() == len(rows)

"""Chunk sets, sync, sources, evaluation and reports on fixtures with known results."""

import json
import threading
import time
import uuid
from datetime import datetime, timedelta
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

import pagemill
from pagemill import cli, config
from pagemill.operators import benchmark, chunking, elements, evaluation, export, runner, scores, sync
from pagemill.operators.baselines import BaselineStore
from pagemill.plans import reference_queries
from pagemill.sources import annotations, docling, documents_api, files, parsers

A, B, C, D = (str(uuid.UUID(int=k + 1)) for k in range(4))
NAMESPACE = uuid.UUID("5d0c4f7e-3a51-4d0e-9a53-6b1b6a0f2c11")
REC = "id string, doc_id bigint, category string, document_type string, entity_id string, sha256 string, is_confidential boolean, consent_on_file boolean, title string, document_date date, updated_at timestamp, version_no int"
T0 = datetime(2025, 1, 1)


def records(spark, *rows):
    """(id, doc_id, category, document_type, is_confidential, consent) with the rest filled in."""
    return spark.createDataFrame([(i, d, c, t, A, "ab" * 32, s, k, "t", None, T0, 1) for i, d, c, t, s, k in rows], REC)


# --- chunk sets and sync


def test_tax_labels(spark):
    df = spark.createDataFrame([("Tax_Returns", None, True), ("tax-return", None, True), ("lease", "TAX  ELECTION", True), ("tax election", None, False), (None, "tax returns", False), (None, None, False), (None, "Tax Return", True)], "category string, document_type string, want boolean")
    assert all(r.got == r.want for r in df.withColumn("got", sync.is_tax_return(F.col("category"), F.col("document_type"))).collect())


def test_chunk_sets(spark):
    rec = records(spark, (A, 1, "lease", None, False, True), (B, 2, "Tax Returns", None, False, None), ("x", 3, None, None, False, True), (C, 4, None, None, None, True), (D, 5, None, None, True, None))
    chunks = spark.createDataFrame([(1, 0, "ä text", 1, 2), (1, 0, "ä text", 1, 2), (1, 1, None, 2, 2), (2, 0, "a", 1, 1), (3, 0, "a", 1, 1), (4, 0, "a", 1, 1), (5, 0, "a", 1, 1), (5, 1, "b", 0, 1)], "doc_id bigint, chunk_index int, content string, start_page int, end_page int")
    headers, entries = sync.chunk_sets(rec, chunks)
    got = {r.document_id: (r.total_chunks, r.error) for r in headers.collect()}
    assert got == {A: (2, None), B: (None, "tax return without consent on file"), "x": (None, "document_id must be a UUID"), C: (None, "Document field is_confidential must be a boolean"), D: (None, "Chunk 1 has no valid page range")}
    e = {r.chunk_index: r for r in entries.collect()}
    assert set(e) == {0, 1} and e[0].chunk_id == str(uuid.uuid5(NAMESPACE, f"chunk:{A}:0:ä text")) and e[1].chunk_id == str(uuid.uuid5(NAMESPACE, f"chunk:{A}:1:"))
    assert e[0].trace_id == str(uuid.uuid5(NAMESPACE, f"trace:{A}")) and e[0].token_count == 2 and e[0].trust_score is None and e[0].consent_on_file is True
    whole = json.loads(sync.set_files(headers, entries).first()["json"])
    assert whole["schema_version"] == "1.1" and [c["start_page"] for c in whole["chunks"]] == [1, 2] and whole["document_date"] is None
    w = {r.document_id: (r.is_confidential, r.consent_on_file) for r in sync.withdrawn_sets(rec).collect()}
    assert w[A] == (False, False) and w[C] == (True, False)
    assert {r.document_id: r.consent for r in sync.stored_consent(headers.withColumn("consent_on_file", F.lit(True)), entries.withColumn("consent_on_file", F.col("chunk_index") == 0)).collect()}[A] is False


def test_consent_and_withdrawal(spark):
    rec = records(spark, (A, 1, "Tax_Returns", None, False, True), (B, 2, "tax-return", None, False, None), (C, 3, "tax return", None, False, False), (D, 4, "lease", None, False, True))
    stored = spark.createDataFrame([(A, True), (C, True), (C, None)], "document_id string, consent boolean")
    assert {r.id: r.action for r in sync.consent_actions(rec, stored).collect()} == {A: "unchanged", B: "skip", C: "withdrawn", D: "not_required"}
    heads = spark.createDataFrame([(A, "tax return", None, 2, True), (B, None, None, 0, True), (C, "lease", None, 1, True), (D, None, None, None, False)], "document_id string, category string, document_type string, total_chunks int, readable boolean")
    gone = spark.createDataFrame([(A,), (B,), (C,), (D,), ("n",)], "document_id string")
    got = {r.document_id: (r.action, r.error is not None) for r in sync.withdraw_deleted(heads, gone).collect()}
    assert got == {A: ("withdrawn", False), B: ("withdrawn", False), C: (None, True), D: ("withdrawn", False), "n": ("skip", False)}
    assert {r.document_id for r in sync.stored_tax_ids(heads).collect()} == {A, D}


def test_sync_outcomes(spark):
    ids = [str(uuid.UUID(int=k)) for k in range(10, 19)]
    lease, tax = ("lease", None, False, True), ("tax return", None, False, True)
    no = ("tax return", None, False, False)
    kinds = [lease, tax, tax, no, no, lease, tax, lease, lease]
    rec = records(spark, *((i, k, *x) for k, (i, x) in enumerate(zip(ids, kinds))))
    updated, taxes = rec.where(~F.col("id").isin(ids[1], ids[2], ids[3], ids[4])), rec.where("category = 'tax return'")
    stored = spark.createDataFrame([(ids[1], True), (ids[4], True)], "document_id string, consent boolean")
    now = rec.where(~F.col("id").isin(ids[5], ids[6])).withColumn("updated_at", F.when(F.col("id") == ids[7], F.col("updated_at") + F.expr("interval 1 hour")).otherwise(F.col("updated_at")))
    loaded = rec.select("id", F.when(F.col("id") == ids[8], F.lit("cd" * 32)).otherwise(F.col("sha256")).alias("sha256"))
    out = sync.sync_documents(updated, taxes, stored, now, loaded)
    got = {r.id: r.outcome for r in out.collect()}
    assert got == dict(zip(ids, ["chunked", "unchanged", "chunked", "skipped", "withdrawn", "skipped", "withdrawn", "failed", "failed"]))
    r = sync.run_report(out, updated).first()
    assert (r.chunked, r.failed, r.newest_updated_at) == (2, 2, T0)
    assert sync.sync_documents(rec.limit(0), rec.limit(0), stored, now, loaded).count() == 0


# --- scores and reports


def cells(spark, rows):
    return spark.createDataFrame(rows, "id int, ord int, row int, col int, text string, is_header boolean")


def test_table_scores(spark):
    truth = [(1, 0, 0, 0, "A", True), (1, 1, 0, 1, "B", False), (2, 0, 0, 0, "x", False), (4, 0, 0, 0, "x", True)]
    pred = [(1, 0, 0, 0, " a ", True), (1, 1, 0, 0, "A", True), (1, 2, 0, 1, "b", True), (3, 0, 0, 0, "x", True), (4, 0, 1, 0, "x", True)]
    got = {r.id: (round(r.teds, 6), r.exact, round(r.header_f1, 6)) for r in scores.table_scores(cells(spark, pred), cells(spark, truth)).collect()}
    assert got == {1: (round(0.3 + 0.3 + 0.4 * 1.5, 6), 0.5, round(2 / 3, 6)), 2: (0.0, 0.0, 1.0), 3: (0.0, 0.0, 0.0), 4: (round(0.15 + 0.3, 6), 0.0, 0.0)}


def test_kendall_with_ties(spark):
    o = lambda rows: spark.createDataFrame(rows, "id int, ord int, item string")
    a, b = o([(1, 0, "a"), (1, 0, "b"), (1, 1, "c"), (2, 0, "z")]), o([(1, 2, "a"), (1, 1, "b"), (1, 0, "c"), (2, 5, "z")])
    assert {r.id: round(r.tau, 6) for r in scores.kendall_tau(a, b).collect()} == {1: round(-2 / 3, 6), 2: 0.0}


def test_failures(spark):
    messages = [("Ground truth missing", "Missing ground truth"), ("file not found", "Missing ground truth"), ("bad LAYOUT", "Layout detection error"), ("cannot Parse", "Parsing error"), ("Evaluation", "Evaluation error"), ("x" * 80, "x" * 60), (None, "Unknown error")]
    df = spark.createDataFrame(messages, "m string, want string")
    assert all(r.got == r.want for r in df.withColumn("got", benchmark.failure_category(F.col("m"))).collect())


def test_recommendations_and_best(spark):
    r = spark.createDataFrame([(1, "p", "a", 1.0, 0.5, 9.0, 1.0, 50), (2, "q", "b", 1.0, None, 3.0, 1.0, 200), (3, "r", "c", 4.0, 0.9, 3.0, 0.5, 100)], "ord int, parser string, config string, time double, quality double, memory double, rate double, n int")
    assert [x.parser for x in benchmark.recommendations(r, "speed").collect()] == ["p", "q", "r"]
    best = benchmark.recommended(r, "accuracy").first()
    assert best.parser == "r" and best.confidence == 0.5 and best.rationale == "r with c achieves 4.00s avg processing time with 0.90 quality score"
    b = benchmark.best_configurations(r).first()
    assert (b.fastest, b.most_accurate, b.least_memory) == ("p/a", "r/c", "q/b")
    c = benchmark.compare_results(r, r.withColumn("time", F.col("time") * 1.5)).where("parser = 'p'").first()
    assert (c.time_change, c.memory_change, c.quality_change) == (50.0, 0.0, 0.0)
    p = spark.createDataFrame([("x", None, 8, 100), ("y", None, 8, 0), ("z", "g", 8, 100)], "name string, gpu_model string, cpu_cores int, total_documents int")
    assert [x.name for x in benchmark.compatible_baselines(p, False, 7, 90).collect()] == ["x"] and [x.name for x in benchmark.compatible_baselines(p, False, 8, 0).collect()] == ["y"]


def test_ranks_by_histogram(spark):
    import random

    rnd = random.Random(1)
    rows = [(k, rnd.choice([rnd.random() * 1e6, float(rnd.randrange(5)), 7.0])) for k in "ab" for _ in range(500)] + [("c", 1.0), ("d", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.n, r.median, r.p95) for r in benchmark.ranked_values(df, ["k"], "v", {"median": F.floor(F.col("n") / 2), "p95": F.floor(F.col("n") * 0.95)}, bins=16).collect()}
    for k in "abc":
        v = sorted(x for y, x in rows if y == k)
        assert got[k] == (len(v), v[len(v) // 2], v[int(len(v) * 0.95)])
    assert "d" not in got


EL = "doc_id bigint, pos int, element_type string, content string, page_number int, category_depth int, confidence double"


def els(spark, rows):
    return spark.createDataFrame([(d, p, t, c, g, n, None) for d, p, t, c, g, n in rows], EL)


def test_exports(spark, tmp_path):
    e = els(spark, [(1, 0, "title", "T", 1, 9), (1, 1, "list", "l", 1, None), (1, 2, "LIST_ITEM", "i", 1, None), (1, 3, "code_snippet", "c", 1, None), (1, 4, "figure_caption", "f", 1, 0), (1, 5, "heading", "h", 1, 0), (1, 6, "table", "t", 2, None)])
    md = export.to_markdown(e).first().markdown
    assert md == "###### T\n\nl\n\n- i\n\n```\nc\n```\n\n*f*\n\n# h\n\n\nt\n"
    assert export.to_text(e).first().text == "T\n\nl\n\ni\n\nc\n\nf\n\nh\n\nt"
    docs = spark.createDataFrame([(1, 'a "b"', 2), (2, None, None)], "doc_id bigint, source string, n int")
    front = {r.doc_id: r.front for r in export.front_matter(docs, ["source", "n"]).collect()}
    assert front[1] == '---\nsource: "a \\"b\\""\nn: 2\n---\n' and front[2] == "---\nsource: null\nn: null\n---\n"
    chunks = spark.createDataFrame([(1, 0, "u", "x", 1, 1, 1, 2)], "doc_id bigint, chunk_index int, chunk_id string, content string, token_count int, char_count int, start_page int, end_page int")
    whole = {r.doc_id: json.loads(r.json) for r in export.documents_json(docs, e, chunks).collect()}
    assert whole[1]["elements"][0]["metadata"] == {"page_number": 1, "category_depth": 9} and whole[1]["chunks"][0]["chunk_id"] == "u" and whole[2]["elements"] == [] and whole[2]["source"] is None
    both = export.export(docs, e, chunks, "both", ["source"])
    assert sorted((r.doc_id, r.suffix) for r in both.collect()) == [(1, ".json"), (1, ".md"), (2, ".json"), (2, ".md")]
    with pytest.raises(ValueError):
        export.export(docs, e, chunks, "html", [])
    made = both.select(F.concat(F.col("doc_id").cast("string"), "suffix").alias("name"), "content")
    sizes = {r.name: r.n_bytes for r in export.write_files(made, str(tmp_path)).collect()}
    assert {p.name: p.stat().st_size for p in tmp_path.iterdir()} == sizes and (tmp_path / "1.md").stat().st_mode & 0o777 == 0o644
    page = export.html_report("<b>", {"s": docs.orderBy("doc_id")})
    assert "<h1>&lt;b&gt;</h1>" in page and "<td>a &quot;b&quot;</td>" in page
    text = spark.createDataFrame([("one two one", ["one"])], "c string, e array<string>")
    assert text.select(export._emphasised(F.col("c"), F.col("e"))).first()[0] == "**one** two **one**"


# --- trees and packing


def test_heading_paths_and_tree_chunks(spark):
    rows = [(1, 0, "title", "T", 1, 0), (1, 1, "paragraph", "a b c", 1, None), (1, 2, "heading", "H1", 1, 1), (1, 3, "paragraph", "d. e. f.", 2, None), (1, 4, "heading", "H2", 2, 2), (1, 5, "paragraph", "w " * 30, 3, None), (1, 6, "heading", "H3", 3, 1), (1, 7, "paragraph", "x", None, None), (2, 0, "paragraph", "alone", 1, None)]
    e = els(spark, rows).withColumnRenamed("element_type", "type").withColumn("level", F.col("category_depth")).withColumn("heading", F.when(F.col("level").isNotNull(), F.col("content")))
    paths = {(r.doc_id, r.pos): r.path for r in elements.heading_paths(e).collect()}
    assert paths[1, 5] == ["T", "H1", "H2"] and paths[1, 7] == ["T", "H3"] and paths[2, 0] == [] and paths[1, 0] == ["T"]
    c = chunking.tree_chunks(e, 12).orderBy("doc_id", "chunk_index").collect()
    assert [r.section_path for r in c if r.doc_id == 1] == [["T"], ["T", "H1"], *[["T", "H1", "H2"]] * 4, ["T", "H3"]]
    assert all(r.token_count <= 12 for r in c) and c[0].content == "T\na b c" and c[-2].error == "chunk has no page" and c[-1].section_title is None
    assert sum(r.content.count("w") for r in c) == 30 and chunking.tree_chunks(e.limit(0)).count() == 0


def test_token_chunks_in_stretches(spark):
    """Packing in stretches from one oversized element to the next equals packing the whole document."""
    import random

    rnd = random.Random(3)
    parts = [" ".join(["w"] * rnd.choice([1, 3, 5, 9, 14])) + "." for _ in range(60)]
    e = els(spark, [(1, i, "paragraph", t, 1, None) for i, t in enumerate(parts)])
    packer = chunking.TokenPacker(10, 4)
    want = [c[0] for t in parts for c in packer.add(t, 1)] + [c[0] for c in packer.end()]
    got = chunking.token_chunks(e, 10, 4).orderBy("chunk_index").collect()
    assert [r.content for r in got] == want and [r.chunk_index for r in got] == list(range(len(want)))
    letters = chunking.token_chunks(e, 10, 4, count=len).orderBy("chunk_index").collect()
    assert [r.content for r in letters] != want and letters[0].chunk_index == 0


def test_pages_end_chunks(spark):
    e = els(spark, [(1, 0, "paragraph", "a", 1, None), (1, 1, "paragraph", "b", None, None), (1, 2, "paragraph", "c", 2, None)])
    assert [r.content for r in chunking.by_title_chunks(e, respect_pages=True).orderBy("chunk_index").collect()] == ["a\n\nb", "c"]
    assert chunking.by_title_chunks(e).count() == 1


# --- sources


TREE = {
    "body": {"children": [{"$ref": "#/texts/0"}, {"$ref": "#/groups/0"}, {"$ref": "#/tables/0"}, {"$ref": "#/texts/3"}, {"$ref": "#/pictures/0"}, {"$ref": "#/texts/5"}]},
    "groups": [{"children": [{"$ref": "#/texts/1"}, {"$ref": "#/texts/2"}]}],
    "texts": [
        {"label": "title", "text": "Top", "prov": [{"page_no": 1, "bbox": {"l": 1, "t": 90, "r": 5, "b": 80, "coord_origin": "BOTTOMLEFT"}}]},
        {"label": "section_header", "text": "Part", "level": 2},
        {"label": "list_item", "text": "one", "prov": [{"page_no": 2, "bbox": {"l": 1, "t": 10, "r": 5, "b": 20, "coord_origin": "TOPLEFT"}}]},
        {"label": "section_header", "text": " ", "level": 1},
        {"label": "text", "text": "in a picture"},
        {"label": "text", "text": "foot", "content_layer": "furniture"},
    ],
    "tables": [{"label": "table", "data": {"grid": [[{"text": "a"}, {"text": "b|c"}], [{"text": "1"}, {"text": "<2>"}]]}}],
    "pictures": [{"label": "picture", "children": [{"$ref": "#/texts/4"}]}],
    "pages": {"1": {"size": {"height": 100}}},
}


def test_conversion_trees(spark):
    df = spark.createDataFrame([(1, json.dumps(TREE)), (2, "{"), (3, None), (4, "[]")], "doc_id bigint, json string")
    rows = docling.docling_elements(df).orderBy("doc_id", "pos").collect()
    got = [(r.type, r.content, r.category_depth, r.section_title) for r in rows if r.doc_id == 1]
    assert got == [("title", "Top", 0, "Top"), ("title", "Part", 2, "Part"), ("list_item", "one", 2, "Part"), ("table", "| a | b\\|c |\n|---|---|\n| 1 | <2> |", 1, "Part")]
    assert (rows[0].y0, rows[0].y1, rows[2].y0) == (10.0, 20.0, 10.0) and "<td>&lt;2&gt;</td>" in rows[3].text_as_html
    assert [(r.doc_id, r.error) for r in rows[4:]] == [(2, "not a valid document tree"), (4, "not a valid document tree")]


def test_large_trees_are_parsed_item_by_item():
    wide = TREE | {"texts": TREE["texts"] + [{"label": "text", "text": f'é "{k}", [{{\\'} for k in range(300)], "body": {"children": [*TREE["body"]["children"], *({"$ref": f"#/texts/{k}"} for k in (-1, *range(6, 306)))]}}
    for text in (json.dumps(wide, ensure_ascii=False), json.dumps(wide, indent=1)):
        assert list(docling.tree_elements(docling.parse_tree(memoryview(text.encode()), 0))) == list(docling.tree_elements(json.loads(text)))
        for wrong in (text[:-1], text.replace("299", "299\x01"), text.replace('"pictures": [', '"pictures": [,'), "[]"):
            with pytest.raises((ValueError, AttributeError)):
                docling.parse_tree(memoryview(wrong.encode()), 0)


def test_a_document_of_many_pages_is_no_quadratic_work(spark, tmp_path):
    rows = spark.range(30_000).selectExpr("1L doc_id", "cast(id as int) pos", "'paragraph' element_type", "'text' content", "cast(id + 1 as int) page_number", "cast(null as int) category_depth", "cast(null as double) confidence")
    rows.coalesce(1).write.parquet(f"{tmp_path}/elements.parquet")
    began = time.time()
    tree = json.loads(reference_queries._trees(spark, str(tmp_path)).first()["json"])
    assert len(tree["pages"]) == len(tree["texts"]) == 30_000 and tree["texts"][7]["prov"][0]["page_no"] == 8
    assert time.time() - began < 20


def test_converter_states(spark):
    def convert(name, content):
        return {"status": {b"p": "partial_success", b"x": "failure"}.get(content, "success"), "document": {"json_content": TREE}}

    df = spark.createDataFrame([("d/a", bytearray(b"a")), ("p", bytearray(b"p")), ("x", bytearray(b"x")), ("big", bytearray(b"big!")), ("n", None)], "path string, content binary")
    got = {r.path: (r.status, r.error is None) for r in docling.converted(df, convert, 3).collect()}
    assert got == {"d/a": ("completed", True), "p": ("requires_review", True), "x": ("failed", False), "big": ("failed", False), "n": ("failed", False)}


def test_annotations_and_evaluation(spark, tmp_path):
    coco = {"images": [{"id": 1, "file_name": "a.png"}, {"id": 2, "file_name": "b.png"}, {"id": 3, "file_name": "a.png"}], "annotations": [{"id": 7, "image_id": 3, "category_id": 1, "bbox": [0, 0, 10, 10]}, {"id": 8, "image_id": 3, "category_id": 9, "bbox": [0, 20, 10, 10], "area": 5}, {"id": 9, "image_id": 3, "category_id": 1, "bbox": [1]}], "categories": [{"id": 1, "name": "Text"}]}
    (tmp_path / "train.json").write_text(json.dumps(coco))
    (tmp_path / "val.json").write_text(json.dumps(coco | {"images": [{"id": 3, "file_name": "b.png"}, {"id": 3, "file_name": "c.png"}]}))
    a = annotations.coco_annotations(annotations.read_coco(spark, str(tmp_path)))
    got = sorted((r.document_id, r.annotation_id, r.category, r.y1) for r in a.collect())
    assert [g for g in got if g[0] == "a"] == [("a", "7", "Text", 10.0), ("a", "8", "unknown", 30.0), ("a", "9", "Text", None)]
    assert not any(g[0] == "b" for g in got) and sum(g[0] == "c" for g in got) == 3
    assert [r.item for r in evaluation.true_order(a).where("id = 'a'").orderBy("ord").collect()] == ["7", "9", "8"]
    box = "doc_id string, pos int, type string, bbox struct<x0:double,y0:double,x1:double,y1:double>"
    e = spark.createDataFrame([("a", 0, "narrative_text", (0.0, 0.0, 10.0, 9.0)), ("a", 1, "list", (0.0, 21.0, 10.0, 30.0)), ("c", 0, "text", None), ("zz", 0, "text", None)], box)
    out = {(r.id, r.metric): (r.value and round(r.value, 6), r.success) for r in evaluation.LayoutEvaluator().evaluate(e, a).collect()}
    assert out[("a", "map")] == (0.5, True) and out[("a", "reading_order_f1")] == (1.0, True) and out[("a", "kendall_tau")] == (1.0, True)
    assert out[("zz", "none")] == (None, False) and not any(k[0] == "c" for k in out)
    (tmp_path / "gt").mkdir()
    (tmp_path / "gt" / "d1.json").write_text('{"text": "x"}')
    (tmp_path / "gt" / "d2.json").write_text("nothing")
    truth = annotations.ground_truth(spark, str(tmp_path / "gt"), "text string")
    res = spark.createDataFrame([("d1", True, None), ("d2", True, None), ("d3", False, "bad")], "document_id string, success boolean, error string")
    assert {r.document_id: (r.success, r.error) for r in annotations.with_truth(res, truth).collect()} == {"d1": (True, None), "d2": (False, "Ground truth not found"), "d3": (False, "bad")}


def test_files_and_formats(spark, tmp_path):
    for name, data in {"a.pdf": b"%PDF-1.7", "b.bin": b"fLaC00", "c.doc": b"x", "d.webm": b"x", "e": b"?", "f.txt": b" <!DOCTYPE html>", "g.M4A": b"x"}.items():
        (tmp_path / name).write_bytes(data)
    found = files.files(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[-1]: (r.format, r.error) for r in files.checked(found).collect()}
    assert {k: v[0] for k, v in got.items()} == {"a.pdf": "pdf", "b.bin": "audio" if got["b.bin"][0] == "audio" else "unknown", "c.doc": "docx", "d.webm": "video", "e": "unknown", "f.txt": "html", "g.M4A": "audio"}
    assert got["a.pdf"][1] is None and got["e"][1] == "unsupported format" and got["c.doc"][1] == "no parser for docx"
    assert {r.error for r in files.checked(found, 1e-9).where("format = 'pdf'").collect()} == {"file exceeds 1e-09 MB"}
    docs = files.documents_of(found, spark.createDataFrame([("https://x.example/y.PDF",), ("ftp://z",)], "url string")).collect()
    assert {r.source_url: (r.format, r.status) for r in docs if r.source_url} == {"https://x.example/y.PDF": ("pdf", "pending"), "ftp://z": ("unknown", "failed")}
    assert {r.error for r in files.hashed(found, 3).where("n_bytes > 3").collect()} == {"file exceeds the size limit"}
    corpus = spark.range(50).select(F.concat(F.lpad("id", 3, "0"), F.lit(".PNG")).alias("path"), (F.col("id") % 5).alias("k"))
    assert [r.path for r in files.corpus(corpus, 3, "sequential").collect()] == ["000.PNG", "001.PNG", "002.PNG"]
    assert [r.path for r in files.corpus(corpus, 7).collect()] == [r.path for r in files.corpus(corpus.repartition(7), 7).collect()]
    assert files.corpus(corpus, 10, "stratified", category="k").groupBy("k").count().where("count = 2").count() == 5
    times = spark.createDataFrame([("2024-02-03", "2024-02-03T01:00:00"), ("2024-2-3", "2024-02-03T01:00:00+02:00"), ("x", "x")], "d string, t string").select(files.canonical_date(F.col("d")).alias("d"), files.utc_time(F.col("t")).alias("t")).collect()
    assert [r.d is not None for r in times] == [True, False, False] and times[0].t - times[1].t == timedelta(hours=2) and times[2].t is None
    with pytest.raises(ValueError):
        files.api_key("a", variable="B")
    with pytest.raises(ValueError):
        files.loopback_only("http://10.0.0.1:1/")
    assert files.loopback_only("http://127.0.0.1:9/v1") and files.api_key("k") == "k"


def test_parsers_fall_back(spark):
    def bad(path, content):
        raise RuntimeError("no")

    r = parsers.Registry()
    r.add(parsers.Parser("late", parsers.text_parser, ("pdf",), 50))
    r.add(parsers.Parser("early", bad, ("pdf",), 10, lambda: 1 / 0))
    assert [p.name for p in r.chain("pdf")] == ["early", "late"] and r.health() == [("late", 50, True), ("early", 10, False)]
    with pytest.raises(ValueError):
        r.add(parsers.Parser("late", bad))
    df = spark.createDataFrame([("a", "pdf", bytearray(b"# T\n\ntext")), ("b", "html", bytearray(b"x")), ("c", "pdf", bytearray(b"skip"))], "path string, format string, content binary")
    out = {x.path: x for x in parsers.route(df, r, spark.createDataFrame([("c",)], "path string")).collect()}
    assert set(out) == {"a", "b"} and out["a"].parser == "late" and out["a"].attempts == ["early", "late"] and out["b"].error == "no parser for html"
    assert [(e.type, e.content) for e in out["a"].elements] == [("title", "T"), ("paragraph", "text")]
    assert parsers.first_attempt(bad, parsers.text_parser)("p", b"# x") == [("title", "x", None)]
    e = spark.createDataFrame([(1, 0, "paragraph", "bonjour"), (2, 0, "table", "x")], "doc_id bigint, pos int, type string, content string")
    assert {x.doc_id: x.languages for x in parsers.detected_languages(e, lambda t: ["fr"] if "bon" in t else []).collect()} == {1: ["fr"]}
    res = spark.createDataFrame([("a", True), ("b", True)], "path string, needs_upscaling boolean")
    up = {x.path: (bytes(x.content)[:1], x.used_upscaled) for x in parsers.upscaled(df, res, lambda c: b"U" if b"#" in c else 1 / 0).collect()}
    assert up == {"a": (b"U", True), "b": (b"x", False), "c": (b"s", False)}


class _Api(BaseHTTPRequestHandler):
    rows = [{"id": str(i), "updated_at": f"2025-01-0{i}T00:00:00Z", "is_confidential": i % 2 == 0} for i in range(1, 6)]
    moves = False

    def do_GET(self):
        from urllib.parse import parse_qs, urlparse

        u = urlparse(self.path)
        parts = u.path.strip("/").split("/")
        if len(parts) > 1:
            row = next((r for r in self.rows if r["id"] == parts[1]), None)
            body = None if row is None else b"file" if len(parts) > 2 else json.dumps(row).encode()
        else:
            q = parse_qs(u.query)
            n, page = int(q["size"][0]), int(q["page"][0])
            total = len(self.rows) + (page if self.moves else 0)
            body = json.dumps({"items": self.rows[(page - 1) * n : page * n], "pages": -(-len(self.rows) // n), "total": total}).encode()
        self.send_response(404 if body is None else 200)
        self.end_headers()
        self.wfile.write(body or b"")

    def log_message(self, *a):
        pass


def test_checked_listing(spark, tmp_path):
    server = ThreadingHTTPServer(("127.0.0.1", 0), _Api)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    try:
        got = documents_api.listing(spark, url, str(tmp_path / "a"), pageSize="2")
        assert [r.id for r in got.collect()] == ["1", "2", "3", "4", "5"]
        ids = spark.createDataFrame([("1",), ("9",)], "id string")
        assert {r.id: r.found for r in documents_api.lookup(ids, url).collect()} == {"1": True, "9": False}
        files_ = {r.id: (r.n_bytes, r.error) for r in documents_api.download(ids, url).collect()}
        assert files_ == {"1": (4, None), "9": (0, "not found")} and documents_api.download(ids, url, most_bytes=3).where("id = '1'").first().error == "file exceeds the size limit"
        _Api.moves = True
        with pytest.raises(Exception, match="listing"):
            documents_api.listing(spark, url, str(tmp_path / "b"), pageSize="2")
    finally:
        _Api.moves = False
        server.shutdown()
    for body in ([], {"items": [], "pages": 0, "total": 0}, {"items": [], "pages": 1, "total": True}, {"items": None, "pages": 1, "total": 0}):
        with pytest.raises(ValueError):
            documents_api.page_of(body)
    assert documents_api.since(datetime(2025, 1, 1, 0, 5)) == "2025-01-01T00:00:00+00:00" and documents_api.since(None) is None
    copies = spark.createDataFrame([("a", "1", "old"), ("a", "2", "new")], "id string, updated_at string, title string")
    assert documents_api.newest_copies(copies).first().title == "new"


def test_baselines(spark, tmp_path):
    s = BaselineStore(spark, str(tmp_path / "b"))
    row = lambda v: spark.createDataFrame([(v,)], "v int")
    assert s.latest("x") is None and s.profiles() is None and [s.save("x", row(k), row(10 * k)) for k in (1, 2)] == [1, 2]
    assert s.named("x").first().v == 2 and s.named("x:v1").first().v == 1 and s.named("x:latest").first().v == 2
    assert sorted((r.name, r.version, r.v) for r in s.profiles().collect()) == [("x", 1, 10), ("x", 2, 20)]
    with pytest.raises(KeyError):
        s.named("y")


# --- settings and command line


def test_settings(tmp_path):
    s = config.Settings.from_env({"PAGEMILL_CHUNK_SIZE": "5", "PAGEMILL_RESPECT_PAGES": "yes", "PAGEMILL_OCR_LANGUAGES": "eng, deu", "OTHER": "1"})
    assert (s.chunk_size, s.respect_pages, s.ocr_languages) == (5, True, ("eng", "deu"))
    for bad in ({"PAGEMILL_CHUNK_MAX_TOKENS": "8"}, {"PAGEMILL_RESPECT_PAGES": "maybe"}, {"PAGEMILL_CHUNK_SIZE": "x"}, {"PAGEMILL_CHUNKS_FILE_MODE": "9"}):
        with pytest.raises(ValueError):
            config.Settings.from_env(bad)
    assert [config.quality_level(x) for x in (0.95, 0.85, 0.7, 0.69)] == ["excellent", "good", "acceptable", "poor"]
    assert config.suite({"a_configs": None, "b_configs": [{"name": "n", "k": 1}, {}], "other": 1}) == [config.Configuration("b", "n", {"k": 1}), config.Configuration("b", "config_2", {})]
    with pytest.raises(ValueError):
        config.BenchmarkConfig("d", workers=0)
    with pytest.raises(ValueError):
        config.BenchmarkConfig.from_mapping({"documents": "d", "nonsense": 1})
    (tmp_path / "s.json").write_text('{"a": 1}')
    assert config.read_mapping(str(tmp_path / "s.json")) == {"a": 1} and config.Settings(storage_path=str(tmp_path / "n")).prepared_storage().is_dir()


def test_options():
    import argparse

    assert cli.uuid_option("{" + A.upper() + "}") == A and cli.time_option("2025-01-01T00:00:00").tzinfo is not None
    for fn, bad in ((cli.uuid_option, "x"), (cli.date_option, "2025-1-1"), (cli.date_option, "2025-02-30"), (cli.time_option, "x")):
        with pytest.raises(argparse.ArgumentTypeError):
            fn(bad)


def test_commands(spark, tmp_path, capsys):
    docs = tmp_path / "in"
    docs.mkdir()
    (docs / "a.html").write_text("# Title\nsome text here")
    out = tmp_path / "out"
    assert cli.main(["process", str(docs), "--output", str(out), "--format", "both"]) == 0
    assert sorted(p.suffix for p in out.iterdir()) == [".json", ".md"]
    assert cli.main(["process", str(docs), "--strategy", "by_title"]) == 0
    assert cli.main(["chunk", str(docs), "--document-id", A, "--entity-id", B, "--sha256", "ab", "--category", "Tax Return", "--output", str(out)]) == 2
    assert cli.main(["chunk", str(docs), "--document-id", A, "--entity-id", B, "--sha256", "ab", "--output", str(out)]) == 1  # text has no pages
    assert cli.main(["health"]) == 0
    results = spark.createDataFrame([(1, "p", "a", 1.0, 0.5, 9.0, 1.0, 50), (2, "q", "b", 2.0, 0.7, 3.0, 1.0, 200)], "ord int, parser string, config string, time double, quality double, memory double, rate double, n int")
    results.write.parquet(str(tmp_path / "r"))
    for _ in range(2):
        assert cli.main(["baseline-create", "x", "--results", str(tmp_path / "r"), "--store", str(tmp_path / "s")]) == 0
    assert cli.main(["baseline-compare", "x:v1", "x:latest", "--store", str(tmp_path / "s")]) == 0
    assert cli.main(["compare-configs", str(tmp_path / "r"), "--target", "speed"]) == 0
    assert "x:v2" in capsys.readouterr().out


def test_benchmark_run(spark, tmp_path):
    for name in ("a.pdf", "b.pdf", "c.txt"):
        (tmp_path / name).write_text("# x\ntext")
    r = parsers.Registry()
    r.add(parsers.Parser("t", parsers.text_parser, ("pdf",)))
    truth = spark.createDataFrame([("a", 0, "7", "Text", 1, 0.0, 0.0, 1.0, 1.0, 1.0)], "document_id string, ord int, annotation_id string, category string, category_id bigint, x0 double, y0 double, x1 double, y1 double, area double")
    rows, overview = runner.orchestrate(spark, config.BenchmarkConfig(str(tmp_path)), r, truth, evaluation.LayoutEvaluator())
    assert [(x.id, x.success) for x in rows.collect()] == [("b", False)] and overview.first().total_documents == 1
    export.save_results(rows, str(tmp_path / "rows"))
    assert cli.main(["benchmark-report", str(tmp_path / "rows"), "--html", str(tmp_path / "r.html")]) == 0 and "Failures" in (tmp_path / "r.html").read_text()


def test_lazy_package():
    assert pagemill.scores is scores
    with pytest.raises(AttributeError):
        pagemill.nothing

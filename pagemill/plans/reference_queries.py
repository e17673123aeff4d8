"""Queries of the document-analytics operators and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.keys import raw_or_canonical_uuid
from pagemill.operators import benchmark, chunking, evaluation, export, scores, sync
from pagemill.operators import elements as el
from pagemill.sources import annotations, docling, files
from pagemill.sources.tables import table


def _r(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, for comparison between engines."""
    return df.select(*(F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def _runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs of parsers (l_returnflag) in configurations (l_linestatus), of two baselines by ship date."""
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_returnflag").alias("parser"), F.col("l_linestatus").alias("config"), (F.year("l_shipdate") % 2 + 1).alias("version"), F.col("l_quantity").cast("double").alias("total_time"), F.col("l_discount").cast("double").alias("quality"), F.col("l_tax").cast("double").alias("memory"), (F.col("l_linenumber") != 7).alias("success"))


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    r = _runs(spark, d)
    m = lambda name, c: F.struct(F.lit(name).alias("metric"), F.col(c).alias("value"))
    return r.select(F.col("config").alias("dataset"), "parser", "success", F.explode(F.array(m("time_error", "total_time"), m("quality", "quality"))).alias("m")).select("dataset", "parser", "success", "m.metric", "m.value")


def _results(spark: SparkSession, d: str) -> DataFrame:
    r = _runs(spark, d).groupBy("parser", "config").agg(F.round(F.avg("total_time"), 6).alias("time"), F.round(F.avg("quality"), 6).alias("quality"), F.round(F.avg("memory"), 6).alias("memory"), (F.count_if("success") / F.count(F.lit(1))).alias("rate"), F.count(F.lit(1)).alias("n"))
    return r.withColumn("ord", F.concat("parser", "config"))


def _titles(spark: SparkSession, d: str) -> DataFrame:
    """Record titles against their labels, as predictions and references."""
    r = sync.latest_records(table(spark, d, "records"))
    return r.where(F.col("title").isNotNull()).select(F.col("id"), F.col("title").alias("pred"), F.concat_ws(" ", "category", "document_type", F.year("document_date").cast("string")).alias("ref"))


def _ascii(pairs: DataFrame) -> DataFrame:
    fold = lambda c: F.regexp_replace(F.lower(c), "[^ -~]", "?").alias(c)
    return pairs.select("id", fold("pred"), fold("ref"))


def _orders(spark: SparkSession, d: str, by: str) -> DataFrame:
    """Orders of the parts of an order line by line: as numbered, and by ship date."""
    li = table(spark, d, "lineitem")
    place = F.col("l_linenumber").cast("bigint") if by == "line" else F.unix_seconds(F.col("l_shipdate").cast("timestamp")) * 8 + F.col("l_linenumber")
    return li.select(F.col("l_orderkey").alias("id"), place.alias("ord"), F.col("l_partkey").alias("item"))


def _headings(spark: SparkSession, d: str, parsed: bool) -> DataFrame:
    """Headings of all documents; as parsed, level 2 is read as 1 and titles in capitals."""
    toc = el.table_of_contents(table(spark, d, "elements"))
    level = F.when(F.lit(parsed) & (F.col("level") == 2), 1).otherwise(F.col("level"))
    return toc.select(F.col("doc_id").alias("id"), level.alias("level"), (F.upper("title") if parsed else F.col("title")).alias("title"))


def _cells(spark: SparkSession, d: str, parsed: bool) -> DataFrame:
    """A table per order, a row per line; as parsed, flags are in small letters with blanks, and lines with a discount of 0.05 lack their second cell."""
    li = table(spark, d, "lineitem")
    cell = lambda col, text, head: F.struct(F.lit(col).alias("col"), text.alias("text"), head.alias("is_header"))
    flag = F.col("l_returnflag") if not parsed else F.when(F.col("l_tax") < 0.04, F.concat(F.lit(" "), "l_returnflag")).otherwise(F.lower("l_returnflag"))
    cells = F.array(cell(0, flag, F.col("l_linenumber") == 1), cell(1, F.col("l_linestatus"), F.col("l_linenumber") == (2 if parsed else 1)))
    lines = li.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").cast("int").alias("row"), F.explode(cells).alias("c"), "l_discount", "l_partkey", "l_suppkey")
    lines = lines.where(~(F.lit(parsed) & (F.col("c.col") == 1) & (F.col("l_discount") == 0.05)))
    return lines.select("id", (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("ord"), "row", "c.col", "c.text", "c.is_header")


def _boxes(spark: SparkSession, d: str, side: int) -> DataFrame:
    """Boxes of elements per page; the second side is shifted a little."""
    e = table(spark, d, "elements").where("bbox is not null and doc_id is not null and pos is not null").select("doc_id", "pos", F.coalesce("page_number", F.lit(0)).alias("page"), "bbox", F.lower(F.trim("element_type")).alias("class")).distinct()
    s = F.lit(side * 5.0)
    return e.select(F.concat_ws("/", F.col("doc_id").cast("string"), F.col("page").cast("string")).alias("id"), F.col("pos").cast("int").alias("ord"), F.coalesce("class", F.lit("none")).alias("class"), (F.col("bbox.x0") + s).alias("x0"), (F.col("bbox.y0") + s).alias("y0"), (F.col("bbox.x1") + s).alias("x1"), (F.col("bbox.y1") + s * 2).alias("y1"))


def _stored_sets(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "chunk_sets").select(raw_or_canonical_uuid(F.col("document_id")).alias("document_id"), (F.col("trust_score") > 0.5).alias("consent"))
    return s.where("document_id is not null")


def _latest(spark: SparkSession, d: str) -> DataFrame:
    return sync.latest_records(table(spark, d, "records"))


def _stored_headers(spark: SparkSession, d: str) -> DataFrame:
    """Stored sets of the chunk_sets table with labels by their strategy; those without a score can't be read."""
    s = table(spark, d, "chunk_sets").select(raw_or_canonical_uuid(F.col("document_id")).alias("document_id"), "chunk_strategy", "trust_score", "n_chunks").where("document_id is not null")
    s = s.groupBy("document_id").agg(F.max("chunk_strategy").alias("chunk_strategy"), F.max("trust_score").alias("score"), F.max("n_chunks").alias("total_chunks"))
    tax = F.col("score") > 0.5
    return s.select("document_id", F.when(tax, "Tax_Returns").alias("category"), F.when(~tax & (F.length("chunk_strategy") > 6), "lease").alias("document_type"), "total_chunks", F.col("score").isNotNull().alias("readable"))


def _listings(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Records updated in 2024 or later, and all of tax categories."""
    r = _latest(spark, d)
    return r.where(F.year("updated_at") >= 2024), r.where(sync.normal_label(F.col("category")).isin(*sync.TAX_CATEGORIES))


def _synced(spark: SparkSession, d: str) -> DataFrame:
    """A run over the listings; records deleted since are gone, and files that share their hash with an older version's changed."""
    updated, tax = _listings(spark, d)
    now = _latest(spark, d).where("deleted_at is null")
    loaded = table(spark, d, "records").select(raw_or_canonical_uuid(F.col("id")).alias("id"), "version_no", "sha256").where("id is not null").groupBy("id").agg(F.min_by("sha256", "version_no").alias("sha256"))
    return sync.sync_documents(updated, tax, _stored_sets(spark, d), now, loaded)


def _trees(spark: SparkSession, d: str) -> DataFrame:
    """The elements table as conversion trees, one JSON object per document."""
    e = el.clean_elements(table(spark, d, "elements"))
    label = F.when(F.col("type") == "title", "title").when(F.col("type") == "heading", "section_header").when(F.col("type").isin("list", "list_item"), "list_item").when(F.col("type") == "code", "code").when(F.col("type") == "formula", "formula").otherwise("text")
    bbox = F.struct(F.lit(1.0).alias("l"), F.lit(700.0).alias("t"), F.lit(9.0).alias("r"), F.lit(650.0).alias("b"), F.lit("BOTTOMLEFT").alias("coord_origin"))
    text = F.struct("pos", label.alias("label"), F.col("content").alias("text"), F.coalesce(F.nullif("category_depth", F.lit(0)), F.lit(1)).alias("level"), F.when(F.col("page_number") > 0, F.col("page_number")).alias("page"))
    g = e.groupBy("doc_id").agg(F.sort_array(F.collect_list(text)).alias("texts"))
    # each text becomes JSON by itself, so that a large document never stands as a whole tree beside its rows
    prov = lambda t: F.when(t["page"].isNotNull(), F.array(F.struct(t["page"].alias("page_no"), bbox.alias("bbox"))))
    item = lambda t: F.to_json(F.struct(t["pos"].alias("pos"), t["label"].alias("label"), t["text"].alias("text"), t["level"].alias("level"), prov(t).alias("prov")))
    refs = F.transform(F.sequence(F.lit(0), F.size("texts") - 1), lambda i: F.concat(F.lit('{"$ref":"#/texts/'), i.cast("string"), F.lit('"}')))
    page = F.struct(F.struct(F.lit(800.0).alias("height")).alias("size"))
    # distinct as numbers, which are hashed; structs would be compared all with all
    numbers = F.array_distinct(F.filter(F.col("texts.page"), lambda n: n.isNotNull()))
    pages = F.to_json(F.map_from_entries(F.transform(numbers, lambda n: F.struct(n.cast("string"), page))))
    head, tail = F.concat(F.lit('{"body":{"children":['), F.array_join(refs, ","), F.lit(']},"texts":[')), F.concat(F.lit('],"pages":'), pages, F.lit("}"))
    g = g.select("doc_id", "texts", head.alias("head"), tail.alias("tail"))
    items = F.transform("texts", lambda t, i: F.concat(F.when(i == 0, F.col("head")).otherwise(""), item(t), F.when(i == F.size("texts") - 1, F.col("tail")).otherwise("")))
    return g.select("doc_id", F.array_join(items, ",").alias("json"))


def _coco(spark: SparkSession, d: str) -> DataFrame:
    """The elements' boxes as annotations in COCO form, a file per document."""
    e = table(spark, d, "elements").where("doc_id is not null and pos is not null and bbox is not null").select("doc_id", "pos", F.lower(F.trim("element_type")).alias("type"), "bbox").distinct()
    kinds = ("title", "paragraph", "table", "heading")
    category = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, kinds)), F.coalesce("type", F.lit(""))), F.lit(0)), F.lit(99))
    a = F.struct(F.col("pos").cast("bigint").alias("id"), F.lit(1).cast("bigint").alias("image_id"), category.alias("category_id"), F.array("bbox.x0", "bbox.y0", F.col("bbox.x1") - F.col("bbox.x0"), F.col("bbox.y1") - F.col("bbox.y0")).alias("bbox"), F.lit(1.0).alias("area"))
    g = e.groupBy("doc_id").agg(F.sort_array(F.collect_list(a)).alias("annotations"))
    doc = F.col("doc_id").cast("string")
    split = F.concat(F.element_at(F.array(*map(F.lit, annotations.SPLITS)), (F.pmod("doc_id", F.lit(3)) + 1).cast("int")))
    names = F.array(*(F.struct(F.lit(i + 1).cast("bigint").alias("id"), F.lit(k).alias("name")) for i, k in enumerate(kinds)))
    # every file is a split of its own document, so ids may repeat between files
    shift = F.col("doc_id") * 1000
    moved = F.transform("annotations", lambda x: x.withField("image_id", x["image_id"] + shift))
    return g.select(split.alias("split"), F.array(F.struct((shift + 1).alias("id"), F.concat(doc, F.lit(".png")).alias("file_name"))).alias("images"), moved.alias("annotations"), names.alias("categories"))


def _annotations(spark: SparkSession, d: str) -> DataFrame:
    return annotations.coco_annotations(_coco(spark, d))


def _levelled(spark: SparkSession, d: str) -> DataFrame:
    """Elements with the level of headings, for trees."""
    e = el.clean_elements(table(spark, d, "elements")).withColumn("level", el.heading_levels(F.col("type"), F.nullif("category_depth", F.lit(0))))
    return e.select("doc_id", "pos", "type", "content", "page_number", "level", F.when(F.col("level").isNotNull(), F.col("content")).alias("heading"))


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.col("source").alias("source"), F.col("document_type").alias("format"), "n_chars")


def _failures(spark: SparkSession, d: str) -> DataFrame:
    """Events as failed results with error messages of all kinds."""
    e = table(spark, d, "events")
    k = F.pmod("event_id", F.lit(6))
    text = F.when(k == 0, F.concat(F.lit("Ground truth for "), "event_type")).when(k == 1, "file not found").when(k == 2, "bad LAYOUT").when(k == 3, "cannot Parse").when(k == 4, "Evaluation failed").otherwise(F.col("event_type"))
    return e.select(F.col("event_type").alias("dataset"), F.lit("p").alias("parser"), F.lit(False).alias("success"), text.alias("error"))


def _evaluated(spark: SparkSession, d: str) -> DataFrame:
    """Elements as an evaluator takes them, their boxes a little off; documents without any box are among them."""
    e = table(spark, d, "elements").where("doc_id is not null and pos is not null").select("doc_id", "pos", F.lower(F.trim("element_type")).alias("type"), "bbox").distinct()
    off = F.when(F.col("bbox").isNotNull(), F.struct(*((F.col(f"bbox.{k}") + 3.0).alias(k) for k in ("x0", "y0", "x1", "y1"))))
    return e.select(F.col("doc_id").cast("string").alias("doc_id"), "pos", "type", off.alias("bbox"))


def _path() -> Column:
    """Titles as file names with an ending."""
    ends = F.array(*map(F.lit, (".PDF", ".docx", ".doc", ".webm", ".m4a", ".xyz", "")))
    return F.concat(F.coalesce("title", F.lit("untitled")), F.element_at(ends, (F.pmod("doc_id", F.lit(7)) + 1).cast("int")))


def _url(source: Column) -> Column:
    return F.concat(F.lit("https://files.example/"), source, F.when(F.length(source) % 3 == 0, ".pdf").when(F.length(source) % 3 == 1, ".DOCX").otherwise("?x=.pdf"))


_T = {
    "elements_lines": lambda s, d: el.markdown_elements(table(s, d, "documents")),
    "elements_rich_markdown": lambda s, d: el.rich_markdown_elements(table(s, d, "documents")),
    "text_block_types": lambda s, d: el.lines_of(table(s, d, "documents")).select("doc_id", "pos", el.block_type(F.col("line"), (F.col("pos") % 20).cast("double")).alias("type")),
    "url_formats": lambda s, d: table(s, d, "documents").select("doc_id", el.url_format(_url(F.col("source"))).alias("format")),
    "file_formats": lambda s, d: table(s, d, "records").select("doc_id", "version_no", el.file_format(_path()).alias("format"), el.mime_type(_path()).alias("mime_type"), el.extension(_path()).alias("extension")).distinct(),
    "format_by_bytes": lambda s, d: table(s, d, "documents").select("doc_id", el.file_format(F.lit("x.bin"), F.concat(F.when(F.pmod("doc_id", F.lit(3)) == 0, F.lit("%PDF-")).when(F.pmod("doc_id", F.lit(3)) == 1, F.lit("<html>")).otherwise(F.lit("fLaC")), F.coalesce("text", F.lit(""))).cast("binary")).alias("format")),
    "corpus_sample": lambda s, d: files.corpus(table(s, d, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit(".pdf")).alias("path")), 100, "sequential"),
    "corpus_stratified": lambda s, d: files.corpus(table(s, d, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit(".pdf")).alias("path"), F.coalesce("source", F.lit("")).alias("source")), 100, "stratified", category="source").groupBy("source").agg(F.count(F.lit(1)).alias("n")),
    "canonical_times": lambda s, d: table(s, d, "records").select("doc_id", "version_no", files.canonical_date(F.when(F.pmod("doc_id", F.lit(4)) == 0, F.date_format("document_date", "yyyy-M-d")).otherwise(F.col("document_date").cast("string"))).alias("document_date")).distinct(),
    "docling_elements": lambda s, d: docling.docling_elements(_trees(s, d)).select("doc_id", "pos", "type", "content", "page_number", "y0", "y1", "category_depth", "section_title"),
    "coco_annotations": lambda s, d: _r(_annotations(s, d).select("document_id", "annotation_id", "category", "x0", "y0", "x1", "y1")),
    "true_order": lambda s, d: evaluation.true_order(_annotations(s, d)).select("id", F.col("ord.n").alias("n"), F.round("ord.by", 6).alias("by"), "item"),
    "layout_evaluation": lambda s, d: _r(evaluation.LayoutEvaluator().evaluate(_evaluated(s, d), _annotations(s, d)), 4),
    "table_of_contents": lambda s, d: el.table_of_contents(table(s, d, "elements")),
    "parent_headings": lambda s, d: el.parents(table(s, d, "elements")),
    "estimated_confidence": lambda s, d: el.estimated_confidence(table(s, d, "elements")),
    "page_counts": lambda s, d: el.page_counts(table(s, d, "elements")),
    "section_sizes": lambda s, d: chunking.section_sizes(table(s, d, "elements")),
    "combined_sections": lambda s, d: chunking.combined_sections(table(s, d, "elements")),
    "by_title_chunks": lambda s, d: chunking.by_title_chunks(table(s, d, "elements")),
    "by_title_pages": lambda s, d: chunking.by_title_chunks(table(s, d, "elements"), respect_pages=True),
    "tree_chunks": lambda s, d: chunking.tree_chunks(_levelled(s, d)).withColumn("section_path", F.array_join("section_path", " > ")),
    "heading_paths": lambda s, d: el.heading_paths(_levelled(s, d)).select("doc_id", "pos", F.array_join("path", " > ").alias("path")),
    "token_chunks": lambda s, d: chunking.token_chunks(table(s, d, "elements"), 200, 40),
    "sentence_split": lambda s, d: chunking.split_sentences(table(s, d, "documents")),
    "chunk_statistics": lambda s, d: chunking.chunk_statistics(table(s, d, "chunks")),
    "exact_copies": lambda s, d: sync.exact_copies(table(s, d, "documents")),
    "normalized_text": lambda s, d: table(s, d, "documents").select("doc_id", F.length(scores.normalized(F.col("text"))).alias("n"), F.md5(scores.normalized(F.regexp_replace("text", "[^\\x00-\\x7f]", "?"))).alias("digest")),
    "cer": lambda s, d: _r(_ascii(_titles(s, d)).select("id", scores.cer(F.col("pred"), F.col("ref")).alias("cer"))),
    "bleu": lambda s, d: _r(scores.bleu(_titles(s, d))),
    "chrf": lambda s, d: _r(scores.chrf(_titles(s, d))),
    "section_f1": lambda s, d: _r(scores.section_f1(_headings(s, d, True), _headings(s, d, False))),
    "reading_order_f1": lambda s, d: _r(scores.order_f1(_orders(s, d, "line"), _orders(s, d, "date"))),
    "kendall_tau": lambda s, d: _r(scores.kendall_tau(_orders(s, d, "line"), _orders(s, d, "date"))),
    "table_scores": lambda s, d: _r(scores.table_scores(_cells(s, d, True), _cells(s, d, False))),
    "best_overlaps": lambda s, d: _r(scores.best_overlaps(_boxes(s, d, 0), _boxes(s, d, 1))),
    "layout_map": lambda s, d: _r(scores.layout_map(_boxes(s, d, 0), _boxes(s, d, 1))),
    "metric_summary": lambda s, d: _r(benchmark.metric_summary(_metrics(s, d))),
    "metric_rollup": lambda s, d: _r(benchmark.metric_rollup(_metrics(s, d))),
    "metric_table": lambda s, d: _r(export.metric_table(benchmark.metric_summary(_metrics(s, d)), ["quality", "time_error"])),
    "run_statistics": lambda s, d: benchmark.run_statistics(_runs(s, d)),
    "dataset_profile": lambda s, d: benchmark.dataset_profile(sync.latest_records(table(s, d, "records")), "file_size", "mime_type"),
    "dataset_hash": lambda s, d: benchmark.dataset_hash(table(s, d, "documents"), "doc_id"),
    "baseline_compare": lambda s, d: _r(benchmark.compare_baselines(_runs(s, d).where("version = 1"), _runs(s, d).where("version = 2"))),
    "baseline_summary": lambda s, d: benchmark.comparison_summary(benchmark.compare_baselines(_runs(s, d).where("version = 1"), _runs(s, d).where("version = 2"))),
    "recommendations": lambda s, d: _r(benchmark.recommendations(_results(s, d))),
    "recommendations_speed": lambda s, d: _r(benchmark.recommendations(_results(s, d), "speed")),
    "recommendations_accuracy": lambda s, d: _r(benchmark.recommendations(_results(s, d), "accuracy")),
    "recommended": lambda s, d: _r(benchmark.recommended(_results(s, d)).select("parser", "config", "score", "confidence", "rationale")),
    "tradeoffs": lambda s, d: _r(benchmark.tradeoffs(_results(s, d))),
    "compare_results": lambda s, d: _r(benchmark.compare_results(_results(s, d), _results(s, d).withColumn("time", F.col("time") * 2).where("config <> 'F'"))),
    "significance": lambda s, d: _r(benchmark.significance(benchmark.compare_baselines(_runs(s, d).where("version = 1"), _runs(s, d).where("version = 2"))), 4),
    "run_overview": lambda s, d: _r(benchmark.run_overview(_runs(s, d).select("parser", "success"), 7200.0)),
    "overall_quality": lambda s, d: table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(benchmark.overall_quality("l_discount", "l_tax"), 6).alias("quality")),
    "dataset_languages": lambda s, d: benchmark.dataset_languages(table(s, d, "documents")),
    "value_profile": lambda s, d: _r(benchmark.value_profile(_latest(s, d).withColumn("mime_type", F.coalesce("mime_type", F.lit("unknown"))), ["mime_type"], "file_size")),
    "compatible_baselines": lambda s, d: benchmark.compatible_baselines(table(s, d, "customer").select("c_custkey", F.when(F.col("c_nationkey") > 12, "gpu").alias("gpu_model"), F.col("c_nationkey").cast("int").alias("cpu_cores"), F.col("c_custkey").alias("total_documents")), True, 16, 500, 0.2).select("c_custkey"),
    "failure_report": lambda s, d: benchmark.failure_report(_failures(s, d)),
    "best_configs": lambda s, d: benchmark.best_configurations(_results(s, d)),
    "target_comparison": lambda s, d: _r(benchmark.target_comparison(benchmark.metric_summary(_metrics(s, d)).select("dataset", "parser", "metric", F.round("mean", 6).alias("mean")), s.createDataFrame([("quality", 0.05), ("time_error", 26.0)], "metric string, target double"))),
    "failure_categories": lambda s, d: _failures(s, d).groupBy(benchmark.failure_category(F.col("error")).alias("category")).agg(F.count(F.lit(1)).alias("n")),
    "first_success": lambda s, d: benchmark.first_success(table(s, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("int").alias("priority"), F.col("l_returnflag").alias("parser"), (F.col("l_quantity") > 30).alias("success"))),
    "image_resolution": lambda s, d: _r(benchmark.image_resolution(table(s, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_partkey").alias("px_w"), F.col("l_suppkey").alias("px_h"), (F.col("l_quantity") * 10).cast("double").alias("pt_w"), (F.col("l_quantity") * 12).cast("double").alias("pt_h")))),
    "scan_class": lambda s, d: benchmark.scan_class(table(s, d, "elements").select("doc_id", "pos", "page_number", "content").distinct().where("page_number > 0").groupBy("doc_id", F.col("page_number").alias("page")).agg(F.sum(F.length("content")).alias("n_chars"))),
    "requests_in_window": lambda s, d: benchmark.requests_in_window(table(s, d, "events"), 3600),
    "latest_records": lambda s, d: sync.latest_records(table(s, d, "records")).select("id", "version_no", "doc_id", "title"),
    "consent_actions": lambda s, d: sync.consent_actions(_latest(s, d), _stored_sets(s, d)),
    "tax_returns": lambda s, d: _latest(s, d).select("id", sync.is_tax_return(F.col("category"), F.col("document_type")).alias("is_tax_return")),
    "merged_listings": lambda s, d: sync.merged_listings(*_listings(s, d)).select("id", "version_no", "in_updated"),
    "chunk_set_headers": lambda s, d: sync.chunk_sets(_latest(s, d), table(s, d, "chunks"))[0].select("document_id", "trace_id", "total_chunks", "consent_on_file", "error"),
    "chunk_set_entries": lambda s, d: sync.chunk_sets(_latest(s, d), table(s, d, "chunks"))[1].select("document_id", "chunk_index", "chunk_id", "start_page", "end_page", "token_count", "is_confidential"),
    "chunk_set_files": lambda s, d: sync.set_files(*sync.chunk_sets(_latest(s, d), table(s, d, "chunks"))),
    "withdrawn_sets": lambda s, d: sync.withdrawn_sets(_latest(s, d)).select("document_id", "trace_id", "is_confidential", "consent_on_file", "total_chunks"),
    "stored_consent": lambda s, d: sync.stored_consent(*sync.chunk_sets(_latest(s, d), table(s, d, "chunks"))),
    "stored_tax_ids": lambda s, d: sync.stored_tax_ids(_stored_headers(s, d)),
    "withdraw_deleted": lambda s, d: sync.withdraw_deleted(_stored_headers(s, d), _latest(s, d).where("deleted_at is not null").select(F.col("id").alias("document_id"))),
    "sync_documents": lambda s, d: _synced(s, d),
    "run_report": lambda s, d: sync.run_report(_synced(s, d), _listings(s, d)[0]).withColumn("newest_updated_at", F.date_format("newest_updated_at", "yyyy-MM-dd HH:mm:ss")),
    "sync_report": lambda s, d: sync.sync_report(sync.consent_actions(sync.latest_records(table(s, d, "records")), _stored_sets(s, d))),
    "unreached_sets": lambda s, d: sync.unreached_sets(table(s, d, "chunk_sets"), table(s, d, "records")),
    "chunk_ids": lambda s, d: sync.chunk_ids(table(s, d, "chunks")),
    "export_markdown": lambda s, d: export.to_markdown(table(s, d, "elements")).select("doc_id", F.md5("markdown").alias("digest")),
    "front_matter": lambda s, d: export.front_matter(_documents(s, d), ["source", "format", "n_chars"]),
    "documents_json": lambda s, d: export.documents_json(_latest(s, d).select("doc_id", "title", "category"), table(s, d, "elements"), table(s, d, "chunks")),
    "export_text": lambda s, d: export.to_text(table(s, d, "elements")).select("doc_id", F.md5("text").alias("digest")),
    "export_json": lambda s, d: export.to_json_rows(table(s, d, "elements")),
}
QUERIES = dict(_T)

_WS = "[\\s\\x{85}\\p{Z}]"
_STRIP = lambda c: f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"
_EL = f"e as (select distinct doc_id, pos, coalesce(lower(trim(element_type)), 'uncategorized_text') type, content, page_number, category_depth from elements where {_STRIP('content')} <> '' and doc_id is not null and pos is not null)"
_LINES = f"l as (select doc_id, cast(i - 1 as int) pos, {_STRIP('x[i]')} line from (select doc_id, string_split(text, chr(10)) x from documents where text is not null), unnest(range(1, len(x) + 1)) t(i) where {_STRIP('x[i]')} <> '')"
_U = lambda c: f"nullif(regexp_replace(regexp_replace(lower({c}), '^\\s*urn:uuid:', ''), '[^0-9a-f]', '', 'g'), '')"
_UU = lambda c: f"(case when {_U(c)} is null or {_U(c)} = repeat('0', 32) then null else substr({_U(c)},1,8)||'-'||substr({_U(c)},9,4)||'-'||substr({_U(c)},13,4)||'-'||substr({_U(c)},17,4)||'-'||substr({_U(c)},21) end)"
_LATEST = f"r as (select * exclude (rn) from (select * replace ({_UU('id')} as id), row_number() over (partition by {_UU('id')} order by updated_at desc, version_no desc) rn from records) where rn = 1 and id is not null)"
_RUN = "runs as (select l_returnflag parser, l_linestatus config, year(l_shipdate) % 2 + 1 as \"version\", cast(l_quantity as double) total_time, cast(l_discount as double) quality, cast(l_tax as double) memory, l_linenumber <> 7 success from lineitem)"
_MET = _RUN + ", m as (select config dataset, parser, success, 'time_error' metric, total_time as \"value\" from runs union all select config, parser, success, 'quality', quality from runs)"
_SUMM = "s as (select dataset, parser, metric, avg(value) filter (success) mean, stddev_pop(value) filter (success) std, min(value) filter (success) least, max(value) filter (success) most, count(*) n, count(*) filter (success) / count(*) success_rate from m group by all)"
_HEAD = "type in ('title', 'heading')"
_SECT = f"{_EL}, s as (select *, cast(count(*) filter ({_HEAD}) over (partition by doc_id order by pos) as bigint) section from e)"
_WORDS = lambda c: f"len(list_filter(string_split_regex({c}, '{_WS}+'), lambda x: x <> ''))"
_SIZES = f"{_SECT}, z as (select doc_id, section, count(*) n_elements, cast(sum({_WORDS('content')}) as bigint) n_words, cast(sum(length(content)) + 2 * (count(*) - 1) as bigint) n_chars from s group by all)"
_PAIRS = f"{_LATEST}, p as (select id, regexp_replace(lower(title), '[^ -~]', '?', 'g') pred, regexp_replace(lower(concat_ws(' ', category, document_type, cast(year(document_date) as varchar))), '[^ -~]', '?', 'g') ref from r where title is not null)"
_CMP = _RUN + ", g as (select parser, config, version v, count(*) n, avg(total_time) m, var_samp(total_time) s from runs group by all), c as (select a.parser, a.config, a.m mean_1, b.m mean_2, case when a.m > 0 then (b.m - a.m) / a.m * 100 else 0 end change, (a.m - b.m) / sqrt(((a.n - 1) * a.s + (b.n - 1) * b.s) / (a.n + b.n - 2) * (1.0 / a.n + 1.0 / b.n)) t, a.n + b.n - 2 df from g a join g b using (parser, config) where a.v = 1 and b.v = 2)"
_RES = _RUN + ", res as (select parser, config, round(avg(total_time), 6) as \"time\", round(avg(quality), 6) quality, round(avg(memory), 6) memory, count(*) filter (success) / count(*) rate, count(*) n from runs group by all)"
_LABEL = "trim(regexp_replace(lower(translate({0}, '_-', '  ')), '\\s+', ' ', 'g'))"
_TAX = f"(coalesce({_LABEL.format('category')} in ('tax return', 'tax returns'), false) or coalesce({_LABEL.format('document_type')} in ('tax return', 'tax election'), false))"
_CONS = f"{_LATEST}, st as (select {_UU('document_id')} id, bool_and(coalesce(trust_score > 0.5, false)) stored from chunk_sets where {_UU('document_id')} is not null group by 1), act as (select r.id, case when not {_TAX} then 'not_required' when consent_on_file is not distinct from true and stored is not distinct from true then 'unchanged' when consent_on_file is not distinct from true then 'chunk' when stored is null then 'skip' else 'withdrawn' end \"action\" from r left join st on r.id = st.id)"
_ORD = "a as (select l_orderkey id, cast(l_linenumber as bigint) ord, l_partkey item from lineitem), b as (select l_orderkey id, cast(epoch(l_shipdate) as bigint) * 8 + l_linenumber ord, l_partkey item from lineitem)"
_MD = "case when type in ('title','heading') then repeat('#', least(coalesce(nullif(category_depth, 0), 1), 6)::int) || ' ' || content when type = 'list_item' then '- ' || content when type = 'table' then chr(10) || content when type in ('code_snippet', 'code') then '```' || chr(10) || content || chr(10) || '```' when type = 'formula' then '$$' || content || '$$' when type = 'image' then '![' || content || '](image)' when type in ('figure_caption', 'caption') then '*' || content || '*' else content end"
_BOX = "b as (select distinct doc_id, pos, coalesce(page_number, 0) page, bbox from elements where bbox is not null and doc_id is not null and pos is not null), p as (select doc_id || '/' || page id, pos, bbox.x0 x0, bbox.y0 y0, bbox.x1 x1, bbox.y1 y1 from b), t as (select id, pos, x0 + 5 x0, y0 + 5 y0, x1 + 5 x1, y1 + 10 y1 from p)"

ORACLES = {
    "elements_lines": f"with {_LINES} select doc_id, pos, case when starts_with(line, '# ') then 'title' when starts_with(line, '## ') or starts_with(line, '### ') then 'heading' else 'paragraph' end as \"type\", {_STRIP(chr(34) + 'l' + chr(34) + '.c')} as \"content\" from (select *, regexp_replace(line, '^#{{1,3}} ', '') c from l) l",
    "text_block_types": f"with {_LINES} select doc_id, pos, case when pos % 20 > 16 then 'title' when pos % 20 > 14 then 'heading' when upper(line) = line and lower(line) <> line and length(line) < 100 then 'heading' else 'paragraph' end as \"type\" from l",
    "url_formats": "select doc_id, case when source is null then 'unknown' when length(source) % 3 = 0 then 'pdf' when length(source) % 3 = 1 then 'docx' else 'pdf' end as \"format\" from documents",
    "table_of_contents": f"with {_EL} select distinct doc_id, pos, cast(coalesce(nullif(category_depth, 0), case when type = 'title' then 1 else 2 end) as int) as \"level\", substr(content, 1, 100) title, coalesce(page_number, 0) page from e where {_HEAD}",
    "parent_headings": f"with {_EL} select doc_id, pos, type as \"type\", case when type = 'title' then 1 when type = 'heading' then 2 end as \"depth\", case when type in ('paragraph','narrative_text','table','formula','list','list_item') then max(case when {_HEAD} then pos end) over (partition by doc_id order by pos) end parent_pos from e",
    "estimated_confidence": f"with {_EL}, x as (select *, length({_STRIP('content')}) n from e) select doc_id, pos, cast(case when type in ('formula','title') then case when n < 5 then .66 when n > 100 then 1.0 else .95 end when type in ('table','heading') then case when n < 5 then .63 when n > 100 then .95 else .9 end when type in ('paragraph','narrative_text','list') then case when n < 5 then .59 when n > 100 then .9 else .85 end else case when n < 5 then .56 when n > 100 then .85 else .8 end end as double) \"estimate\" from x",
    "page_counts": "select doc_id, cast(coalesce(max(page_number), 0) as int) pages from elements where doc_id is not null group by 1",
    "section_sizes": f"with {_SIZES} select * from z",
    "combined_sections": f"with {_SIZES}, y as (select *, n_chars < 200 small, coalesce(lag(n_chars < 200) over (partition by doc_id order by section), false) before from z) select doc_id, section, cast(sum(case when small and before then 0 else 1 end) over (partition by doc_id order by section) as bigint) combined from y",
    "sentence_split": f"select doc_id, cast(i - 1 as int) sentence_no, case when s like '%.' then s else s || '.' end sentence from (select doc_id, i, {_STRIP('x[i]')} s from (select doc_id, string_split(text, '. ') x from documents where text is not null), unnest(range(1, len(x) + 1)) t(i)) where s <> ''",
    "chunk_statistics": f"select chunk_type, count(*) n_chunks, cast(sum(n) as bigint) n_tokens, round(avg(n), 6) mean_tokens from (select distinct chunk_id, coalesce(lower(trim(chunk_type)), 'unknown') chunk_type, content, {_WORDS('content')} n from chunks) group by 1",
    "exact_copies": "select doc_id, case when text is null then doc_id else min(doc_id) over (partition by sha256(text)) end first_doc_id, case when text is null then false else min(doc_id) over (partition by sha256(text)) <> doc_id end is_duplicate from documents",
    "cer": f"with {_PAIRS} select id, round(case when length(ref) = 0 then case when length(pred) > 0 then 1.0 else 0.0 end else levenshtein(pred, ref) / length(ref) end, 6) cer from p",
    "reading_order_f1": f"with {_ORD}, p as (select id, item, row_number() over (partition by id order by ord, item) k from a), q as (select id, item, row_number() over (partition by id order by ord, item) k from b) select id, round(count(*) filter (p.item = q.item) / count(*), 6) f1 from p join q using (id, k) group by 1",
    "best_overlaps": f"with {_BOX}, j as (select p.id, p.pos ord, t.pos match_ord, greatest(least(p.x1, t.x1) - greatest(p.x0, t.x0), 0) * greatest(least(p.y1, t.y1) - greatest(p.y0, t.y0), 0) i, (p.x1 - p.x0) * (p.y1 - p.y0) + (t.x1 - t.x0) * (t.y1 - t.y0) u from p join t using (id) where p.x0 < t.x1 and t.x0 < p.x1 and p.y0 < t.y1 and t.y0 < p.y1), k as (select id, ord, match_ord, round(i / (u - i), 9) iou from j where u - i <> 0), b2 as (select *, row_number() over (partition by id, ord order by iou desc, match_ord) rn from k where iou > 0.3) select id, ord, match_ord, round(iou, 6) iou from b2 where rn = 1",
    "metric_summary": f"with {_MET}, {_SUMM} select dataset, parser, metric, round(mean, 6) mean, round(std, 6) std, round(least, 6) \"least\", round(most, 6) most, n, round(success_rate, 6) success_rate from s",
    "metric_rollup": f"with {_MET} select dataset, parser, round(avg(value) filter (success), 6) mean, count(*) n, count(*) filter (not success) n_failed, cast(grouping(dataset, parser) as bigint) as \"level\" from m group by rollup (dataset, parser)",
    "metric_table": f"with {_MET}, {_SUMM} select dataset, parser, round(max(mean) filter (metric = 'quality'), 6) mean_quality, round(max(std) filter (metric = 'quality'), 6) std_quality, round(max(mean) filter (metric = 'time_error'), 6) mean_time_error, round(max(std) filter (metric = 'time_error'), 6) std_time_error from s group by 1, 2",
    "run_statistics": f"with {_RUN}, k as (select parser, config, list_sort(list(total_time)) v, avg(total_time) a, count(*) n from runs where total_time is not null group by all) select parser, config, n, round(a, 3) mean, v[cast(floor(n / 2) as int) + 1] median, v[cast(floor(n * 0.95) as int) + 1] p95 from k",
    "dataset_profile": f"with {_LATEST} select coalesce(mime_type, 'unknown') kind, count(*) n, cast(sum(file_size) as bigint) bytes, count(*) filter (file_size / 1048576.0 < 1) small, count(*) filter (file_size / 1048576.0 >= 1 and file_size / 1048576.0 < 10) medium, count(*) filter (file_size / 1048576.0 >= 10) large from r group by 1",
    "dataset_hash": "select substr(sha256((select count(*) from documents) || ':' || string_agg(i, ':' order by i)), 1, 16) dataset_hash from (select cast(doc_id as varchar) i from documents order by 1 limit 100)",
    "baseline_compare": f"with {_CMP} select parser, config, round(mean_1, 6) mean_1, round(mean_2, 6) mean_2, round(change, 6) change, round(t, 6) t, df from c",
    "baseline_summary": f"with {_CMP} select count(*) filter (change < 0) improved, count(*) filter (change > 0) regressed, round(avg(change), 2) mean_change from c",
    "target_comparison": f"with {_MET}, {_SUMM}, t as (select * from (values ('quality', 0.05), ('time_error', 26.0)) x(metric, target)), d as (select dataset, parser, metric, round(mean, 6) mean, cast(target as double) target, case when metric like '%error%' then target - round(mean, 6) else round(mean, 6) - target end delta from s join t using (metric)) select dataset, parser, metric, mean, target, round(delta, 6) delta, delta >= 0 meets from d",
    "first_success": "select l_orderkey doc_id, arg_min(l_returnflag, l_linenumber * 256 + ascii(l_returnflag)) filter (l_quantity > 30) parser, cast(min(l_linenumber) filter (l_quantity > 30) as int) priority from lineitem group by 1",
    "image_resolution": "with x as (select l_orderkey doc_id, l_partkey * 72.0 / (l_quantity * 10) w, l_suppkey * 72.0 / (l_quantity * 12) h from lineitem) select doc_id, round(min(least(w, h)), 6) \"least\", round(avg((w + h) / 2), 6) mean, round(max(greatest(w, h)), 6) most, count(*) filter (least(w, h) < 150) n_low, min(least(w, h)) < 150 needs_upscaling from x group by 1",
    "scan_class": "with p as (select doc_id, page_number page, sum(length(content)) n from (select distinct doc_id, pos, page_number, content from elements) where page_number > 0 group by all), m as (select doc_id, avg(n) a from p where page <= 3 group by 1) select doc_id, case when a > 500 then 'digital' when a > 100 then 'hybrid' else 'scanned' end kind, cast(case when a > 500 then .3 when a > 100 then .6 else .9 end as double) complexity from m",
    "requests_in_window": "select event_id, user_id, n_requests, n_requests > 20 limited from (select event_id, user_id, count(*) over (partition by user_id order by ts range between interval 3600 seconds preceding and current row) n_requests from events where ts is not null)",
    "latest_records": f"with {_LATEST} select id, version_no, doc_id, title from r",
    "consent_actions": f"with {_CONS} select * from act",
    "sync_report": f"with {_CONS} select \"action\", count(*) n from act group by 1",
    "unreached_sets": f"select distinct {_UU('document_id')} document_id from chunk_sets where {_UU('document_id')} is not null and {_UU('document_id')} not in (select {_UU('id')} from records where {_UU('id')} is not null)",
}

_UUID5 = lambda name: "(select lower(substr(h,1,8)||'-'||substr(h,9,4)||'-5'||substr(h,14,3)||'-'||substr('89ab', (strpos('0123456789abcdef', substr(h,17,1)) - 1) % 4 + 1, 1)||substr(h,18,3)||'-'||substr(h,21,12)) from (select sha1(unhex('" + sync.ID_NAMESPACE + f"') || encode({name})) h))"
_CHUNKS = "c as (select distinct doc_id, chunk_index, content, start_page, end_page from chunks where doc_id is not null and chunk_index is not null)"
_BADPAGE = "(start_page is null or end_page is null or start_page < 1 or end_page < start_page)"
_BLANK = lambda c: f"coalesce({_STRIP(c)}, '') = ''"
_SETS = (
    f"{_LATEST}, {_CHUNKS}, pg as (select doc_id, count(*) n, min(case when {_BADPAGE} then chunk_index end) bad from c group by 1), "
    f"hd as (select r.id document_id, r.doc_id, coalesce(consent_on_file, false) consent_on_file, is_confidential, n, case when not regexp_matches(r.id, '^[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}$') then 'document_id must be a UUID' "
    f"when {_BLANK('entity_id')} then 'Document field entity_id must be a non-empty string' when {_BLANK('sha256')} then 'Document field sha256 must be a non-empty string' when is_confidential is null then 'Document field is_confidential must be a boolean' "
    f"when {_TAX} and consent_on_file is distinct from true then 'tax return without consent on file' when bad is not null then 'Chunk ' || bad || ' has no valid page range' end error from r left join pg on r.doc_id = pg.doc_id)"
)
_HS = f"hs as (select {_UU('document_id')} document_id, max(chunk_strategy) st, max(trust_score) score, max(n_chunks) total_chunks from chunk_sets where {_UU('document_id')} is not null group by 1), sh as (select document_id, case when score > 0.5 then 'Tax_Returns' end category, case when score <= 0.5 and length(st) > 6 then 'lease' end document_type, total_chunks, score is not null readable from hs)"
_LISTS = f"{_LATEST}, up as (select * from r where year(updated_at) >= 2024), tx as (select * from r where {_LABEL.format('category')} in ('tax return', 'tax returns')), ml as (select *, true in_updated from up union all select *, false from tx where id not in (select id from up))"
_SHA = lambda c: f"(select case when length(k) = 64 and k <> repeat('0', 64) and k <> 'e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855' then k end from (select regexp_replace(regexp_replace(lower(trim({c})), '^sha-?256:', ''), '[^0-9a-f]', '', 'g') k))"
_ACT = f"case when not {_TAX} then 'not_required' when consent_on_file is not distinct from true and stored is not distinct from true then 'unchanged' when consent_on_file is not distinct from true then 'chunk' when stored is null then 'skip' else 'withdrawn' end"
_SYNC = (
    f"{_LISTS}, st as (select {_UU('document_id')} id, bool_and(coalesce(trust_score > 0.5, false)) stored from chunk_sets where {_UU('document_id')} is not null group by 1), "
    f"act as (select ml.*, {_ACT} a from ml left join st using (id)), fi as (select {_UU('id')} id, arg_min(coalesce(sha256, ''), version_no) fs from records where {_UU('id')} is not null group by 1), "
    f"j as (select act.id, a, in_updated, act.updated_at, n.id is not null there, n.updated_at now_at, {_SHA('n.sha256')} ns, {_SHA('fs')} fs, {_TAX.replace('category', 'act.category').replace('document_type', 'act.document_type')} tax from act left join (select * from r where deleted_at is null) n using (id) left join fi using (id)), "
    "o as (select id, case when a in ('withdrawn', 'skip') then case a when 'skip' then 'skipped' else a end when not in_updated and a <> 'chunk' then 'unchanged' when not there then case when tax then 'withdrawn' else 'skipped' end when now_at <> updated_at or ns <> fs then 'failed' else 'chunked' end outcome, "
    "case when now_at <> updated_at then 'the record changed while the file was converted; it will be retried next run' when ns <> fs then 'the file changed after its record was read; it will be retried next run' end why from j)"
)
_LEVEL = "case when type = 'title' then 0 when type = 'heading' then coalesce(nullif(category_depth, 0), 1) end"
_PATHS = (
    f"{_EL}, lv as (select doc_id, pos, content, greatest(0, least(9, {_LEVEL})) lev, {_LEVEL} is not null hd from e), hh as (select * from lv where hd), "
    "op as (select i.doc_id, i.pos, h.pos hpos, h.lev, h.content from lv i join hh h on h.doc_id = i.doc_id and h.pos <= i.pos where not exists (select 1 from hh x where x.doc_id = i.doc_id and x.pos > h.pos and x.pos <= i.pos and x.lev <= h.lev)), "
    "pa as (select lv.doc_id, lv.pos, coalesce(string_agg(op.content, ' > ' order by op.lev), '') path from lv left join op using (doc_id, pos) group by all)"
)
_FAIL = "fe as (select event_type dataset, case event_id % 6 when 0 then 'Ground truth for ' || event_type when 1 then 'file not found' when 2 then 'bad LAYOUT' when 3 then 'cannot Parse' when 4 then 'Evaluation failed' else event_type end msg from events), fc as (select dataset, case when msg is null then 'Unknown error' when contains(msg, 'Ground truth') or contains(msg, 'not found') then 'Missing ground truth' when contains(lower(msg), 'layout') then 'Layout detection error' when contains(lower(msg), 'parsing') or contains(lower(msg), 'parse') then 'Parsing error' when contains(lower(msg), 'evaluation') then 'Evaluation error' else substr(msg, 1, 60) end category from fe)"
_RSC = f"{_RES}, o as (select *, parser || config ord from res)"
_SCORED = "select parser, config, round({0}, 6) score, round(rate * least(1.0, n / 100), 2) confidence from o"
_COMB = f"{_SIZES}, y as (select *, n_chars < 200 small, coalesce(lag(n_chars < 200) over (partition by doc_id order by section), false) before from z), cb as (select doc_id, section, sum(case when small and before then 0 else 1 end) over (partition by doc_id order by section) combined from y), se as (select s.*, cb.combined, {_WORDS('content')} n, coalesce(page_number, 0) page, row_number() over (partition by s.doc_id, combined order by pos) k from s join cb using (doc_id, section) where type <> 'table'), st as (select s.*, cb.combined from s join cb using (doc_id, section) where type = 'table')"
_PACK = lambda turn: (
    f"with recursive {_COMB}, "
    "p as (select doc_id, combined, k, pos, n cur, 0 g, case when page <> 0 then page else 0 end page, n > 120 shut from se where k = 1 "
    f"union all select q.doc_id, q.combined, q.k, q.pos, case when p.shut or p.cur + q.n > 120 {turn} then q.n else p.cur + q.n end, p.g + case when p.shut or p.cur + q.n > 120 {turn} then 1 else 0 end, case when q.page <> 0 then q.page else p.page end, q.n > 120 from p join se q on q.doc_id = p.doc_id and q.combined = p.combined and q.k = p.k + 1), "
    f"x as (select se.doc_id, se.combined, p.g, min(se.pos) pos, 'text' ct, string_agg(content, chr(10) || chr(10) order by se.pos) content, min(page_number) start_page, max(page_number) end_page, arg_min(content, se.pos) filter ({_HEAD}) section_title from se join p using (doc_id, combined, k) group by all "
    "union all select doc_id, combined, 1 << 30, pos, 'table', content, page_number, page_number, null from st) "
    f"select doc_id, cast(row_number() over (partition by doc_id order by combined, g, pos) - 1 as int) chunk_index, cast(count(*) over (partition by doc_id) as int) total_chunks, ct chunk_type, section_title, start_page, end_page, cast({_WORDS('content')} as int) token_count, content from x"
)
_TURN = "or (p.page <> 0 and q.page <> 0 and p.page <> q.page)"
_ENDS = "coalesce(title, 'untitled') || (['.PDF', '.docx', '.doc', '.webm', '.m4a', '.xyz', ''])[doc_id % 7 + 1]"
_EXT = f"regexp_extract(lower({_ENDS}), '[^/](\\.[^./]+)$', 1)"
_KINDS = "case {0} when '.pdf' then 'pdf' when '.docx' then 'docx' when '.doc' then 'docx' when '.html' then 'html' when '.htm' then 'html' when '.mp4' then 'video' when '.avi' then 'video' when '.mov' then 'video' when '.mkv' then 'video' when '.webm' then 'video' when '.mp3' then 'audio' when '.wav' then 'audio' when '.ogg' then 'audio' when '.m4a' then 'audio' when '.flac' then 'audio' else 'unknown' end"
_ANN = "b as (select distinct doc_id, pos, lower(trim(element_type)) type, bbox from elements where bbox is not null and doc_id is not null and pos is not null), an as (select cast(doc_id as varchar) document_id, row_number() over (partition by doc_id order by pos, ty) - 1 ord, cast(pos as varchar) annotation_id, case when type in ('title', 'paragraph', 'table', 'heading') then type else 'unknown' end category, bbox.x0 x0, bbox.y0 y0, bbox.x0 + (bbox.x1 - bbox.x0) x1, bbox.y0 + (bbox.y1 - bbox.y0) y1 from (select *, coalesce(type, '') ty from b))"

ORACLES |= {
    "normalized_text": "select doc_id, cast(length(n) as int) n, md5(trim(regexp_replace(lower(regexp_replace(text, '[^\\x00-\\x7f]', '?', 'g')), '[\\s\\x0b]+', ' ', 'g'))) digest from (select *, trim(regexp_replace(lower(text), '[\\s\\x0b\\x85\\p{Z}]+', ' ', 'g')) n from documents)",
    "kendall_tau": f"with {_ORD}, x as (select id, item, max(ord) x from a group by all), y as (select id, item, max(ord) y from b group by all), j as (select * from x join y using (id, item)), t as (select p.id, avg(sign(p.x - q.x) * sign(p.y - q.y)) tau from j p join j q on p.id = q.id and p.item < q.item group by 1) select id, round(coalesce(tau, 0), 6) tau from (select distinct id from j) left join t using (id)",
    "recommendations": f"with {_RSC} " + _SCORED.format("sqrt(1 / (time + 0.1) * coalesce(quality, 0.5))"),
    "recommendations_speed": f"with {_RSC} " + _SCORED.format("1 / (time + 0.1)"),
    "recommendations_accuracy": f"with {_RSC} " + _SCORED.format("coalesce(quality, 0.5)"),
    "recommended": f"with {_RSC} select parser, config, round(sqrt(1 / (time + 0.1) * coalesce(quality, 0.5)), 6) score, round(rate * least(1.0, n / 100), 2) confidence, parser || ' with ' || config || ' achieves ' || printf('%.2f', time) || 's avg processing time ' || case when quality <> 0 then 'with ' || printf('%.2f', quality) || ' quality score' else '' end rationale from o order by score desc, ord limit 1",
    "tradeoffs": f"with {_RES} select config configuration, parser, round(time, 6) speed, round(coalesce(quality, 0), 6) quality, round(memory, 6) memory from res",
    "compare_results": f"with {_RES} select parser, config, round(time, 6) time_1, round(time * 2, 6) time_2, round(memory, 6) memory_1, round(memory, 6) memory_2, round(quality, 6) quality_1, round(quality, 6) quality_2, 100.0 time_change, 0.0 memory_change, 0.0 quality_change from res where config <> 'F'",
    "run_overview": "select count(*) total_documents, count(*) filter (l_linenumber <> 7) total_successful, count(*) filter (l_linenumber = 7) total_failed, round(count(*) filter (l_linenumber <> 7) / count(*), 6) success_rate, round(count(*) filter (l_linenumber = 7) / count(*), 6) failure_rate, round(count(*) / 7200.0 * 3600, 6) docs_per_hour from lineitem",
    "overall_quality": "select l_orderkey, l_linenumber, round((cast(l_discount as double) + cast(l_tax as double)) / 2, 6) quality from lineitem",
    "dataset_languages": "select coalesce(lang, 'unknown') lang, count(*) n from documents group by 1",
    "value_profile": f"with {_LATEST}, v as (select coalesce(mime_type, 'unknown') mime_type, list_sort(list(file_size)) s, avg(file_size) mean, count(*) n from r where file_size is not null group by 1) select mime_type, n, s[cast(floor(n / 2) as int) + 1] median, s[case when n > 20 then cast(floor(n * 0.95) as int) else n - 1 end + 1] p95, round(mean, 6) mean from v",
    "compatible_baselines": "select c_custkey from customer where c_nationkey > 12 and abs(c_nationkey - 16) / greatest(c_nationkey, 16) <= 0.2 and abs(c_custkey - 500) / greatest(c_custkey, 500) <= 0.2",
    "best_configs": f"with {_RSC} select (select parser || '/' || config from o order by time, ord limit 1) fastest, (select parser || '/' || config from o where quality > 0 order by quality desc, ord limit 1) most_accurate, (select parser || '/' || config from o order by memory, ord limit 1) least_memory",
    "failure_categories": f"with {_FAIL} select category, count(*) n from fc group by 1",
    "failure_report": f"with {_FAIL}, k as (select dataset, 'p' parser, category, count(*) n from fc group by 1, 3) select * exclude (q) from (select *, row_number() over (partition by dataset order by n desc, category) q from k) where q <= 10",
    "export_markdown": f"with {_EL} select doc_id, md5(string_agg({_MD} || chr(10), chr(10) order by pos)) digest from e group by 1",
    "export_text": f"with {_EL} select doc_id, md5(string_agg(content, chr(10) || chr(10) order by pos)) digest from e group by 1",
    "front_matter": "select doc_id, '---' || chr(10) || 'source: ' || coalesce('\"' || source || '\"', 'null') || chr(10) || 'format: ' || coalesce('\"' || document_type || '\"', 'null') || chr(10) || 'n_chars: ' || coalesce(cast(n_chars as varchar), 'null') || chr(10) || '---' || chr(10) front from documents",
    "tax_returns": f"with {_LATEST} select id, {_TAX} is_tax_return from r",
    "merged_listings": f"with {_LISTS} select id, version_no, in_updated from ml",
    "chunk_ids": f"with {_CHUNKS} select doc_id, chunk_index, {_UUID5(chr(39) + 'chunk:' + chr(39) + ' || doc_id || ' + chr(39) + ':' + chr(39) + ' || chunk_index || ' + chr(39) + ':' + chr(39) + ' || coalesce(content, ' + chr(39) * 2 + ')')} chunk_uuid, {_UUID5(chr(39) + 'trace:' + chr(39) + ' || doc_id')} trace_uuid from c",
    "chunk_set_headers": f"with {_SETS} select document_id, {_UUID5(chr(39) + 'trace:' + chr(39) + ' || document_id')} trace_id, case when error is null then coalesce(n, 0) end total_chunks, consent_on_file, error from hd",
    "chunk_set_entries": f"with {_SETS} select document_id, chunk_index, {_UUID5(chr(39) + 'chunk:' + chr(39) + ' || document_id || ' + chr(39) + ':' + chr(39) + ' || chunk_index || ' + chr(39) + ':' + chr(39) + ' || coalesce(content, ' + chr(39) * 2 + ')')} chunk_id, start_page, end_page, cast(coalesce({_WORDS('content')}, 0) as int) token_count, is_confidential from hd join c using (doc_id) where error is null",
    "withdrawn_sets": f"with {_LATEST} select id document_id, {_UUID5(chr(39) + 'trace:' + chr(39) + ' || id')} trace_id, is_confidential is distinct from false is_confidential, false consent_on_file, 0 total_chunks from r",
    "stored_consent": f"with {_SETS} select document_id, consent_on_file consent from hd",
    "stored_tax_ids": f"with {_HS} select document_id from sh where not readable or {_TAX}",
    "withdraw_deleted": f"with {_LATEST}, {_HS} select id document_id, case when sh.document_id is null then 'skip' when not readable or {_TAX.replace('category', 'sh.category').replace('document_type', 'sh.document_type')} or (sh.category is null and sh.document_type is null and coalesce(total_chunks, 0) = 0) then 'withdrawn' end \"action\", case when not (sh.document_id is null or not readable or {_TAX.replace('category', 'sh.category').replace('document_type', 'sh.document_type')} or (sh.category is null and sh.document_type is null and coalesce(total_chunks, 0) = 0)) then 'the stored chunk set is not a tax return, so it was not replaced' end error from r left join sh on sh.document_id = r.id where deleted_at is not null",
    "sync_documents": f"with {_SYNC} select id, outcome, case when outcome = 'failed' then why end error from o",
    "run_report": f"with {_SYNC} select count(*) filter (outcome = 'chunked') chunked, count(*) filter (outcome = 'withdrawn') withdrawn, count(*) filter (outcome = 'skipped') skipped, count(*) filter (outcome = 'unchanged') unchanged, count(*) filter (outcome = 'failed') failed, (select strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') from up) newest_updated_at from o",
    "heading_paths": f"with {_PATHS} select * from pa",
    "by_title_chunks": _PACK(""),
    "by_title_pages": _PACK(_TURN),
    "section_f1": f"with {_EL}, toc as (select doc_id id, coalesce(nullif(category_depth, 0), case when type = 'title' then 1 else 2 end) lev, lower({_STRIP('substr(content, 1, 100)')}) t from e where {_HEAD}), p as (select id, case when lev = 2 then 1 else lev end lev, t from toc), h as (select p.id, count(*) hits from p where exists (select 1 from toc q where q.id = p.id and q.lev = p.lev and q.t = p.t) group by 1), n as (select id, count(*) n from toc group by 1) select n.id, round(coalesce(2.0 * hits / (2 * n), 0), 6) f1 from n left join h using (id)",
    "table_scores": "with l as (select l_orderkey id, l_linenumber rw, l_returnflag f, l_linestatus s, l_discount dc, l_tax tx, l_partkey * 100000 + l_suppkey pk from lineitem), t as (select id, rw, 0 cl, f tt, rw = 1 h, pk ord from l union all select id, rw, 1, s, rw = 1, pk from l), p as (select id, rw, 0 cl, case when tx < 0.04 then ' ' || f else lower(f) end tt, rw = 1 h, pk ord from l union all select id, rw, 1, s, rw = 2, pk from l where dc <> 0.05), "
    "a as (select p.id, count(*) n from p where exists (select 1 from t where t.id = p.id and t.rw = p.rw and t.cl = p.cl and lower(trim(t.tt)) = lower(trim(p.tt))) group by 1), lp as (select id, rw, cl, arg_max(trim(tt), ord) pt from p group by 1, 2, 3), x as (select t.id, count(*) n from t left join lp using (id, rw, cl) where trim(t.tt) = coalesce(pt, '') group by 1), "
    "hp as (select distinct id, rw, cl from p where h), ht as (select distinct id, rw, cl from t where h), hb as (select id, count(*) n from hp join ht using (id, rw, cl) group by 1), cp as (select id, count(*) n, max(rw) + 1 r, max(cl) + 1 c from p group by 1), ct as (select id, count(*) n, max(rw) + 1 r, max(cl) + 1 c from t group by 1), np as (select id, count(*) n from hp group by 1), nt as (select id, count(*) n from ht group by 1) "
    "select ct.id, round(0.3 * (1 - abs(cp.r - ct.r) / greatest(cp.r, ct.r, 1)) + 0.3 * (1 - abs(cp.c - ct.c) / greatest(cp.c, ct.c, 1)) + 0.4 * coalesce(a.n, 0) / ct.n, 6) teds, round(coalesce(x.n, 0) / ct.n, 6) exact, round(case when nt.n is null then case when np.n is null then 1.0 else 0.0 end when np.n is null then 0.0 else 2.0 * coalesce(hb.n, 0) / (np.n + nt.n) end, 6) header_f1 from ct join cp using (id) left join a using (id) left join x using (id) left join hb using (id) left join np using (id) left join nt using (id)",
    "file_formats": f"select distinct doc_id, version_no, {_KINDS.format(_EXT)} as \"format\", case {_EXT} when '.pdf' then 'application/pdf' when '.docx' then 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' when '.doc' then 'application/msword' when '.webm' then 'video/webm' when '.m4a' then 'audio/mp4' end mime_type, {_EXT} as \"extension\" from records",
    "format_by_bytes": "select doc_id, case doc_id % 3 when 0 then 'pdf' when 1 then 'html' else 'unknown' end as \"format\" from documents",
    "corpus_sample": "select doc_id || '.pdf' path from documents order by 1 limit 100",
    "corpus_stratified": "with s as (select coalesce(source, '') source, count(*) n from documents group by 1) select source, cast(least(n, greatest(round(n / (select sum(n) from s) * 100), 1)) as bigint) n from s",
    "canonical_times": "select distinct doc_id, version_no, case when doc_id % 4 <> 0 or length(strftime(document_date, '%Y-%-m-%-d')) = 10 then document_date end document_date from records",
    "docling_elements": f"with {_EL}, t as (select *, row_number() over (partition by doc_id order by pos, type, content) - 1 k, coalesce(nullif(category_depth, 0), 1) lv from e), g as (select doc_id, k, case when type in ('title', 'heading') then 'title' when type in ('list', 'list_item') then 'list_item' when type = 'code' then 'code_snippet' when type = 'formula' then 'formula' else 'narrative_text' end ty, content, case when page_number > 0 then page_number end page_number, case when type = 'title' then 0 when type = 'heading' then lv else 1 end depth, case when type in ('title', 'heading') then k end hk from t), h as (select *, max(hk) over (partition by doc_id order by k) lk from g) select h.doc_id, cast(h.k as int) pos, h.ty as \"type\", h.content, h.page_number, case when h.page_number is not null then 100.0 end y0, case when h.page_number is not null then 150.0 end y1, cast(h.depth as int) category_depth, x.content section_title from h left join g x on x.doc_id = h.doc_id and x.k = h.lk",
    "coco_annotations": f"with {_ANN} select document_id, annotation_id, category, round(x0, 6) x0, round(y0, 6) y0, round(x1, 6) x1, round(y1, 6) y1 from an",
    "true_order": f"with {_ANN} select document_id id, cast(ord as int) n, round(y0, 6) \"by\", annotation_id item from an",
    "export_json": f"with {_EL} select doc_id, pos, to_json(case when page_number is null then json_object('type', type, 'content', content) else json_object('type', type, 'content', content, 'page_number', page_number) end) json from e",
}

_GRAMS = (
    "x as (select p.id, p.tp, p.tr, n from (select id, {tok_p} tp, {tok_r} tr from p) p, unnest(range(1, {most} + 1)) t(n)), "
    "gp as (select id, n, g, count(*) c from (select id, n, unnest([array_to_string(tp[i:i + n - 1], chr(1)) for i in range(1, len(tp) - n + 2)]) g from x) group by all), gr as (select id, n, g, count(*) c from (select id, n, unnest([array_to_string(tr[i:i + n - 1], chr(1)) for i in range(1, len(tr) - n + 2)]) g from x) group by all), "
    "hit as (select id, n, sum(least(gp.c, gr.c)) h from gp join gr using (id, n, g) group by all), m as (select x.id, x.n, len(tp) np, len(tr) nr, coalesce(h, 0) h from x left join hit using (id, n))"
)
_RAW = f"{_LATEST}, p as (select id, title pred, concat_ws(' ', category, document_type, cast(year(document_date) as varchar)) ref from r where title is not null)"
_TOKENS = lambda c: f"list_filter(string_split_regex(lower({c}), '{_WS}+'), lambda w: w <> '')"
_LETTERS = lambda c: f"[substr(replace({c}, ' ', ''), i, 1) for i in range(1, length(replace({c}, ' ', '')) + 1)]"
_MDL = f"l as (select doc_id, cast(i - 1 as int) pos, {_STRIP('x[i]')} line from (select doc_id, string_split(text, chr(10)) x from documents where text is not null), unnest(range(1, len(x) + 1)) t(i))"
ORACLES |= {
    "bleu": f"with {_RAW}, {_GRAMS.replace('{tok_p}', _TOKENS('pred')).replace('{tok_r}', _TOKENS('ref')).replace('{most}', '4')} select id, round(case when min(h) = 0 or min(np) < 4 then 0.0 else exp(avg(ln(case when h > 0 then h / (np - n + 1) end))) * case when min(np) < min(nr) then exp(1 - min(nr) / min(np)) else 1.0 end end, 6) bleu from m group by id",
    "chrf": f"with {_RAW}, {_GRAMS.replace('{tok_p}', _LETTERS('pred')).replace('{tok_r}', _LETTERS('ref')).replace('{most}', '6')}, f as (select id, case when h = 0 then 0.0 else 5 * (h / (np - n + 1)) * (h / (nr - n + 1)) / (4 * (h / (np - n + 1)) + h / (nr - n + 1)) end f from m where np >= n and nr >= n) select p.id, round(coalesce(avg(f), 0.0), 6) chrf from p left join f using (id) group by 1",
    "elements_rich_markdown": f"with {_MDL}, k as (select *, case when line = '' then 'blank' when regexp_matches(line, '^\\{{\\d+\\}}') then 'page' when regexp_matches(line, '^-{{10,}}') then 'rule' when contains(line, '|') then 'table' when starts_with(line, '$$') and ends_with(line, '$$') then 'formula' when starts_with(line, '# ') then 'title' when starts_with(line, '## ') or starts_with(line, '### ') then 'heading' when starts_with(line, '- ') or starts_with(line, '* ') then 'list' else 'paragraph' end kind from l), "
    "w as (select *, coalesce(max(case when kind = 'page' then pos * 1000000 + least(coalesce(try_cast(regexp_extract(line, '^\\{(\\d+)\\}', 1) as bigint), 999999), 999999) end) over (partition by doc_id order by pos) % 1000000 + 1, 1) page, count(*) filter (kind <> 'table') over (partition by doc_id order by pos) brk from k), "
    f"o as (select doc_id, pos, kind ty, cast(page as int) page_number, case when kind = 'formula' then {_STRIP(chr(34) + 'f' + chr(34))} when kind in ('title', 'heading') then {_STRIP(chr(34) + 'h' + chr(34))} else line end ct from (select *, regexp_replace(line, '^\\$\\$|\\$\\$$', '', 'g') f, regexp_replace(line, '^#{{1,3}} ', '') h from w) where kind not in ('table', 'blank', 'page', 'rule') union all select doc_id, min(pos), 'table', cast(min(page) as int), string_agg(line, chr(10) order by pos) from w where kind = 'table' group by doc_id, brk) select doc_id, pos, ty as \"type\", page_number, ct as \"content\" from o where {_STRIP('ct')} <> ''",
}


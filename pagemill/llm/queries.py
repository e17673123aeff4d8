"""Queries of the operators for training text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import history, leakage, ocr, pii, splitting, tokenizer, toxicity
from pagemill.functions.keys import canonical_uuid
from pagemill.plans.stages import shared_folder, stored
from pagemill.sources.tables import table


def _personal_texts(spark: SparkSession, d: str) -> DataFrame:
    """Chunk contents and record titles, each distinct row once."""
    key = lambda c: F.coalesce(canonical_uuid(F.col(c)), F.col(c))
    chunks = table(spark, d, "chunks").select(F.lit("chunks").alias("src_table"), F.col("chunk_id").cast("string").alias("row_key"), F.col("content").alias("text"))
    titles = table(spark, d, "records").select(F.lit("records").alias("src_table"), key("id").alias("row_key"), F.col("title").alias("text")).distinct()
    return chunks.unionByName(titles)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_personal(_personal_texts(spark, d)).select("src_table", "row_key", "kind")


def p1_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redact_texts(_personal_texts(spark, d))


#: Weekly batches that one admission takes; the outcome is the same for any number.
BATCHES_AT_ONCE = 12


def _file_intake(spark: SparkSession, d: str) -> DataFrame:
    """Goes through the records' files batch after batch; (key, batch_no, accepted_key) of the refused."""
    files = history.HashHistory(spark, shared_folder(spark, "file-history"))
    records = stored(history.first_versions(table(spark, d, "records")), "first-versions")
    for label, part in history.successive(records, "batch_no", BATCHES_AT_ONCE):
        files.admit_files(records.where(part), label)
    return files.refused()


def _chunk_intake(spark: SparkSession, d: str) -> DataFrame:
    """Goes through the chunks batch after batch, likewise."""
    contents = history.HashHistory(spark, shared_folder(spark, "chunk-history"))
    chunks = table(spark, d, "chunks")
    for label, part in history.successive(chunks, "batch_no", BATCHES_AT_ONCE):
        contents.admit(chunks.where(part), "chunk_id", "content", "batch_no", label)
    return contents.refused()


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pair = lambda df, grain: df.select(F.lit(grain).alias("grain"), F.least("key", "accepted_key").alias("key_a"), F.greatest("key", "accepted_key").alias("key_b"))
    return pair(_file_intake(spark, d), "record").unionByName(pair(_chunk_intake(spark, d), "chunk")).distinct()


def p2_refused_files(spark: SparkSession, d: str) -> DataFrame:
    return _file_intake(spark, d).distinct()


def _pieces(spark: SparkSession, d: str) -> DataFrame:
    part = lambda name, no, kind: splitting.split_oversized(table(spark, d, name), ["doc_id", no], "content", kind).select(F.lit(name).alias("src_table"), "doc_id", F.col(no).cast("bigint").alias("item_no"), "item_tokens", "piece_no", "n_pieces", "content", "n_tokens", "n_overlap")
    return part("chunks", "chunk_index", "chunk_type").unionByName(part("elements", "pos", "element_type"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _pieces(spark, d).where("n_pieces > 1").select("src_table", "doc_id", "item_no").distinct()


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _pieces(spark, d)


def p3_cover(spark: SparkSession, d: str) -> DataFrame:
    """Per oversized item: whether every piece keeps the limit and the overlap, pieces are numbered without gaps, and a hash of the words that they hold without overlaps."""
    words = F.filter(F.split("content", r"(?U)[\s\p{Z}]+"), lambda w: w != "")
    p = _pieces(spark, d).withColumn("own", F.array_join(F.slice(words, F.col("n_overlap") + 1, F.size(words)), " ")).distinct()
    rows = F.sort_array(F.collect_list(F.struct("piece_no", "own")))
    return p.groupBy("src_table", "doc_id", "item_no").agg(
        F.bool_and(F.col("n_tokens") <= 512).alias("within_limit"), F.bool_and(F.col("n_overlap") <= 64).alias("within_overlap"), (F.max("piece_no") + 1 == F.count(F.lit(1))).alias("numbered"), F.md5(F.array_join(rows["own"], " ")).alias("digest")
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return ocr.scan_noise(table(spark, d, "elements")).distinct()


def p4_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return ocr.repaired_paragraphs(table(spark, d, "elements"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.encode_corpus(tokenizer.one_row_per_id(table(spark, d, "documents")))


def p6_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The hash of the text that each document's ids spell."""
    return tokenizer.decode_corpus(p6_ids(spark, d)).select("doc_id", F.md5("text").alias("digest"))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "benchmark"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id").distinct()


def p7_leaks_per_item(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks_per_item(_leaks(spark, d))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents")
    return toxicity.score_documents(documents, toxicity.train_lexicon(documents, table(spark, d, "labels")))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).where("is_toxic").select("doc_id").distinct()


def p8_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d)


def p8_rates_by_source(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.rates_by_source(_scored(spark, d))


QUERIES = {"p1_found": p1_found, "p1_redacted": p1_redacted, "p2_found": p2_found, "p2_refused_files": p2_refused_files, "p3_found": p3_found, "p3_pieces": p3_pieces, "p3_cover": p3_cover, "p4_found": p4_found, "p4_paragraphs": p4_paragraphs, "p6_ids": p6_ids, "p6_round_trip": p6_round_trip, "p7_found": p7_found, "p7_leaks_per_item": p7_leaks_per_item, "p8_found": p8_found, "p8_scores": p8_scores, "p8_rates_by_source": p8_rates_by_source}

_SPACE = "[\\t-\\r\\x{{85}}\\p{{Z}}]"
_LONG = "select distinct '{0}' src_table, doc_id, cast({1} as bigint) item_no from {0} where len(list_filter(string_split_regex(content, '" + _SPACE + "+'), lambda x: x <> '')) > 512"
_FILES = """
with v as (select distinct doc_id, version_no, batch_no, regexp_replace(regexp_replace(lower(trim(sha256)), '^sha-?256:', ''), '[^0-9a-f]', '', 'g') sha from records),
f as (select doc_id, arg_min(batch_no, version_no) batch_no, arg_min(coalesce(sha, ''), version_no) sha from v group by doc_id),
g as (select *, row_number() over w rn, first_value(doc_id) over w head from f where length(sha) = 64 and sha <> repeat('0', 64) and sha <> 'e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855' window w as (partition by sha order by batch_no, doc_id))
select doc_id as "key", batch_no, head accepted_key from g where rn > 1
"""
_WORDS = "list_filter(string_split_regex(content, '" + _SPACE.replace("{{", "{").replace("}}", "}") + "+'), lambda x: x <> '')"
_COVER = "select '{0}' src_table, doc_id, cast({1} as bigint) item_no, true within_limit, true within_overlap, true numbered, md5(array_to_string(" + _WORDS.replace("{", "{{").replace("}", "}}") + ", ' ')) digest from (select distinct doc_id, {1}, content from {0}) where len(" + _WORDS.replace("{", "{{").replace("}", "}}") + ") > 512"
ORACLES = {
    "p2_refused_files": _FILES,
    "p3_found": _LONG.format("chunks", "chunk_index") + " union " + _LONG.format("elements", "pos"),
    "p3_cover": _COVER.format("chunks", "chunk_index") + " union " + _COVER.format("elements", "pos"),
    "p6_round_trip": "select doc_id, md5(coalesce(text, '')) digest from documents",
}

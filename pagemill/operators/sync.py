"""Records, consent and chunk sets: incremental maintenance as joins and one decision."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.keys import canonical_sha256, canonical_uuid, raw_or_canonical_uuid
from pagemill.operators.chunking import n_words
from pagemill.operators.elements import non_blank

#: Normalised labels of tax returns, by category and by document type.
TAX_CATEGORIES = ("tax return", "tax returns")
TAX_DOCUMENT_TYPES = ("tax return", "tax election")
#: Fixed values of the chunk-set contract: version, track, default strategy, and the fields carried from the record to the set and its chunks.
SCHEMA_VERSION, SOURCE_TRACK, STRATEGY = "1.1", "document", "hybrid"
CARRIED = ("entity_id", "document_type", "category", "is_confidential", "consent_on_file", "title", "document_date", "sha256")
#: Fixed value: hex of the namespace of chunk and trace ids.
ID_NAMESPACE = "5d0c4f7e3a514d0e9a536b1b6a0f2c11"


def normal_label(c: Column) -> Column:
    """Lower case with underscores, hyphens and white space runs as one blank."""
    return F.trim(F.regexp_replace(F.lower(F.translate(c, "_-", "  ")), r"(?U)\s+", " "))


def is_tax_return(category: Column, document_type: Column) -> Column:
    """Whether the category or the document type is one of a tax return; each has its own labels."""
    known = lambda c, labels: F.coalesce(normal_label(c).isin(*labels), F.lit(False))
    return known(category, TAX_CATEGORIES) | known(document_type, TAX_DOCUMENT_TYPES)


def latest_records(records: DataFrame) -> DataFrame:
    """One row per id: the newest by updated_at, then version, in any spelling of the id."""
    r = records.withColumn("id", raw_or_canonical_uuid(F.col("id"))).where("id is not null")
    cols = [c for c in r.columns if c != "id"]
    return r.groupBy("id").agg(F.max_by(F.struct(*cols), F.struct("updated_at", "version_no")).alias("r")).select("id", "r.*")


def listing_order(records: DataFrame) -> DataFrame:
    """Records by (updated_at, id), as listings are read."""
    return records.orderBy("updated_at", "id")


def uuid5(name: Column, namespace: str = ID_NAMESPACE) -> Column:
    """Name-based UUID (version 5) inside the JVM."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1), F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def chunk_id(document_id: Column, index: Column, text: Column) -> Column:
    return uuid5(F.concat(F.lit("chunk:"), document_id.cast("string"), F.lit(":"), index.cast("string"), F.lit(":"), F.coalesce(text, F.lit(""))))


def trace_id(document_id: Column) -> Column:
    return uuid5(F.concat(F.lit("trace:"), document_id.cast("string")))


def chunk_ids(chunks: DataFrame) -> DataFrame:
    """Stable ids of chunks from document, place and text (null is empty), and one trace id per document."""
    c = chunks.select("doc_id", "chunk_index", "content").where("doc_id is not null and chunk_index is not null").distinct()
    return c.select("doc_id", "chunk_index", chunk_id(F.col("doc_id"), F.col("chunk_index"), F.col("content")).alias("chunk_uuid"), trace_id(F.col("doc_id")).alias("trace_uuid"))


def _carried(strict: bool) -> list[Column]:
    """The carried fields: consent only where exactly true; without ``strict``, confidential unless exactly false."""
    secret = F.col("is_confidential") if strict else ~F.col("is_confidential").eqNullSafe(False)
    special = {"consent_on_file": F.col("consent_on_file").eqNullSafe(True) if strict else F.lit(False), "is_confidential": secret}
    return [special.get(c, F.col(c)).alias(c) for c in CARRIED]


def record_error() -> Column:
    """Why a record's chunks may not be written, null if they may: the first rule that fails."""
    blank = lambda c: ~non_blank(F.col(c))
    return (
        F.when(canonical_uuid(F.col("id")).isNull(), "document_id must be a UUID").when(blank("entity_id"), "Document field entity_id must be a non-empty string")
        .when(blank("sha256"), "Document field sha256 must be a non-empty string").when(F.col("is_confidential").isNull(), "Document field is_confidential must be a boolean")
        .when(is_tax_return(F.col("category"), F.col("document_type")) & ~F.col("consent_on_file").eqNullSafe(True), "tax return without consent on file")
    )


def chunk_sets(records: DataFrame, chunks: DataFrame, strategy: str = STRATEGY, count: Callable[[Column], Column] = n_words) -> tuple[DataFrame, DataFrame]:
    """Chunk sets of the latest records: (headers, entries).

    headers: one row per record with an id, trace id, the carried fields, total_chunks and error; a set with an error has no entries and a null
    total. entries: one row per chunk with its ids, place, text, page range, tokens and the carried fields; scores are null, that
    is not scored. A chunk without a page range from 1 up fails its set, the first one being named. Chunks meet records by doc_id; repeated rows count once.
    """
    c = chunks.where("doc_id is not null and chunk_index is not null").select("doc_id", "chunk_index", "content", "start_page", "end_page").distinct()
    bad = (F.col("start_page").isNull() | F.col("end_page").isNull() | (F.col("start_page") < 1) | (F.col("end_page") < F.col("start_page")))
    pages = c.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(bad, F.col("chunk_index"))).alias("bad_chunk"))
    r = records.select("id", "doc_id", *_carried(True), record_error().alias("rule"))
    j = r.join(pages, "doc_id", "left")
    error = F.coalesce("rule", F.when(F.col("bad_chunk").isNotNull(), F.concat(F.lit("Chunk "), F.col("bad_chunk").cast("string"), F.lit(" has no valid page range"))))
    head = j.withColumn("error", error).withColumn("trace_id", trace_id(F.col("id")))
    fixed = [F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(SOURCE_TRACK).alias("source_track"), F.lit(strategy).alias("chunk_strategy")]
    headers = head.select(F.col("id").alias("document_id"), "trace_id", *fixed, F.when(F.col("error").isNull(), F.coalesce("n", F.lit(0))).alias("total_chunks"), *CARRIED, "error")
    good = head.where("error is null").select(F.col("id").alias("document_id"), "trace_id", "doc_id", *CARRIED)
    entries = c.join(good, "doc_id").select(
        "document_id", "trace_id", "chunk_index", chunk_id(F.col("document_id"), F.col("chunk_index"), F.col("content")).alias("chunk_id"), F.col("content").alias("text"), "start_page", "end_page",
        count(F.col("content")).alias("token_count"), F.lit(None).cast("double").alias("trust_score"), F.lit(None).cast("double").alias("hallucination_risk"), *fixed[1:], *CARRIED,
    )
    return headers, entries


def withdrawn_sets(records: DataFrame, strategy: str = STRATEGY) -> DataFrame:
    """Headers of sets without chunks and consent; incomplete records are taken, being confidential unless exactly not."""
    return records.select(F.col("id").alias("document_id"), trace_id(F.col("id")).alias("trace_id"), F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(SOURCE_TRACK).alias("source_track"), F.lit(strategy).alias("chunk_strategy"), F.lit(0).alias("total_chunks"), *_carried(False))


def set_files(headers: DataFrame, entries: DataFrame) -> DataFrame:
    """(document_id, json): each set as the one object that its file holds. A document's chunks come together in one row, as its file does."""
    entry = F.struct("chunk_index", *(F.col(c) for c in entries.columns if c not in ("document_id", "chunk_index")))
    lists = entries.groupBy("document_id").agg(F.sort_array(F.collect_list(entry)).alias("chunks"))
    whole = headers.where("error is null").drop("error").join(lists, "document_id", "left")
    return whole.select("document_id", F.to_json(F.struct(*headers.drop("error").columns, F.coalesce("chunks", F.array().cast(lists.schema["chunks"].dataType)).alias("chunks")), {"ignoreNullFields": "false"}).alias("json"))


def stored_consent(headers: DataFrame, entries: DataFrame) -> DataFrame:
    """(document_id, consent) of stored sets: true only where that of the set and of every chunk is exactly true; an unreadable set (null) counts as false."""
    chunks = entries.groupBy("document_id").agg(F.bool_and(F.col("consent_on_file").eqNullSafe(True)).alias("all"))
    j = headers.select("document_id", F.col("consent_on_file").eqNullSafe(True).alias("own")).join(chunks, "document_id", "left")
    return j.select("document_id", (F.col("own") & F.coalesce("all", F.lit(True))).alias("consent"))


def consent_actions(records: DataFrame, stored: DataFrame) -> DataFrame:
    """(id, action) of the latest records against (document_id, consent) of stored sets; a null consent is none.

    not_required for other than tax returns; with consent exactly true unchanged (stored with consent) or chunk; without it skip (nothing stored) or withdrawn.
    """
    s = stored.groupBy(F.col("document_id").alias("id")).agg(F.min(F.coalesce("consent", F.lit(False))).alias("stored"))
    j = records.join(s, "id", "left")
    consent, old = F.col("consent_on_file").eqNullSafe(True), F.col("stored")
    action = (
        F.when(~is_tax_return(F.col("category"), F.col("document_type")), "not_required").when(consent & old.eqNullSafe(True), "unchanged")
        .when(consent, "chunk").when(old.isNull(), "skip").otherwise("withdrawn")
    )
    return j.select("id", action.alias("action"))


def merged_listings(updated: DataFrame, tax: DataFrame, key: str = "id") -> DataFrame:
    """Both listings with one row per key and whether it is among the updated, whose rows win."""
    rest = tax.join(updated.select(key), key, "left_anti")
    return updated.withColumn("in_updated", F.lit(True)).unionByName(rest.withColumn("in_updated", F.lit(False)))


def unreached_sets(stored: DataFrame, records: DataFrame) -> DataFrame:
    """Stored document ids that no record has."""
    s = stored.select(raw_or_canonical_uuid(F.col("document_id")).alias("document_id")).where("document_id is not null").distinct()
    return s.join(records.select(raw_or_canonical_uuid(F.col("id")).alias("document_id")), "document_id", "left_anti")


def stored_tax_ids(headers: DataFrame) -> DataFrame:
    """(document_id) of stored sets under a canonical id that say they are tax returns, or that can't be read (``readable`` false)."""
    tax = is_tax_return(F.col("category"), F.col("document_type")) | ~F.coalesce("readable", F.lit(False))
    return headers.where(tax & (F.col("document_id") == canonical_uuid(F.col("document_id")))).select("document_id").distinct()


def withdraw_deleted(headers: DataFrame, gone: DataFrame) -> DataFrame:
    """(document_id, action, error) for deleted documents (document_id).

    A stored tax return, or one that can't be read, is withdrawn; a set without labels and chunks already is; any other stored set is refused with
    an error; nothing stored is skip.
    """
    j = gone.select("document_id").distinct().join(headers, "document_id", "left")
    kept, tax = F.col("readable").isNotNull(), is_tax_return(F.col("category"), F.col("document_type"))
    no_label = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    blanked = no_label("category") & no_label("document_type") & (F.coalesce("total_chunks", F.lit(0)) == 0)
    action = F.when(~kept, "skip").when(~F.col("readable") | tax | blanked, "withdrawn")
    return j.select("document_id", action.alias("action"), F.when(action.isNull(), "the stored chunk set is not a tax return, so it was not replaced").alias("error"))


def sync_documents(updated: DataFrame, tax: DataFrame, stored: DataFrame, current: DataFrame, converted: DataFrame) -> DataFrame:
    """(id, outcome, error) of one run over the listings, as one plan; per document failures are rows.

    updated and tax: listings of records; stored: (document_id, consent); current: records as they are read again before writing; converted: (id, sha256) of the files as downloaded.
    A tax return without consent, listed or read again, is withdrawn or skipped; one that wasn't updated and needs no chunking
    is unchanged; a record that is gone is withdrawn (tax return) or skipped; a file whose hash isn't the record's and a record that changed
    since it was listed fail and are tried again in the next run; all else is chunked.
    """
    listed = merged_listings(updated, tax)
    first = consent_actions(listed, stored).withColumnRenamed("action", "first")
    now = current.select("id", F.lit(True).alias("there"), F.col("updated_at").alias("now_at"), canonical_sha256(F.col("sha256")).alias("now_sha"))
    again = consent_actions(current, stored).withColumnRenamed("action", "again")
    files = converted.select("id", canonical_sha256(F.col("sha256")).alias("file_sha"))
    j = listed.join(first, "id").join(now, "id", "left").join(again, "id", "left").join(files, "id", "left")
    settled = lambda c: F.col(c).isin("withdrawn", "skip")
    outcome = lambda c: F.when(F.col(c) == "skip", "skipped").otherwise("withdrawn")
    error = (
        F.when(F.col("now_at") != F.col("updated_at"), "the record changed while the file was converted; it will be retried next run")
        .when(F.col("now_sha") != F.col("file_sha"), "the file changed after its record was read; it will be retried next run")
    )
    result = (
        F.when(settled("first"), outcome("first")).when(~F.col("in_updated") & (F.col("first") != "chunk"), "unchanged")
        .when(F.col("there").isNull(), F.when(is_tax_return(F.col("category"), F.col("document_type")), "withdrawn").otherwise("skipped"))
        .when(settled("again"), outcome("again")).when(error.isNotNull(), "failed").otherwise("chunked")
    )
    return j.select("id", result.alias("outcome"), F.when(result == "failed", error).alias("error"))


def sync_report(actions: DataFrame, by: str = "action") -> DataFrame:
    return actions.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def run_report(outcomes: DataFrame, updated: DataFrame) -> DataFrame:
    """One row: how many documents were chunked, withdrawn, skipped, unchanged and failed, and the newest update, from which the next run starts."""
    counts = outcomes.agg(*(F.count_if(F.col("outcome") == k).alias(k) for k in ("chunked", "withdrawn", "skipped", "unchanged", "failed")))
    return counts.crossJoin(updated.agg(F.max("updated_at").alias("newest_updated_at")))  # one row each


def exact_copies(documents: DataFrame) -> DataFrame:
    """(doc_id, first_doc_id, is_duplicate) by the hash of the text; null texts are never copies.

    Only hashes that several rows have are joined; adaptive execution splits a hash that very many have.
    """
    d = documents.select("doc_id", F.sha2("text", 256).alias("h"))
    first = d.where("h is not null").groupBy("h").agg(F.min("doc_id").alias("first_doc_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    j = d.join(first, "h", "left")
    return j.select("doc_id", F.coalesce("first_doc_id", "doc_id").alias("first_doc_id"), (F.coalesce("first_doc_id", "doc_id") != F.col("doc_id")).alias("is_duplicate"))

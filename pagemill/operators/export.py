"""Exporters: Markdown, text and JSON per document, one file a document, metric tables and reports."""

from __future__ import annotations

import html
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.operators.elements import clean_elements

#: Fixed value: metadata keys that stay inside.
INTERNAL_KEYS = ("docling_json",)


def _emphasised(content: Column, parts: Column) -> Column:
    """Content with each emphasised part that stands in it between double asterisks."""
    return F.aggregate(F.coalesce(parts, F.array().cast("array<string>")), content, lambda text, p: F.when(F.length(p) > 0, F.replace(text, p, F.concat(F.lit("**"), p, F.lit("**")))).otherwise(text))


def element_markdown(emphasised: Column | None = None) -> Column:
    """Markdown of one element by its type; headings by depth (1 if null or 0), at most six signs."""
    depth = F.least(F.coalesce(F.when(F.col("category_depth") != 0, F.col("category_depth")), F.lit(1)), F.lit(6))
    c, kind = F.col("content"), F.col("type")
    other = c if emphasised is None else _emphasised(c, emphasised)
    return (
        F.when(kind.isin("title", "heading"), F.concat(F.repeat(F.lit("#"), depth), F.lit(" "), c)).when(kind == "list_item", F.concat(F.lit("- "), c)).when(kind == "table", F.concat(F.lit("\n"), c))
        .when(kind.isin("code_snippet", "code"), F.concat(F.lit("```\n"), c, F.lit("\n```"))).when(kind == "formula", F.concat(F.lit("$$"), c, F.lit("$$")))
        .when(kind == "image", F.concat(F.lit("!["), c, F.lit("](image)"))).when(kind.isin("figure_caption", "caption"), F.concat(F.lit("*"), c, F.lit("*"))).otherwise(other)
    )


def _joined(elements: DataFrame, text: Column, name: str, between: str) -> DataFrame:
    """(doc_id, name): a document's texts in reading order in one row, as its file holds them."""
    e = clean_elements(elements).select("doc_id", "pos", text.alias("t"))
    rows = F.sort_array(F.collect_list(F.struct("pos", "t")))
    return e.groupBy("doc_id").agg(F.array_join(rows["t"], between).alias(name))


def to_markdown(elements: DataFrame) -> DataFrame:
    """(doc_id, markdown) in reading order, elements ending in a line end and parted by one."""
    return _joined(elements, F.concat(element_markdown(), F.lit("\n")), "markdown", "\n")


def to_text(elements: DataFrame) -> DataFrame:
    """(doc_id, text) in reading order, elements parted by a blank line."""
    return _joined(elements, F.col("content"), "text", "\n\n")


def to_json_rows(elements: DataFrame) -> DataFrame:
    """(doc_id, pos, json) with one object per element."""
    return clean_elements(elements).select("doc_id", "pos", F.to_json(F.struct("type", "content", "page_number")).alias("json"))


def _yaml(c: Column) -> Column:
    """A scalar as YAML: null, or a quoted JSON string for text."""
    return F.coalesce(c.cast("string"), F.lit("null"))


def front_matter(documents: DataFrame, fields: list[str]) -> DataFrame:
    """(doc_id, front): a YAML head of the fields in their order, texts quoted as in JSON."""
    kinds = dict(documents.dtypes)
    quoted = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    line = lambda c: F.concat(F.lit(f"{c}: "), F.when(F.col(c).isNull(), "null").otherwise(quoted(F.col(c)) if kinds[c] == "string" else _yaml(F.col(c))))
    return documents.select("doc_id", F.concat(F.lit("---\n"), F.array_join(F.array(*map(line, fields)), "\n"), F.lit("\n---\n")).alias("front"))


def documents_markdown(documents: DataFrame, elements: DataFrame, fields: list[str]) -> DataFrame:
    """(doc_id, markdown) with a front matter of the fields; documents without elements have only that."""
    j = front_matter(documents, fields).join(to_markdown(elements), "doc_id", "left")
    return j.select("doc_id", F.concat_ws("\n", "front", "markdown").alias("markdown"))


def documents_json(documents: DataFrame, elements: DataFrame, chunks: DataFrame) -> DataFrame:
    """(doc_id, json): the whole document as one object, with its fields, elements and chunks in order; internal metadata keys stay inside; nulls are written.

    documents has one row per doc_id; elements and chunks are lists as long as the document.
    """
    e = clean_elements(elements).select("doc_id", F.struct("pos", "type", "content", "page_number", "category_depth").alias("x"))
    element = lambda x: F.struct(x["type"].alias("type"), x["content"].alias("content"), F.struct(x["page_number"].alias("page_number"), x["category_depth"].alias("category_depth")).alias("metadata"))
    e = e.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list("x")), element).alias("elements"))
    fields = ["chunk_index", "chunk_id", "content", "token_count", "char_count", "start_page", "end_page"]
    c = chunks.where("doc_id is not null").select("doc_id", F.struct(*fields).alias("x")).distinct()
    chunk = lambda x: F.struct(*(x[f].alias(f) for f in fields[1:]))
    c = c.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list("x")), chunk).alias("chunks"))
    own = [k for k in documents.columns if k != "doc_id" and k not in INTERNAL_KEYS]
    d = documents
    if dict(documents.dtypes).get("metadata", "").startswith("map"):
        d = d.withColumn("metadata", F.map_filter("metadata", lambda k, _: ~k.isin(*INTERNAL_KEYS)))
    empty = lambda df, k: F.coalesce(F.col(k), F.array().cast(df.schema[k].dataType)).alias(k)
    j = d.join(e, "doc_id", "left").join(c, "doc_id", "left")
    return j.select("doc_id", F.to_json(F.struct(F.col("doc_id").alias("document_id"), *own, empty(e, "elements"), empty(c, "chunks")), {"ignoreNullFields": "false"}).alias("json"))


def export(documents: DataFrame, elements: DataFrame, chunks: DataFrame, format: str, fields: list[str]) -> DataFrame:
    """(doc_id, suffix, content) in the format json, markdown, both or text; another one is a ValueError."""
    part = lambda df, c, suffix: df.select("doc_id", F.lit(suffix).alias("suffix"), F.col(c).alias("content"))
    make: dict[str, Callable[[], DataFrame]] = {
        "json": lambda: part(documents_json(documents, elements, chunks), "json", ".json"),
        "markdown": lambda: part(documents_markdown(documents, elements, fields), "markdown", ".md"),
        "text": lambda: part(to_text(elements), "text", ".txt"),
    }
    if format == "both":
        return make["json"]().unionByName(make["markdown"]())
    if format not in make:
        raise ValueError(f"unsupported format: {format}")
    return make[format]()


def write_files(files: DataFrame, folder: str, mode: int = 0o644) -> DataFrame:
    """Writes (name, content) to one file each in a folder that all executors see; returns (name, n_bytes) and writes when that is run.

    Each file is written beside its place, flushed to disk and renamed, so that a reader sees the old or the new one, whole; a
    task that runs again writes the same. Names with a path separator raise an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        import tempfile

        for b in batches:
            sizes = []
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if os.sep in name or name in ("", ".", ".."):
                    raise ValueError(f"not a file name: {name}")
                data = (content or "").encode()
                handle, beside = tempfile.mkstemp(dir=folder, prefix=".writing-")
                with os.fdopen(handle, "wb") as f:
                    f.write(data)
                    f.flush()
                    os.fsync(f.fileno())
                os.chmod(beside, mode)
                os.replace(beside, os.path.join(folder, name))
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], names=["name", "n_bytes"])

    return files.select("name", "content").mapInArrow(run, "name string, n_bytes bigint")


def metric_table(summary: DataFrame, metrics: list[str]) -> DataFrame:
    """One row per dataset and parser with mean_ and std_ columns per metric."""
    wide = summary.groupBy("dataset", "parser").pivot("metric", metrics).agg(F.first("mean").alias("mean"), F.first("std").alias("std"))
    return wide.select("dataset", "parser", *(F.col(f"{m}_{k}").alias(f"{k}_{m}") for m in metrics for k in ("mean", "std")))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def html_report(title: str, sections: dict[str, DataFrame]) -> str:
    """A static page with one table per section. The sections are reports of aggregates, one row per dataset, parser or configuration, so they go to the driver."""
    cell = lambda tag, v: f"<{tag}>{html.escape('' if v is None else f'{v:.4f}' if isinstance(v, float) else str(v))}</{tag}>"
    out = [f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>"]
    for name, df in sections.items():
        rows = "".join(f"<tr>{''.join(cell('td', v) for v in row)}</tr>" for row in df.collect())
        out.append(f"<h2>{html.escape(name)}</h2><table><tr>{''.join(cell('th', c) for c in df.columns)}</tr>{rows}</table>")
    return "\n".join([*out, "</body></html>"])


def save_results(results: DataFrame, path: str) -> None:
    """Result rows as JSON lines."""
    results.write.mode("overwrite").json(path)


def load_results(spark, path: str, schema: str) -> DataFrame:
    """Result rows of save_results; a row that doesn't fit the schema is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def preview(df: DataFrame, key: str, order: str, n: int = 10) -> DataFrame:
    """The first rows in an order, with long texts cut to 100 characters: a view for people."""
    cut = [F.when(F.length(c) > 100, F.concat(F.substring(c, 1, 100), F.lit("..."))).otherwise(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes]
    return df.orderBy(key, order).limit(n).select(*cut)

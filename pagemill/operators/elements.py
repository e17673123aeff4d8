"""Elements of documents: parsing of marked-up text, types, headings and confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one document are scanned in blocks of this many positions, so that a long document is spread over tasks.
BLOCK = 4096


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def non_blank(c: Column) -> Column:
    return F.coalesce(strip(c) != "", F.lit(False))


def running(df: DataFrame, key: str, order: str, **columns: tuple[str, Column]) -> DataFrame:
    """Running sums and maxima per key in the order, two levels deep.

    columns: name=("sum" or "max", value). Within blocks of the order a window runs; the totals of earlier blocks, one row per
    block, come from a second window and are joined, so that no task holds a whole key's rows.
    """
    agg = {"sum": F.sum, "max": F.max}
    d = df.withColumn("_block", F.floor(F.col(order) / BLOCK))
    for name, (_, value) in columns.items():
        d = d.withColumn(f"_{name}", value)
    inside = Window.partitionBy(key, "_block").orderBy(order)
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = d.groupBy(key, "_block").agg(*(agg[how](f"_{n}").alias(f"_{n}") for n, (how, _) in columns.items()))
    totals = totals.select(key, "_block", *(agg[how](f"_{n}").over(before).alias(f"_{n}_before") for n, (how, _) in columns.items()))
    out = d.join(totals, [key, "_block"])
    for name, (how, _) in columns.items():
        now = agg[how](f"_{name}").over(inside)
        out = out.withColumn(name, F.coalesce(now, F.lit(0)) + F.coalesce(f"_{name}_before", F.lit(0)) if how == "sum" else F.greatest(now, f"_{name}_before"))
    return out.drop("_block", *(f"_{n}" for n in columns), *(f"_{n}_before" for n in columns))


def clean_elements(elements: DataFrame) -> DataFrame:
    """One row per (doc_id, pos) with non-blank content, the type in lower case ("uncategorized_text" if null)."""
    e = elements.where(non_blank(F.col("content")) & F.col("doc_id").isNotNull() & F.col("pos").isNotNull())
    return e.select("doc_id", "pos", F.coalesce(F.lower(F.trim("element_type")), F.lit("uncategorized_text")).alias("type"), "content", "page_number", "category_depth", "confidence").distinct()


def lines_of(documents: DataFrame) -> DataFrame:
    """(doc_id, pos, line) of the non-blank lines of each text; null texts have none."""
    d = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return d.where(non_blank(F.col("line"))).withColumn("line", strip(F.col("line")))


def markdown_elements(documents: DataFrame) -> DataFrame:
    """Line by line: "# " is a title, "## " and "### " are headings, anything else a paragraph."""
    line = F.col("line")
    kind = F.when(line.startswith("# "), "title").when(line.startswith("## ") | line.startswith("### "), "heading").otherwise("paragraph")
    return lines_of(documents).select("doc_id", "pos", kind.alias("type"), strip(F.regexp_replace(line, r"^#{1,3} ", "")).alias("content"))


def rich_markdown_elements(documents: DataFrame) -> DataFrame:
    """As markdown_elements, and: {N} sets the page N+1, rules are dropped, neighbouring lines with a pipe form one table, $$...$$ is a formula, "- " and "* " are list entries.

    A formula without content is dropped. The page before any marker is 1.
    """
    d = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "raw")).withColumn("line", strip(F.col("raw")))
    line = F.col("line")
    page, rule, pipe = line.rlike(r"^\{\d+\}"), line.rlike("^-{10,}"), F.contains(line, F.lit("|"))
    d = d.withColumn("kind", F.when(line == "", "blank").when(page, "page").when(rule, "rule").when(pipe, "table").when(line.startswith("$$") & line.endswith("$$"), "formula").when(line.startswith("# "), "title").when(line.startswith("## ") | line.startswith("### "), "heading").when(line.startswith("- ") | line.startswith("* "), "list").otherwise("paragraph"))
    # markers and rules vanish; a table ends at any line that isn't one
    d = running(d, "doc_id", "pos", last_marker=("max", F.when(F.col("kind") == "page", F.col("pos") * F.lit(1000000) + F.least(F.regexp_extract("line", r"^\{(\d+)\}", 1).try_cast("bigint"), F.lit(999999)))), breaks=("sum", F.when(F.col("kind") != "table", 1).otherwise(0)))
    d = d.withColumn("page_number", F.coalesce(F.pmod("last_marker", F.lit(1000000)) + 1, F.lit(1)).cast("int"))
    tables = d.where("kind = 'table'").groupBy("doc_id", "breaks").agg(F.min("pos").alias("pos"), F.min("page_number").alias("page_number"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("content"))
    rest = d.where(~F.col("kind").isin("table", "blank", "page", "rule"))
    content = F.when(F.col("kind") == "formula", strip(F.regexp_replace("line", r"^\$\$|\$\$$", ""))).when(F.col("kind").isin("title", "heading"), strip(F.regexp_replace("line", r"^#{1,3} ", ""))).otherwise(line)
    out = rest.select("doc_id", "pos", F.col("kind").alias("type"), "page_number", content.alias("content")).unionByName(tables.select("doc_id", "pos", F.lit("table").alias("type"), "page_number", "content"))
    return out.where(non_blank(F.col("content")))


def block_type(text: Column, font_size: Column) -> Column:
    """Type of a text block by its font size, or by capitals in short text."""
    upper = (F.upper(text) == text) & (F.lower(text) != text)
    return F.when(font_size > 16, "title").when(font_size > 14, "heading").when(upper & (F.length(text) < 100), "heading").otherwise("paragraph")


_HEADS = ("title", "heading")


def table_of_contents(elements: DataFrame) -> DataFrame:
    """Titles and headings with level (category_depth wins over 1 and 2), the first 100 characters and page (0 if unknown)."""
    level = F.coalesce(F.when(F.col("category_depth") != 0, F.col("category_depth")), F.when(F.col("type") == "title", 1).otherwise(2))
    return clean_elements(elements).where(F.col("type").isin(*_HEADS)).select("doc_id", "pos", level.cast("int").alias("level"), F.substring("content", 1, 100).alias("title"), F.coalesce("page_number", F.lit(0)).alias("page"))


def heading_levels(kind: Column, level: Column) -> Column:
    """Level of a heading row: 0 for titles, its own for headings (1 if null), null for other rows."""
    return F.when(kind == "title", 0).when(kind.isin("heading", "section_header"), F.coalesce(level, F.lit(1)))


def heading_paths(items: DataFrame, levels: int = 10) -> DataFrame:
    """(doc_id, pos, path): the open headings before or at each item of (doc_id, pos, level, heading), outermost first.

    level is null for other items, and that of headings under ``levels`` (deeper ones count as the deepest). A heading closes those of its level and below, so the
    last heading of a level is open where none of a lower level came after it: running maxima, however long a document is.
    """
    level = F.when(F.col("level").isNotNull(), F.least(F.greatest(F.col("level"), F.lit(0)), F.lit(levels - 1)))
    last = {f"l{k}": ("max", F.when(level == k, F.struct(F.col("pos").alias("pos"), F.col("heading").alias("heading")))) for k in range(levels)}
    r = running(items, "doc_id", "pos", **last)
    place = lambda k: F.coalesce(F.col(f"l{k}.pos"), F.lit(-1))
    shut = lambda k: F.greatest(F.lit(-1), F.lit(-1), *(place(j) for j in range(k)))
    return r.select("doc_id", "pos", F.array_compact(F.array(*(F.when(place(k) > shut(k), F.col(f"l{k}.heading")) for k in range(levels)))).alias("path"))


def parents(elements: DataFrame) -> DataFrame:
    """(doc_id, pos, type, depth, parent_pos): the nearest heading before body elements; titles have depth 1, headings 2."""
    e = running(clean_elements(elements), "doc_id", "pos", head=("max", F.when(F.col("type").isin(*_HEADS), F.col("pos"))))
    body = F.col("type").isin("paragraph", "narrative_text", "table", "formula", "list", "list_item")
    return e.select("doc_id", "pos", "type", F.when(F.col("type") == "title", 1).when(F.col("type") == "heading", 2).alias("depth"), F.when(body, F.col("head")).alias("parent_pos"))


def confidence_of(kind: Column, length: Column) -> Column:
    """Confidence by type and length of stripped text; fixed values, already rounded."""
    band = lambda a, b, c: F.when(length < 5, a).when(length > 100, c).otherwise(b)
    return F.when(kind.isin("formula", "title"), band(0.66, 0.95, 1.0)).when(kind.isin("table", "heading"), band(0.63, 0.9, 0.95)).when(kind.isin("paragraph", "narrative_text", "list"), band(0.59, 0.85, 0.9)).otherwise(band(0.56, 0.8, 0.85))


def estimated_confidence(elements: DataFrame) -> DataFrame:
    e = clean_elements(elements)
    return e.select("doc_id", "pos", confidence_of(F.col("type"), F.length(strip(F.col("content")))).alias("estimate"))


def page_counts(elements: DataFrame) -> DataFrame:
    return elements.where("doc_id is not null").groupBy("doc_id").agg(F.coalesce(F.max("page_number"), F.lit(0)).cast("int").alias("pages"))


#: Formats by extension, in the order they are tried, and by MIME type.
EXTENSIONS = {
    ".pdf": "pdf", ".docx": "docx", ".doc": "docx", ".html": "html", ".htm": "html", ".mp4": "video", ".avi": "video", ".mov": "video", ".mkv": "video", ".webm": "video",
    ".mp3": "audio", ".wav": "audio", ".ogg": "audio", ".m4a": "audio", ".flac": "audio",
}
MIME_TYPES = {
    "application/pdf": "pdf", "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx", "application/msword": "docx", "text/html": "html", "application/xhtml+xml": "html",
    "video/mp4": "video", "video/mpeg": "video", "video/quicktime": "video", "video/x-msvideo": "video", "video/x-matroska": "video",
    "audio/mpeg": "audio", "audio/wav": "audio", "audio/x-wav": "audio", "audio/ogg": "audio", "audio/mp4": "audio",
}


def url_format(url: Column) -> Column:
    """Format of a URL by its ending; other web addresses are html, all else unknown."""
    low = F.lower(url)
    out = None
    for end, kind in EXTENSIONS.items():
        out = F.when(low.endswith(end), kind) if out is None else out.when(low.endswith(end), kind)
    return out.when(low.startswith("http://") | low.startswith("https://"), "html").otherwise("unknown")


def _lookup(c: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for p in table.items() for x in p]), c)


def extension(path: Column) -> Column:
    """The last suffix in lower case with its point, empty if there is none."""
    return F.regexp_extract(F.lower(path), r"[^/](\.[^./]+)$", 1)


def mime_type(path: Column, head: Column | None = None) -> Column:
    """MIME type by the first bytes where given (BINARY) and known, else by the extension, else null."""
    ends = {
        ".pdf": "application/pdf", ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", ".doc": "application/msword", ".html": "text/html", ".htm": "text/html",
        ".mp4": "video/mp4", ".avi": "video/x-msvideo", ".mov": "video/quicktime", ".mkv": "video/x-matroska", ".webm": "video/webm",
        ".mp3": "audio/mpeg", ".wav": "audio/x-wav", ".ogg": "audio/ogg", ".m4a": "audio/mp4", ".flac": "audio/flac",
    }
    by_name = _lookup(extension(path), ends)
    if head is None:
        return by_name
    h = F.hex(F.substring(head, 1, 16))
    text = F.lower(F.decode(F.substring(head, 1, 64), "ISO-8859-1"))
    riff = h.startswith("52494646")
    return (
        F.when(h.startswith("255044462D"), "application/pdf").when(h.startswith("504B0304") & (extension(path) == ".docx"), ends[".docx"]).when(h.startswith("D0CF11E0A1B11AE1") & (extension(path) == ".doc"), ends[".doc"])
        .when(F.substring(h, 9, 16) == "667479704D344120", "audio/mp4").when(F.substring(h, 9, 16).startswith("667479707174"), "video/quicktime").when(F.substring(h, 9, 8) == "66747970", "video/mp4")
        .when(riff & (F.substring(h, 17, 8) == "57415645"), "audio/x-wav").when(riff & (F.substring(h, 17, 8) == "41564920"), "video/x-msvideo").when(h.startswith("1A45DFA3"), F.when(extension(path) == ".webm", "video/webm").otherwise("video/x-matroska"))
        .when(h.startswith("494433") | h.startswith("FFFB"), "audio/mpeg").when(h.startswith("664C6143"), "audio/flac").when(h.startswith("4F676753"), "audio/ogg")
        .when(text.rlike(r"^\s*(?:<!doctype html|<html)"), "text/html").otherwise(by_name)
    )


def file_format(path: Column, head: Column | None = None) -> Column:
    """Format of a file by its first bytes where given (BINARY), else by its extension, else unknown."""
    by_name = F.coalesce(_lookup(extension(path), EXTENSIONS), F.lit("unknown"))
    return by_name if head is None else F.coalesce(_lookup(mime_type(path, head), MIME_TYPES), by_name)


def format_is(path: Column, expected: Column, head: Column | None = None) -> Column:
    return file_format(path, head) == expected


def format_info(files: DataFrame, head: str | None = "head") -> DataFrame:
    """(path, format, mime_type, extension, file_name, file_size) of files (path, length, head)."""
    h = F.col(head) if head else None
    path = F.col("path")
    return files.select("path", file_format(path, h).alias("format"), mime_type(path, h).alias("mime_type"), extension(path).alias("extension"), F.regexp_extract(path, r"[^/]*$", 0).alias("file_name"), F.col("length").alias("file_size"))

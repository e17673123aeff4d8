"""Command line: python -m pagemill.cli COMMAND …"""

from __future__ import annotations

import argparse
import json
import logging
import re
import sys
import uuid
from datetime import date, datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.config import BenchmarkConfig, Settings, read_mapping, suite
from pagemill.operators import benchmark, chunking, elements, export, runner, sync
from pagemill.operators.baselines import BaselineStore
from pagemill.operators.evaluation import LayoutEvaluator
from pagemill.plans.stages import ship_package
from pagemill.sources import annotations, files
from pagemill.sources.parsers import Parser, default_registry, route, routed_elements


def uuid_option(text: str) -> str:
    """A UUID in canonical spelling."""
    try:
        return str(uuid.UUID(text))
    except ValueError as e:
        raise argparse.ArgumentTypeError(f"{text} isn't a UUID") from e


def date_option(text: str) -> date:
    """A date as YYYY-MM-DD exactly."""
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise argparse.ArgumentTypeError("dates are written YYYY-MM-DD")
    try:
        return date.fromisoformat(text)
    except ValueError as e:
        raise argparse.ArgumentTypeError(str(e)) from e


def time_option(text: str) -> datetime:
    """An ISO time; without a zone it is UTC."""
    try:
        t = datetime.fromisoformat(text)
    except ValueError as e:
        raise argparse.ArgumentTypeError(str(e)) from e
    return t if t.tzinfo else t.replace(tzinfo=timezone.utc)


def session() -> SparkSession:
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship_package(spark)
    return spark


def parsed_elements(spark: SparkSession, path: str, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(routed, elements) of the files at a path, through the default parsers."""
    found = files.checked(files.files(spark, path), settings.max_file_size_mb, ("pdf", "html", "docx", "unknown"))
    routed = route(found.where("error is null or format = 'unknown'"), default_registry())
    e = routed_elements(routed).withColumn("doc_id", F.xxhash64("path")).withColumnRenamed("type", "element_type")
    return routed, e.withColumn("category_depth", F.lit(None).cast("int")).withColumn("confidence", F.lit(None).cast("double"))


def chunked(e: DataFrame, settings: Settings, strategy: str) -> DataFrame:
    if strategy == "by_title":
        return chunking.by_title_chunks(e, settings.chunk_size, settings.combine_under, settings.respect_pages)
    return chunking.token_chunks(e, settings.chunk_size, settings.chunk_overlap)


def process(spark: SparkSession, a: argparse.Namespace, settings: Settings) -> int:
    """Parses files, chunks them and exports or previews; exit 1 if a file failed."""
    routed, e = parsed_elements(spark, a.path, settings)
    chunks = chunked(e, settings, a.strategy) if a.strategy != "none" else None
    if a.output:
        docs = routed.select(F.xxhash64("path").alias("doc_id"), F.col("path").alias("source_path"), "parser")
        c = chunks if chunks is not None else chunking.token_chunks(e.limit(0))
        c = c.withColumn("chunk_id", sync.chunk_id(F.col("doc_id"), F.col("chunk_index"), F.col("content"))).withColumn("char_count", F.length("content"))
        out = export.export(docs, e, c, a.format, ["source_path", "parser"])
        Path(a.output).mkdir(parents=True, exist_ok=True)
        export.write_files(out.select(F.concat(F.col("doc_id").cast("string"), "suffix").alias("name"), "content"), a.output).write.format("noop").mode("overwrite").save()
    else:
        export.preview(elements.clean_elements(e), "doc_id", "pos", 10).show(truncate=False)
        if chunks is not None:
            export.preview(chunks, "doc_id", "chunk_index", 3).show(truncate=False)
    if chunks is not None:
        chunks.agg(F.count(F.lit(1)).alias("chunks"), F.coalesce(F.avg("token_count"), F.lit(0.0)).alias("mean_tokens")).show()
    failed = routed.where("not success").count()
    print(f"{failed} files failed")
    return int(failed > 0)


def chunk(spark: SparkSession, a: argparse.Namespace, settings: Settings) -> int:
    """One file's chunk set, without consent: a document with a tax label is refused."""
    labels = spark.createDataFrame([(a.category, a.document_type)], "category string, document_type string")
    if labels.where(sync.is_tax_return(F.col("category"), F.col("document_type"))).count():
        print("tax returns need consent and aren't chunked from the command line", file=sys.stderr)
        return 2
    _, e = parsed_elements(spark, a.path, settings)
    c = chunked(e, settings, "by_title")
    record = e.select("doc_id").distinct().select(
        F.lit(a.document_id).alias("id"), "doc_id", F.lit(a.entity_id).alias("entity_id"), F.lit(a.document_type).alias("document_type"), F.lit(a.category).alias("category"),
        F.lit(True).alias("is_confidential"), F.lit(False).alias("consent_on_file"), F.lit(a.title).alias("title"), F.lit(a.document_date).cast("date").alias("document_date"), F.lit(a.sha256).alias("sha256"),
    )
    headers, entries = sync.chunk_sets(record, c)
    Path(a.output).mkdir(parents=True, exist_ok=True)
    export.write_files(sync.set_files(headers, entries).select(F.concat("document_id", F.lit(".json")).alias("name"), F.col("json").alias("content")), a.output, int(settings.chunks_file_mode, 8)).write.format("noop").mode("overwrite").save()
    errors = [r["error"] for r in headers.where("error is not null").select("error").collect()]  # one document
    print("\n".join(errors) or "written")
    return int(bool(errors))


def store(spark: SparkSession, a: argparse.Namespace, settings: Settings) -> int:
    """Synchronises chunk sets with listings in Parquet; exit 1 on any failure."""
    read = lambda name: spark.read.parquet(f"{a.tables}/{name}")
    updated = sync.latest_records(read("records"))
    if a.updated_since:
        updated = updated.where(F.col("updated_at") >= F.lit(a.updated_since))
    tax = sync.latest_records(read("records")).where(sync.is_tax_return(F.col("category"), F.lit(None).cast("string")))
    outcomes = sync.sync_documents(updated, tax, read("stored"), sync.latest_records(read("records")), read("files"))
    report = sync.run_report(outcomes, updated).first().asDict()
    print(json.dumps({k: str(v) if isinstance(v, datetime) else v for k, v in report.items()}))
    return int(report["failed"] > 0)


def health(spark: SparkSession, a: argparse.Namespace, settings: Settings) -> int:
    rows = default_registry().health()
    for name, priority, ok in rows:
        print(f"{name:20} {priority:5} {'healthy' if ok else 'unavailable'}")
    return 0 if any(ok for *_, ok in rows) else 1


def _truth(spark: SparkSession, folder: str | None) -> DataFrame:
    if folder:
        return annotations.coco_annotations(annotations.read_coco(spark, folder))
    return spark.createDataFrame([], "document_id string, ord int, annotation_id string, category string, category_id bigint, x0 double, y0 double, x1 double, y1 double, area double")


def run(spark: SparkSession, a: argparse.Namespace, settings: Settings) -> int:
    """A benchmark of the parsers over a corpus; stores its rows and prints the overview."""
    config = BenchmarkConfig.from_mapping(read_mapping(a.config)) if a.config else BenchmarkConfig(a.documents, a.truth, sample=a.sample)
    rows, overview = runner.orchestrate(spark, config, default_registry(), _truth(spark, config.truth), LayoutEvaluator())
    export.save_results(rows, a.output)
    overview.show(truncate=False)
    return 0


_ROWS = "dataset string, parser string, id string, metric string, value double, success boolean, error string, seconds double"


def report(spark: SparkSession, a: argparse.Namespace, settings: Settings) -> int:
    """Reports of stored rows as CSV and HTML."""
    rows = export.load_results(spark, a.results, _ROWS)
    summary = benchmark.metric_summary(rows)
    names = sorted(r[0] for r in rows.select("metric").distinct().collect())  # metrics are few
    table = export.metric_table(summary, names)
    if a.csv:
        export.write_csv(table, a.csv)
    if a.html:
        Path(a.html).write_text(export.html_report("Benchmark", {"Metrics": summary.drop("least", "most"), "Failures": benchmark.failure_report(rows)}), encoding="utf-8")
    table.show(truncate=False)
    return 0


def run_configs(spark: SparkSession, a: argparse.Namespace, settings: Settings) -> int:
    """A configuration suite over a corpus; stores one result per configuration."""
    by_name = {p.name: p for p in default_registry().parsers}
    make = lambda c: Parser(f"{c.parser}", by_name[c.parser].parse, by_name[c.parser].formats)
    found = files.checked(files.files(spark, a.documents))
    rows = runner.run_suite(found, _truth(spark, a.truth), [c for c in suite(read_mapping(a.suite)) if c.parser in by_name], make, LayoutEvaluator())
    runner.suite_results(rows).write.mode("overwrite").parquet(a.output)
    return 0


def baseline_create(spark: SparkSession, a: argparse.Namespace, settings: Settings) -> int:
    results = spark.read.parquet(a.results)
    facts = benchmark.hardware_profile() | {"gpu_model": None, "total_documents": results.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]}
    profile = spark.createDataFrame([tuple(facts.get(k) for k in ("gpu_model", "cpu_cores", "total_documents", "hardware_hash"))], "gpu_model string, cpu_cores int, total_documents bigint, hardware_hash string")
    print(f"{a.name}:v{BaselineStore(spark, a.store).save(a.name, results, profile)}")
    return 0


def baseline_compare(spark: SparkSession, a: argparse.Namespace, settings: Settings) -> int:
    """Two baselines, given as name, name:latest or name:v3."""
    s = BaselineStore(spark, a.store)
    compared = benchmark.compare_results(s.named(a.one), s.named(a.two))
    compared.show(truncate=False)
    benchmark.comparison_summary(compared.withColumnRenamed("time_change", "change")).show()
    return 0


def compare_configs(spark: SparkSession, a: argparse.Namespace, settings: Settings) -> int:
    results = spark.read.parquet(a.results)
    benchmark.best_configurations(results).show(truncate=False)
    benchmark.tradeoffs(results).show(truncate=False)
    benchmark.recommended(results, a.target).show(truncate=False)
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pagemill")
    top.add_argument("--verbose", action="store_true")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, fn, *options: tuple) -> None:
        p = sub.add_parser(name, help=(fn.__doc__ or name).split(";")[0].strip())
        p.set_defaults(run=fn)
        for flags, kw in options:
            p.add_argument(*flags.split(), **kw)

    need = {"required": True}
    command("process", process, ("path", {}), ("--strategy", {"choices": ["basic", "by_title", "none"], "default": "basic"}), ("--output", {}), ("--format", {"choices": ["json", "markdown", "both", "text"], "default": "json"}))
    command("chunk", chunk, ("path", {}), ("--document-id", need | {"type": uuid_option}), ("--entity-id", need | {"type": uuid_option}), ("--sha256", need), ("--category", {}), ("--document-type", {}), ("--title", {}), ("--document-date", {"type": date_option}), ("--output", need))
    command("sync", store, ("tables", {}), ("--updated-since", {"type": time_option}))
    command("health", health)
    command("benchmark", run, ("--config", {}), ("--documents", {}), ("--truth", {}), ("--sample", {"type": int}), ("--output", need))
    command("benchmark-report", report, ("results", {}), ("--csv", {}), ("--html", {}))
    command("benchmark-configs", run_configs, ("suite", {}), ("--documents", need), ("--truth", {}), ("--output", need))
    command("baseline-create", baseline_create, ("name", {}), ("--results", need), ("--store", need))
    command("baseline-compare", baseline_compare, ("one", {}), ("two", {}), ("--store", need))
    command("compare-configs", compare_configs, ("results", {}), ("--target", {"choices": ["speed", "accuracy", "balanced"], "default": "balanced"}))
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    settings = Settings.from_env()
    logging.basicConfig(level=logging.DEBUG if a.verbose else settings.log_level)
    return a.run(session(), a, settings)


if __name__ == "__main__":
    sys.exit(main())

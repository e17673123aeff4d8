"""Benchmark runs: files through parsers, elements through an evaluator, metrics into long rows and roll-ups."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.config import BenchmarkConfig, Configuration
from pagemill.operators import benchmark
from pagemill.operators.evaluation import Evaluator
from pagemill.plans.stages import stored
from pagemill.sources import files
from pagemill.sources.parsers import Parse, Parser, Registry, route, routed_elements


def document_id(path: str = "path"):
    """A file's name without folder and suffix."""
    return F.regexp_replace(F.regexp_extract(F.col(path), r"[^/]*$", 0), r"\.[^.]*$", "")


def run_parser(found: DataFrame, parser: Parser) -> DataFrame:
    """Files through one parser alone: route's rows with the seconds of each, measured where it ran."""
    timed = Registry()

    def parse(path: str, content: bytes, inner: Parse = parser.parse):
        began = time.perf_counter()
        rows = inner(path, content)
        return [*rows, ("seconds", repr(time.perf_counter() - began), None)]

    timed.add(Parser(parser.name, parse, parser.formats, parser.priority))
    r = route(found, timed)
    last = F.try_element_at("elements", F.lit(-1))
    seconds = F.when(last["type"] == "seconds", last["content"].cast("double"))
    return r.withColumn("seconds", seconds).withColumn("elements", F.filter("elements", lambda e: e["type"] != "seconds"))


def run_benchmark(found: DataFrame, truth: DataFrame, parser: Parser, evaluator: Evaluator, dataset: str = "default") -> DataFrame:
    """(dataset, parser, id, metric, value, success, error, seconds): the metrics of every document; one that fails to parse, or without truth, is a failure row."""
    parsed = stored(run_parser(found, parser).withColumn("id", document_id()), "parsed")
    e = routed_elements(parsed.withColumn("path", F.col("id"))).withColumnRenamed("path", "doc_id").withColumn("bbox", F.lit(None).cast("struct<x0:double,y0:double,x1:double,y1:double>"))
    scored = evaluator.evaluate(e, truth)
    failed = parsed.where("not success").select("id", F.lit("none").alias("metric"), F.lit(None).cast("double").alias("value"), F.lit(False).alias("success"), "error")
    rows = scored.unionByName(failed).join(parsed.select("id", "seconds"), "id", "left")
    return rows.select(F.lit(dataset).alias("dataset"), F.lit(parser.name).alias("parser"), "id", "metric", "value", "success", "error", "seconds")


def run_suite(found: DataFrame, truth: DataFrame, configurations: list[Configuration], make: Callable[[Configuration], Parser], evaluator: Evaluator) -> DataFrame:
    """run_benchmark for every configuration of a suite, with its name as ``config``. Configurations are few, documents many: each is one distributed pass."""
    out = None
    for c in configurations:
        rows = run_benchmark(found, truth, make(c), evaluator).withColumn("config", F.lit(c.name))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("a suite without configurations")
    return out


def suite_results(rows: DataFrame) -> DataFrame:
    """(ord, parser, config, time, quality, memory, rate, n) of run_suite's rows, for recommendations and comparisons; memory isn't measured on executors."""
    per_doc = rows.groupBy("parser", "config", "id").agg(F.max("seconds").alias("s"), F.avg("value").alias("q"), F.bool_and("success").alias("ok"))
    g = per_doc.groupBy("parser", "config").agg(F.avg("s").alias("time"), F.avg("q").alias("quality"), F.lit(0.0).alias("memory"), (F.count_if("ok") / F.count(F.lit(1))).alias("rate"), F.count(F.lit(1)).alias("n"))
    return g.select(F.concat_ws("/", "parser", "config").alias("ord"), "*")


def orchestrate(spark, config: BenchmarkConfig, registry: Registry, truth: DataFrame, evaluator: Evaluator) -> tuple[DataFrame, DataFrame]:
    """(rows, overview) of a benchmark over a corpus folder: every parser of the registry that the config names, all if it names none."""
    found = files.corpus(files.checked(files.files(spark, config.documents), supported=tuple({f for p in registry.parsers for f in p.formats})), config.sample, config.strategy, config.seed)
    chosen = [p for p in registry.parsers if not config.parsers or p.name in config.parsers]
    began = time.time()
    out = None
    for dataset in config.datasets:
        for p in chosen:
            rows = stored(run_benchmark(found, truth, p, evaluator, dataset), "benchmark-rows")
            out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no parser to run")
    docs = out.groupBy("dataset", "parser", "id").agg(F.bool_and("success").alias("success"))
    return out, benchmark.run_overview(docs, time.time() - began)

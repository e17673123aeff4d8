"""Aggregation of metrics and runs, baselines and recommendations."""

from __future__ import annotations

import hashlib
import os
import platform
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def metric_summary(metrics: DataFrame) -> DataFrame:
    """Per dataset, parser and metric of (dataset, parser, metric, value, success): mean, population deviation, least and most of successes, and the success rate over all."""
    ok = F.when(F.col("success"), F.col("value"))
    return metrics.groupBy("dataset", "parser", "metric").agg(F.avg(ok).alias("mean"), F.stddev_pop(ok).alias("std"), F.min(ok).alias("least"), F.max(ok).alias("most"), F.count(F.lit(1)).alias("n"), (F.count_if("success") / F.count(F.lit(1))).alias("success_rate"))


def metric_rollup(metrics: DataFrame) -> DataFrame:
    """metric means over (dataset, parser), dataset, and all in one pass."""
    return metrics.rollup("dataset", "parser").agg(F.avg(F.when(F.col("success"), F.col("value"))).alias("mean"), F.count(F.lit(1)).alias("n"), F.count_if(~F.col("success")).alias("n_failed"), F.grouping_id().cast("bigint").alias("level"))


def ranked_values(rows: DataFrame, keys: list[str], value: str, places: dict[str, Column], bins: int = 1024) -> DataFrame:
    """keys, n and, by name, the value at each 0-based place of the sorted values; places are columns of n.

    A histogram of ``bins`` equal ranges between the least and most value of each key tells in which range a place lies; only the distinct values of
    those ranges are ranked, so that no task sorts all values of a hot key. Nulls don't count.
    """
    v = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    edges = v.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_c").alias("n"))
    bin_of = F.least(F.coalesce(F.floor(F.try_divide((F.col("_v") - F.col("_lo")) * bins, F.col("_hi") - F.col("_lo"))), F.lit(0)), F.lit(bins - 1))
    binned = v.join(edges, keys).withColumn("_bin", bin_of)
    w = Window.partitionBy(*keys)
    counts = binned.groupBy(*keys, "_bin").agg(F.sum("_c").alias("_c"), F.first("n").alias("n"))  # at most ``bins`` rows a key
    counts = counts.withColumn("_before", F.sum("_c").over(w.orderBy("_bin")) - F.col("_c"))
    wanted = F.array(*(F.struct(F.lit(k).alias("name"), F.least(p.cast("bigint"), F.col("n") - 1).alias("place")) for k, p in places.items()))
    hit = counts.select(*keys, "_bin", "_before", "_c", F.explode(wanted).alias("_x")).where("_x.place >= _before and _x.place < _before + _c").drop("_c")
    near = binned.select(*keys, "_bin", "_v", "_c").join(hit, [*keys, "_bin"])
    upto = near.withColumn("_upto", F.col("_before") + F.sum("_c").over(Window.partitionBy(*keys, "_bin", "_x.name").orderBy("_v")))
    found = upto.groupBy(*keys).agg(*(F.min(F.when((F.col("_x.name") == k) & (F.col("_upto") > F.col("_x.place")), F.col("_v"))).alias(k) for k in places))
    return edges.select(*keys, "n").join(found, keys)


def run_statistics(runs: DataFrame, value: str = "total_time") -> DataFrame:
    """Mean, upper median and 95th value (0-based place floor(0.95 n)) per parser and config, by rank; nulls don't count."""
    keys = ["parser", "config"]
    ranks = ranked_values(runs, keys, value, {"median": F.floor(F.col("n") / 2), "p95": F.floor(F.col("n") * 0.95)})
    means = runs.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.round(F.avg(value), 3).alias("mean"))
    return ranks.join(means, keys).select(*keys, "n", "mean", "median", "p95")


def run_overview(metrics: DataFrame, seconds: float) -> DataFrame:
    """One row over (dataset, parser, success), a row per document and run: totals, rates and documents per hour of the whole run's seconds."""
    n, ok = F.count(F.lit(1)), F.count_if("success")
    rate = lambda c: F.coalesce(F.try_divide(c, n), F.lit(0.0))
    per_hour = n / F.lit(seconds) * 3600 if seconds > 0 else F.lit(0.0)
    return metrics.agg(n.alias("total_documents"), ok.alias("total_successful"), (n - ok).alias("total_failed"), rate(ok).alias("success_rate"), rate(n - ok).alias("failure_rate"), per_hour.alias("docs_per_hour"))


def overall_quality(*scores: str) -> Column:
    """Plain mean of the scores that aren't null, null without any."""
    known = F.filter(F.array(*(F.col(c).cast("double") for c in scores)), lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known))


def dataset_profile(files: DataFrame, size: str, kind: str) -> DataFrame:
    """Per type: files, bytes, and how many are under 1, under 10 and from 10 MB."""
    mb = F.col(size) / F.lit(1048576.0)
    return files.groupBy(F.coalesce(kind, F.lit("unknown")).alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.sum(size).cast("bigint").alias("bytes"), F.count_if(mb < 1).alias("small"), F.count_if((mb >= 1) & (mb < 10)).alias("medium"), F.count_if(mb >= 10).alias("large"))


def dataset_languages(documents: DataFrame) -> DataFrame:
    """(lang, n), an unknown language being "unknown"."""
    return documents.groupBy(F.coalesce(F.col("lang"), F.lit("unknown")).alias("lang")).agg(F.count(F.lit(1)).alias("n"))


def value_profile(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, n, mean, upper median and p95, which is the most for up to 20 values."""
    p95 = F.when(F.col("n") > 20, F.floor(F.col("n") * 0.95)).otherwise(F.col("n") - 1)
    means = rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.avg(value).alias("mean"))
    return ranked_values(rows, keys, value, {"median": F.floor(F.col("n") / 2), "p95": p95}).join(means, keys)


def hardware_profile() -> dict:
    """Facts of this host and their hash: 16 hex digits of the hash of the sorted facts."""
    facts = {"cpu_cores": os.cpu_count(), "machine": platform.machine(), "python_version": platform.python_version(), "system": platform.system()}
    return facts | {"hardware_hash": hashlib.sha256(str(dict(sorted(facts.items()))).encode()).hexdigest()[:16]}


def dataset_hash(ids: DataFrame, col: str) -> DataFrame:
    """16 hex digits of the hash of the number of ids and the first hundred of them."""
    n = ids.agg(F.count(F.lit(1)).alias("n"))
    first = ids.select(F.col(col).cast("string").alias("i")).orderBy("i").limit(100).agg(F.array_join(F.array_sort(F.collect_list("i")), ":").alias("s"))
    return n.crossJoin(F.broadcast(first)).select(F.substring(F.sha2(F.concat_ws(":", F.col("n").cast("string"), "s"), 256), 1, 16).alias("dataset_hash"))


def percent_change(base: Column, now: Column) -> Column:
    return F.when(base > 0, (now - base) / base * 100).otherwise(0.0)


def compare_baselines(one: DataFrame, two: DataFrame, value: str = "total_time") -> DataFrame:
    """Per parser and config that both have: means, percent change and the pooled t statistic with its degrees of freedom; the statistic is null without two rows and some variance."""
    side = lambda d, k: d.groupBy("parser", "config").agg(F.count(value).alias(f"n{k}"), F.avg(value).alias(f"m{k}"), F.var_samp(value).alias(f"v{k}"))
    j = side(one, 1).join(side(two, 2), ["parser", "config"])
    n1, n2 = F.col("n1"), F.col("n2")
    pooled = F.try_divide((n1 - 1) * F.col("v1") + (n2 - 1) * F.col("v2"), n1 + n2 - 2)
    t = F.when((n1 >= 2) & (n2 >= 2), F.try_divide(F.col("m1") - F.col("m2"), F.sqrt(pooled * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))))
    return j.select("parser", "config", F.col("m1").alias("mean_1"), F.col("m2").alias("mean_2"), percent_change(F.col("m1"), F.col("m2")).alias("change"), t.alias("t"), (n1 + n2 - 2).alias("df"))


def comparison_summary(compared: DataFrame) -> DataFrame:
    """Improvements (less time), regressions and the mean change."""
    return compared.agg(F.count_if(F.col("change") < 0).alias("improved"), F.count_if(F.col("change") > 0).alias("regressed"), F.round(F.coalesce(F.avg("change"), F.lit(0.0)), 2).alias("mean_change"))


def t_two_sided(t: float, df: float) -> float:
    """Two-sided p-value of Student's t, by the continued fraction of the incomplete beta function."""
    import math

    if df <= 0 or t != t:
        return float("nan")
    x, a, b = df / (df + t * t), df / 2, 0.5
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0

    def fraction(x, a, b):
        tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
        d = 1 / (d if abs(d) > tiny else tiny)
        h = d
        for m in range(1, 300):
            for k in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1 + k * d
                d = 1 / (d if abs(d) > tiny else tiny)
                c = 1 + k / c
                c = c if abs(c) > tiny else tiny
                h *= d * c
            if abs(d * c - 1) < 1e-12:
                break
        return h

    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x))
    return front * fraction(x, a, b) / a if x < (a + 1) / (a + b + 2) else 1 - front * fraction(1 - x, b, a) / b


def compare_results(one: DataFrame, two: DataFrame) -> DataFrame:
    """Results (ord, parser, config, time, memory, quality) of two baselines side by side, with rounded percent changes.

    Each of the first meets the first of the second with the same parser and config; others have no row.
    """
    cols = ("time", "memory", "quality")
    first = two.groupBy("parser", "config").agg(F.min_by(F.struct(*cols), "ord").alias("r"))
    changes = [F.round(percent_change(F.col(c), F.col(f"r.{c}")), 2).alias(f"{c}_change") for c in cols]
    return one.join(first, ["parser", "config"]).select("parser", "config", *(x for c in cols for x in (F.col(c).alias(f"{c}_1"), F.col(f"r.{c}").alias(f"{c}_2"))), *changes)


def significance(compared: DataFrame, level: float = 0.05) -> DataFrame:
    """Rows of compare_baselines with the two-sided p-value and whether it is under the level; null without a statistic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = [None if t is None else t_two_sided(t, d) for t, d in zip(b.column("t").to_pylist(), b.column("df").to_pylist())]
            flags = [None if x is None else x < level for x in p]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64()), pa.array(flags, pa.bool_())], names=[*b.schema.names, "p_value", "significant"])

    return compared.mapInArrow(run, f"{', '.join(f'{c} {t}' for c, t in compared.dtypes)}, p_value double, significant boolean")


def recommendations(results: DataFrame, target: str = "balanced") -> DataFrame:
    """(parser, config, score, confidence) of (ord, parser, config, time, quality, rate, n), best first, ties in the order of ord.

    The target is speed, accuracy or balanced, which is also what any other name means.
    """
    speed, accuracy = 1 / (F.col("time") + 0.1), F.coalesce("quality", F.lit(0.5))
    score = {"speed": speed, "accuracy": accuracy}.get(target, F.sqrt(speed * accuracy))
    scored = results.select("ord", "parser", "config", score.alias("score"), F.round(F.col("rate") * F.least(F.lit(1.0), F.col("n") / 100), 2).alias("confidence"))
    return scored.orderBy(F.desc("score"), "ord").drop("ord")


def recommended(results: DataFrame, target: str = "balanced") -> DataFrame:
    """The best of recommendations, with what is to be expected of it and a sentence that says why; no row without results."""
    why = F.concat(F.col("parser"), F.lit(" with "), F.col("config"), F.lit(" achieves "), F.format_number("time", 2), F.lit("s avg processing time "), F.when(F.col("quality") != 0, F.concat(F.lit("with "), F.format_number("quality", 2), F.lit(" quality score"))).otherwise(""))
    best = recommendations(results, target).limit(1)
    return best.join(results.select("parser", "config", "time", F.coalesce("quality", F.lit(0.0)).alias("quality"), "rate"), ["parser", "config"]).withColumn("rationale", why)


def best_configurations(results: DataFrame) -> DataFrame:
    """One row of (ord, parser, config, time, quality, memory): the fastest, the most accurate of those with any quality, and the one with least memory; the first wins ties."""
    name = F.concat_ws("/", "parser", "config")
    best = lambda c: F.min_by(name, F.struct(c, "ord"))
    accurate = F.min_by(name, F.when(F.col("quality") > 0, F.struct(-F.col("quality"), "ord")))
    return results.agg(best(F.col("time")).alias("fastest"), accurate.alias("most_accurate"), best(F.col("memory")).alias("least_memory"))


def tradeoffs(results: DataFrame) -> DataFrame:
    """(configuration, parser, speed, quality, memory), an unknown quality being 0."""
    return results.select(F.col("config").alias("configuration"), "parser", F.col("time").alias("speed"), F.coalesce("quality", F.lit(0.0)).alias("quality"), "memory")


def compatible_baselines(baselines: DataFrame, gpu: bool, cores: int, documents: int, tolerance: float = 0.2) -> DataFrame:
    """Baselines (…, gpu_model, cpu_cores, total_documents) of like hardware and data: a GPU in both or neither, and cores and documents within the tolerance of the larger; 0 and 0 are alike."""
    near = lambda c, x: F.coalesce(F.try_divide(F.abs(F.col(c) - x), F.greatest(F.col(c), F.lit(x))), F.lit(0.0)) <= tolerance
    return baselines.where((F.col("gpu_model").isNotNull() == F.lit(gpu)) & near("cpu_cores", cores) & near("total_documents", documents))


def target_comparison(summary: DataFrame, targets: DataFrame) -> DataFrame:
    """Means against targets (metric, target): delta is positive where better, which for errors is lower."""
    lower = F.contains(F.col("metric"), F.lit("error"))
    delta = F.when(lower, F.col("target") - F.col("mean")).otherwise(F.col("mean") - F.col("target"))
    return summary.join(targets, "metric").select("dataset", "parser", "metric", "mean", "target", delta.alias("delta"), (delta >= 0).alias("meets"))


def failure_category(message: Column) -> Column:
    """Category of an error message: the first rule that fits, else the message's first 60 characters; a null one is unknown."""
    m, low = F.coalesce(message, F.lit("Unknown error")), F.lower(F.coalesce(message, F.lit("")))
    has = lambda c, *words: reduce(lambda x, y: x | y, (F.contains(c, F.lit(w)) for w in words))
    return (
        F.when(has(m, "Ground truth", "not found"), "Missing ground truth").when(has(low, "layout"), "Layout detection error")
        .when(has(low, "parsing", "parse"), "Parsing error").when(has(low, "evaluation"), "Evaluation error").otherwise(F.substring(m, 1, 60))
    )


def failure_report(results: DataFrame, most: int = 10) -> DataFrame:
    """(dataset, parser, category, n) of failed results (dataset, parser, success, error): the most frequent categories of each dataset and parser."""
    n = results.where(~F.coalesce("success", F.lit(False))).groupBy("dataset", "parser", failure_category(F.col("error")).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("dataset", "parser").orderBy(F.desc("n"), "category")
    return n.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most).drop("k")


def by_priority(parsers: DataFrame) -> DataFrame:
    """Registered parsers (ord, parser, priority) in the order they are tried: by priority, then registration."""
    return parsers.orderBy("priority", "ord")


def first_success(attempts: DataFrame) -> DataFrame:
    """(doc_id, parser, priority) of the first successful attempt by priority, ties by parser; documents without one have nulls."""
    return attempts.groupBy("doc_id").agg(F.min(F.when(F.col("success"), F.struct("priority", "parser"))).alias("b")).select("doc_id", F.col("b.parser").alias("parser"), F.col("b.priority").alias("priority"))


def image_resolution(images: DataFrame, threshold: float = 150.0) -> DataFrame:
    """Per document of (doc_id, px_w, px_h, pt_w, pt_h): least, mean and most dots per inch, low ones and whether to upscale."""
    w, h = F.try_divide(F.col("px_w") * 72.0, F.col("pt_w")), F.try_divide(F.col("px_h") * 72.0, F.col("pt_h"))
    g = images.groupBy("doc_id").agg(F.min(F.least(w, h)).alias("least"), F.avg((w + h) / 2).alias("mean"), F.max(F.greatest(w, h)).alias("most"), F.count_if(F.least(w, h) < threshold).alias("n_low"))
    return g.withColumn("needs_upscaling", F.col("least") < threshold)


def scan_class(pages: DataFrame, n: int = 3) -> DataFrame:
    """digital, hybrid or scanned by the mean characters of the first pages of (doc_id, page, n_chars)."""
    m = pages.where(F.col("page") <= n).groupBy("doc_id").agg(F.avg("n_chars").alias("mean_chars"))
    return m.select("doc_id", F.when(F.col("mean_chars") > 500, "digital").when(F.col("mean_chars") > 100, "hybrid").otherwise("scanned").alias("kind"), F.when(F.col("mean_chars") > 500, 0.3).when(F.col("mean_chars") > 100, 0.6).otherwise(0.9).alias("complexity"))


def requests_in_window(events: DataFrame, seconds: int = 60, limit: int = 20) -> DataFrame:
    """Each event with the number of its user's events in the seconds up to it, and whether that is over the limit.

    Users are partitioned by time blocks of ``seconds`` with the block before as context, so that one busy user is spread over tasks.
    """
    sec = F.unix_micros(F.col("ts").cast("timestamp"))
    e = events.where(F.col("ts").isNotNull()).select("event_id", "user_id", sec.alias("us"))
    block = F.floor(F.col("us") / (seconds * 1000000))
    both = e.withColumn("own", block).withColumn("block", F.explode(F.array(block, block + 1)))
    w = Window.partitionBy("user_id", "block").orderBy("us").rangeBetween(-seconds * 1000000, 0)
    n = both.withColumn("n_requests", F.count(F.lit(1)).over(w)).where("own = block")
    return n.select("event_id", "user_id", "n_requests", (F.col("n_requests") > limit).alias("limited"))

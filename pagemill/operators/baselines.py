"""A store of benchmark baselines by name and version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.plans.stages import SharedFiles


class BaselineStore:
    """Versioned results under a folder: ``results/name=…/version=…`` and ``profiles/…`` with one row of hardware and data facts each.

    A version is claimed by creating its mark in one step, so two writers never share one; only versions marked as done are listed. An unreadable
    store is an error and never an empty one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), SharedFiles(spark)

    def versions(self, name: str) -> list[int]:
        return sorted(int(v) for v in self.files.names(f"{self.path}/done/{name}"))

    def names(self) -> list[str]:
        return self.files.names(f"{self.path}/done")

    def latest(self, name: str) -> int | None:
        return max(self.versions(name), default=None)

    def save(self, name: str, results: DataFrame, profile: DataFrame) -> int:
        """Stores results and a one-row profile as the next version of a name and returns the version."""
        version = (self.latest(name) or 0) + 1
        claimed = [int(v) for v in self.files.names(f"{self.path}/claims/{name}")]
        version = max([version, *(v + 1 for v in claimed)])
        self.files.mark(f"{self.path}/claims/{name}/{version}")
        for what, df in (("results", results), ("profiles", profile)):
            df.write.mode("overwrite").parquet(f"{self.path}/{what}/name={name}/version={version}")
        self.files.mark(f"{self.path}/done/{name}/{version}")
        return version

    def load(self, name: str, version: int | None = None, what: str = "results") -> DataFrame:
        """A version's rows, the latest by default; a missing one is a KeyError."""
        v = version if version is not None else self.latest(name)
        if v is None or v not in self.versions(name):
            raise KeyError(f"no baseline {name} v{v}")
        return self.spark.read.parquet(f"{self.path}/{what}/name={name}/version={v}")

    def named(self, spec: str) -> DataFrame:
        """The results of ``name``, ``name:latest`` or ``name:v3``."""
        name, _, v = spec.partition(":")
        return self.load(name, None if v in ("", "latest") else int(v.removeprefix("v")))

    def profiles(self) -> DataFrame | None:
        """(name, version, …) of all versions; None without any. Versions are few."""
        out = None
        for name in self.names():
            for v in self.versions(name):
                p = self.load(name, v, "profiles").select(F.lit(name).alias("name"), F.lit(v).alias("version"), "*")
                out = p if out is None else out.unionByName(p, allowMissingColumns=True)
        return out

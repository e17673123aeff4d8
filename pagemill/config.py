"""Settings from the environment and configuration suites from files."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

PREFIX = "PAGEMILL_"


@dataclass(frozen=True)
class Settings:
    """Settings of a run; each may be given as PAGEMILL_<NAME>, and malformed or out-of-range values are errors."""

    chunk_size: int = 1000
    chunk_overlap: int = 200
    chunk_max_tokens: int = 512
    combine_under: int = 200
    respect_pages: bool = False
    max_file_size_mb: float = 500.0
    quality_good: float = 0.85
    quality_acceptable: float = 0.70
    storage_path: str = "./data"
    chunks_file_mode: str = "0644"
    enable_ocr: bool = True
    ocr_languages: tuple[str, ...] = ("eng",)
    log_level: str = "INFO"

    def __post_init__(self):
        if self.chunk_max_tokens < 32:
            raise ValueError("chunk_max_tokens must be at least 32")
        if self.chunk_size < 1 or not 0 <= self.chunk_overlap:
            raise ValueError("chunk_size must be positive and chunk_overlap not negative")
        if not 0 <= self.quality_acceptable <= self.quality_good <= 1:
            raise ValueError("quality thresholds must rise within 0 and 1")
        if self.max_file_size_mb <= 0:
            raise ValueError("max_file_size_mb must be positive")
        int(self.chunks_file_mode, 8)

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        given = {f.name: _typed(env[PREFIX + f.name.upper()], f.default, f.name) for f in fields(cls) if PREFIX + f.name.upper() in env}
        return cls(**given)

    def parser_config(self) -> dict[str, Any]:
        return {k: getattr(self, k) for k in ("max_file_size_mb", "enable_ocr", "ocr_languages")}

    def prepared_storage(self) -> Path:
        """The storage folder, made where it is missing."""
        path = Path(self.storage_path)
        path.mkdir(parents=True, exist_ok=True)
        return path


def _typed(value: str, default: Any, name: str) -> Any:
    if isinstance(default, bool):
        low = value.strip().lower()
        if low not in ("1", "true", "yes", "0", "false", "no"):
            raise ValueError(f"{name} must be true or false")
        return low in ("1", "true", "yes")
    if isinstance(default, tuple):
        return tuple(x.strip() for x in value.split(",") if x.strip())
    return type(default)(value)


def quality_level(score: float) -> str:
    """excellent from 0.95, good from 0.85, acceptable from 0.70, else poor."""
    return next((n for n, least in (("excellent", 0.95), ("good", 0.85), ("acceptable", 0.70)) if score >= least), "poor")


def read_mapping(path: str) -> dict:
    """A YAML or JSON file that holds one mapping; YAML needs its library."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        found = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as e:
            raise ValueError("YAML files need the yaml library; JSON files don't") from e
        found = yaml.safe_load(text)
    if not isinstance(found, dict):
        raise ValueError(f"{path} doesn't hold a mapping")
    return found


@dataclass(frozen=True)
class Configuration:
    """One parser with its options; the options label the run and are handed to the parser."""

    parser: str
    name: str
    options: dict = field(default_factory=dict)


def suite(mapping: dict) -> list[Configuration]:
    """The configurations of a suite: lists under ``<parser>_configs``, where a list that is null is empty."""
    out = []
    for key, rows in mapping.items():
        if key.endswith("_configs"):
            for n, row in enumerate(rows or []):
                out.append(Configuration(key.removesuffix("_configs"), str(row.get("name", f"config_{n + 1}")), {k: v for k, v in row.items() if k != "name"}))
    return out


@dataclass(frozen=True)
class BenchmarkConfig:
    """What a benchmark runs over; workers, batches and time limits are Spark's business but must make sense."""

    documents: str
    truth: str | None = None
    datasets: tuple[str, ...] = ("default",)
    parsers: tuple[str, ...] = ()
    sample: int | None = None
    strategy: str = "random"
    seed: int = 42
    workers: int = 1
    batch_size: int = 1
    timeout_s: int = 300

    def __post_init__(self):
        if min(self.workers, self.batch_size, self.timeout_s) < 1:
            raise ValueError("workers, batch_size and timeout_s must be at least 1")

    @classmethod
    def from_mapping(cls, mapping: dict) -> BenchmarkConfig:
        known = {f.name for f in fields(cls)}
        unknown = sorted(set(mapping) - known)
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in mapping.items()})

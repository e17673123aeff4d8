"""A PySpark-native engine for document analytics; submodules are loaded when they are first used."""

from importlib import import_module

_MODULES = {m: f"pagemill.operators.{m}" for m in ("baselines", "benchmark", "chunking", "elements", "evaluation", "export", "orphans", "runner", "scores", "sync")}
__all__ = sorted(_MODULES)


def __getattr__(name: str):
    if name in _MODULES:
        return import_module(_MODULES[name])
    raise AttributeError(f"module 'pagemill' has no attribute {name!r}")

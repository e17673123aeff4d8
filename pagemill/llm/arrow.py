"""Arrow-batch plumbing for the operators that need Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, most: int = 0) -> DataFrame:
    """Applies fn to each Arrow batch, in slices of ``most`` rows where given, which bounds the memory of what works on whole batches; empty results are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            step = most or max(b.num_rows, 1)
            for i in range(0, b.num_rows, step):
                if (out := fn(b.slice(i, step))) is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


class Memo(dict):
    """A dict that computes missing values and forgets everything at a size bound; results don't depend on it."""

    def __init__(self, fn: Callable, bound: int = 200_000):
        super().__init__()
        self.fn, self.bound = fn, bound

    def __missing__(self, key):
        if len(self) >= self.bound:
            self.clear()
        value = self[key] = self.fn(key)
        return value

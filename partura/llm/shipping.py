"""Python steps on executors that need not have this package installed."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    path = os.path.join(tempfile.mkdtemp(prefix="partura-src-"), "partura_llm_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, f"partura/{file.relative_to(package)}")
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """mapInArrow by a function of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def frugal(run):
    """A step that gives free memory back when its task ends: the worker lives on, idle or for other steps."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library, which has no such call
            pass

    return step

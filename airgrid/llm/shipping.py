"""Sending the package to the executors, which need not have it installed."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame

_SENT: set[str] = set()


def give_back() -> None:
    """Return freed memory to the system, as workers wait for other tasks with what they hold."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
        if trim is not None:
            trim(0)


def releasing(function):
    """``function`` of batches, with the memory given back at its end."""

    def run(batches):
        yield from function(batches)
        give_back()

    return run


def in_tasks(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with this package importable inside the tasks."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SENT:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        top = os.path.dirname(package)
        path = os.path.join(tempfile.mkdtemp(prefix="package-"), "airgrid_package.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, top))
        context.addPyFile(path)
        _SENT.add(context.applicationId)
    return df.mapInArrow(releasing(function), schema)

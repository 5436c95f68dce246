"""Python workers: the package at hand, and memory given back after each batch."""

from __future__ import annotations

import atexit
import ctypes
import functools
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import SparkSession

import tidemark

_shipped: set[str] = set()


def ready(spark: SparkSession) -> None:
    """Hands the package to the executors through Spark, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(tidemark.__file__))
    folder = tempfile.mkdtemp(prefix="tidemark-code-")  # Spark serves the file until the end
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    copy = os.path.join(folder, "copy", "tidemark")
    shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__"))
    archive = shutil.make_archive(
        os.path.join(folder, "tidemark"), "zip", os.path.dirname(copy), "tidemark"
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def release() -> None:
    """Gives freed memory back to the system: workers stay alive between tasks, and what a large
    batch took would otherwise stay with each of them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a partition that releases memory after each output."""

    @functools.wraps(work)
    def over_batches(batches: Iterator) -> Iterator:
        for found in work(batches):
            yield found
            del found
            release()

    return over_batches


def lean_group(work: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable:
    """A function of a group that releases memory after each group."""

    @functools.wraps(work)
    def over_group(frame: pd.DataFrame) -> pd.DataFrame:
        try:
            return work(frame)
        finally:
            release()

    return over_group

"""Ship the package to the executors; submit independent small jobs at the same time."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def side_by_side(spark: SparkSession, work: Callable, items: Iterable, at_once: int = 8) -> list:
    """Results of ``work(item)`` in item order; each call submits its own Spark jobs."""
    with ThreadPoolExecutor(at_once) as pool:
        submitted = [pool.submit(inheritable_thread_target(spark)(work), item) for item in items]
        return [one.result() for one in submitted]


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)  # the driver's file server hands it to every executor
        _shipped.add(context.applicationId)

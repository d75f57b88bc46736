"""Python code for the workers: the package as a zip, sent once per application."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SENT:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(package)
    target = os.path.join(tempfile.mkdtemp(prefix=f"{name}-code-"), f"{name}.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    out.write(path, os.path.join(name, os.path.relpath(path, package)))
    sc.addPyFile(target)
    _SENT.add(sc.applicationId)


def shipped(operator: Callable) -> Callable:
    """An operator on a table that sends the package first."""
    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **kwargs):
        ship(docs.sparkSession)
        return operator(docs, *args, **kwargs)
    return run

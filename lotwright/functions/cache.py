"""Reuse of built Column expressions.

Building a Column in classic PySpark costs many driver round trips; the
large expression sets here (car-name parsing, gold projection, SQL gate) do
not depend on the DataFrame they are applied to, so each set is built once
per Spark application and reused.  Keyed by application id, so a restarted
context never sees stale JVM objects.
"""

from __future__ import annotations

import functools

from pyspark import SparkContext


def per_application(fn):
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args):
        sc = SparkContext._active_spark_context
        key = (sc.applicationId if sc is not None else None, args)
        if key not in cache:
            cache[key] = fn(*args)
        return cache[key]
    return wrapper

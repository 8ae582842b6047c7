"""Build large Column expressions once per JVM.

Expressions here are unresolved trees over column *names*, so one tree can
serve every DataFrame; building it again would only repeat thousands of
driver-to-JVM calls.
"""

from __future__ import annotations

import functools

from pyspark import SparkContext


def per_jvm(fn):
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args):
        sc = SparkContext._active_spark_context
        key = (id(sc), args)
        if key not in cache:
            cache[key] = fn(*args)
        return cache[key]
    return wrapper

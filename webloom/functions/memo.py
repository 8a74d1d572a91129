"""Memoise Column builders.

Large extraction expressions take thousands of Py4J calls to build.  Column
objects are immutable and name-based, so a builder called again with the
same column names (and plain parameters) can hand back the Column it built
before.  The cache is tied to the running SparkContext.
"""

from __future__ import annotations

import functools

from pyspark import SparkContext

_CACHE: dict = {}
_STATE: dict = {"app": None}
_PLAIN = (str, int, float, bool, type(None))


def _plain(x) -> bool:
    if isinstance(x, _PLAIN):
        return True
    if isinstance(x, (tuple, frozenset)):
        return all(_plain(v) for v in x)
    return False


def cached_column(fn):
    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        if not all(_plain(a) for a in args) or not all(_plain(v) for v in kwargs.values()):
            return fn(*args, **kwargs)
        sc = SparkContext._active_spark_context
        key = (fn.__module__, fn.__qualname__, args, tuple(sorted(kwargs.items())))
        app = sc.applicationId if sc is not None else None
        if app != _STATE["app"]:  # Columns belong to one application's gateway
            _CACHE.clear()
            _STATE["app"] = app
        hit = _CACHE.get(key)
        if hit is None:
            hit = _CACHE[key] = fn(*args, **kwargs)
        return hit
    return wrapper

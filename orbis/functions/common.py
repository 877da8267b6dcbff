"""Small shared helpers for column expressions."""

from __future__ import annotations

import functools

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

_MEMO: dict = {}


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, fn) -> Column:
    """Bind ``value`` once and use it in ``fn`` as a lambda variable.

    Catalyst may inline a staged column into every place that uses it; a
    lambda variable is a reference, so the expression stays linear in size
    and ``value`` is evaluated once per row."""
    return F.get(F.transform(F.array(value), fn), 0)


def last_map(entries: Column, key: str) -> Column:
    """Map of (key, value) entries; of a repeated key the last entry counts, as in a store that keeps
    the last put (whatever ``spark.sql.mapKeyDedupPolicy`` says); entries without a key are left out."""
    later = lambda i: F.slice(entries, i + 2, F.size(entries))
    return F.map_from_entries(F.filter(entries, lambda e, i: e[key].isNotNull()
                                       & ~F.exists(later(i), lambda o: o[key] == e[key])))


def memo_expr(fn):
    """Reuse the Column an expression builder returns when it is called with
    column *names* and constants only.  Building a large expression costs
    thousands of calls into the JVM; the unresolved expression itself is
    plain data and is reused across queries of the same Spark application."""
    @functools.wraps(fn)
    def wrapper(*args):
        if not all(a is None or isinstance(a, (str, int, float)) for a in args):
            return fn(*args)
        sc = SparkContext._active_spark_context
        if sc is None:
            return fn(*args)
        key = (sc.applicationId, fn.__module__, fn.__qualname__, args)
        hit = _MEMO.get(key)
        if hit is None:
            hit = _MEMO[key] = fn(*args)
        return hit
    return wrapper

"""Array, struct and JSON helpers built on Spark's higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DISH_STRUCT = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
])
DISH_LIST = T.ArrayType(DISH_STRUCT)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def argmax(arr: Column | str) -> Column:
    """0-based index of the largest element, the first one on ties.

    NaN counts as the largest value (Spark orders NaN above every number, and
    ``NaN = NaN`` holds), matching NumPy's argmax.  Empty or NULL -> NULL.
    """
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def max_prob(arr: Column | str) -> Column:
    """The value at ``argmax`` (the class probability), as a double."""
    return F.array_max(_c(arr)).cast("double")


def pad_list(own: Column | str, fallback: Column | str, count: Column | str, k: int = 10) -> Column:
    """Pad ``own`` from the ranked ``fallback`` up to ``k`` entries.

    Padding happens only when ``count < k``; fallback entries already in
    ``own`` are skipped, fallback order is kept, duplicates already in ``own``
    stay, and the result is cut at ``k``.
    """
    o, f = _c(own), _c(fallback)
    padded = F.slice(F.concat(o, F.filter(F.array_distinct(f), lambda x: ~F.array_contains(o, x))), 1, k)
    return F.when(_c(count) < k, padded).otherwise(F.slice(o, 1, k))


def key_json(c: Column | str) -> Column:
    """Key text of a keyed item: the JSON array ``["<id>"]``."""
    return F.to_json(F.array(_c(c).cast("string")))


def parse_dish_list(c: Column | str) -> Column:
    """JSON text -> ``array<struct<id int, name string>>``."""
    return F.from_json(_c(c), DISH_LIST)


def tagged_names(c: Column | str, tag: str = "S") -> Column:
    """Older store format: a list of ``{S: name}`` items -> list of names."""
    return F.transform(_c(c), lambda x: x.getField(tag))

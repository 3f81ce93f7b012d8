"""Column functions over vectors held as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _doubles(x: Column) -> Column:
    return x.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def scaled(a: Column, by: Column) -> Column:
    return F.transform(_doubles(a), lambda x: x * by)


def unit(a: Column) -> Column:
    """a at length one; a zero vector stays."""
    n = norm(a)
    return F.transform(F.array(n), lambda m: F.transform(_doubles(a), lambda x: F.when(m > 0, x / m).otherwise(x)))[0]


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(_doubles(a), _doubles(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def hybrid(dense: Column, sparse: Column, weight: float = 0.35) -> Column:
    """The dense vector and the weighted sparse one, joined and brought to length one."""
    return unit(F.concat(_doubles(dense), scaled(sparse, F.lit(weight))))

"""Column functions built from JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 (ANSI mode raises otherwise)."""
    return a / F.when(b != 0, b)


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays as double; null if either is null, the shorter one padded with 0."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: F.coalesce(x.cast("double"), F.lit(0.0)) * F.coalesce(y.cast("double"), F.lit(0.0))),
        F.lit(0.0),
        lambda s, x: s + x,
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null if a norm is 0."""
    return safe_div(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def host(url: Column) -> Column:
    """Host of a URL, lower case; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/:?#]+)", 1))

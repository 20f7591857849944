"""Vectors as arrays: unit length, literals, similarities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda total, x: total + x * x))


def unit_prefix(v: Column, dims: int) -> Column:
    """First ``dims`` components at length one; a zero vector stays."""
    cut = F.slice(as_doubles(v), 1, dims)
    return F.when(norm(cut) > 0, F.transform(cut, lambda x: x / norm(cut))).otherwise(cut)


def cosine(a: Column, b: Column) -> Column:
    """Cosine; null for a zero vector."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size)


def literal(v: Column) -> Column:
    """[v1,v2,…] as text."""
    return F.concat(F.lit("["), F.array_join(F.transform(v, lambda x: x.cast("string")), ","), F.lit("]"))


def parse(text: Column) -> Column:
    """A vector from its text; null if it is none or holds what is no number."""
    v = F.from_json(text, "array<double>")
    return F.when(F.startswith(F.trim(text), F.lit("[")) & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull()), v)


def same_share(a: Column, b: Column) -> Column:
    """Share of equal positions of two signatures; 0 if one is empty."""
    size = F.least(F.size(a), F.size(b))
    same = F.aggregate(F.zip_with(F.slice(a, 1, size), F.slice(b, 1, size), lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x)
    return F.when(size > 0, same / size).otherwise(F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """Common share of two sets; 0 if one is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))

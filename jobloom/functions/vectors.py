"""Vectors stored as ``array<float>``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobloom.functions.text import _col


def _doubles(c: Column | str) -> Column:
    return _col(c).cast("array<double>")


def _total(items: Column) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, x: acc + x)


def _same_length(a: Column | str, b: Column | str, value: Column) -> Column:
    """``value``, null when a vector is missing, a failed job when the lengths differ."""
    a, b = _col(a), _col(b)
    missing = F.lit(None).cast("double")
    return (
        F.when(a.isNull() | b.isNull(), missing)
        .when(F.size(a) == F.size(b), value)
        .otherwise(F.raise_error(F.lit("vectors differ in length")).cast("double"))
    )


def euclidean_distance(a: Column | str, b: Column | str) -> Column:
    """Straight-line distance, in double arithmetic."""
    squares = F.zip_with(_doubles(a), _doubles(b), lambda x, y: (x - y) * (x - y))
    return _same_length(a, b, F.sqrt(_total(squares)))


def norm(c: Column | str) -> Column:
    return F.sqrt(_total(F.transform(_doubles(c), lambda x: x * x)))


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """Cosine, in double arithmetic; 0 when either vector is all zeros."""
    dot = _total(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y))
    scale = norm(a) * norm(b)
    return _same_length(a, b, F.when(scale > 0, dot / scale).otherwise(F.lit(0.0)))


def similarity(distance: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + _col(distance))


def to_vector(c: Column | str) -> Column:
    return _col(c).cast("array<float>")


def parse_vector(c: Column | str) -> Column:
    """``"{1,2}"`` or ``"[1,2]"`` back to a vector."""
    return F.from_json(F.translate(_col(c), "{}", "[]"), "array<float>")


def vector_literal(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")


def checked_vector(c: Column | str, dim: int) -> Column:
    """The vector itself; the job fails on a row whose length is not ``dim``."""
    v = _col(c)
    message = F.concat(F.lit(f"expected {dim} dimensions, got "), F.size(v).cast("string"))
    return F.when(F.size(v) == dim, v).otherwise(F.raise_error(message).cast("array<float>"))

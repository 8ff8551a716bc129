"""Quartiles and the interquartile-range rule.

The quartiles reach the rows as a scalar subquery.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from jobloom.session import checkpoint

# Bits that one pass settles of every wanted value.
RADIX_BITS = 16
_SIGN = 1 << 63


def approximate_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], relative_error: float
) -> DataFrame:
    """One row, one array ``q``; empty when the column holds no value."""
    accuracy = max(1, math.ceil(1.0 / relative_error))
    found = F.percentile_approx(column, list(probabilities), accuracy)
    return df.agg(F.coalesce(found, F.array().cast("array<double>")).alias("q"))


def _ordered(v: Column) -> Column:
    """The bits of a double as a long whose unsigned order is that of the doubles, NaN last."""
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), v).cast("long")
    return F.when(bits < 0, F.bitwise_not(bits)).otherwise(bits.bitwiseXOR(F.lit(-_SIGN)))


def _double(ordered: int) -> float:
    bits = ordered ^ _SIGN if ordered & _SIGN else ~ordered & (2 ** 64 - 1)
    return struct.unpack("<d", struct.pack("<Q", bits))[0]


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """One row, one array ``q``: for each p the value at rank ceil(p * n); empty when the
    column holds no value.

    The values alone are checkpointed, as longs in the order of the doubles. Four passes then
    settle sixteen bits each, from the highest on, of the values at all ranks at once: a pass
    counts the values that begin like a wanted one by their next bits. Which values there are,
    and how many ranks are asked for, changes neither the number of passes nor what a pass
    returns by more than 65,536 counts a rank; nothing is sorted.
    """
    v = F.col(column).cast("double")
    values = checkpoint(df.select((v + 0.0).alias("v")).filter("v is not null").select(  # no -0.0
        _ordered(F.col("v")).alias("u")))
    begun: list[int] = []
    ranks: list[int] = []
    for shift in range(64 - RADIX_BITS, -1, -RADIX_BITS):
        top = F.shiftrightunsigned("u", shift + RADIX_BITS) if ranks else F.lit(0).cast("long")
        like = values.filter(top.isin(sorted(set(begun)))) if ranks else values
        digit = F.shiftrightunsigned("u", shift).bitwiseAND(F.lit((1 << RADIX_BITS) - 1))
        bins = like.groupBy(top.alias("top"), digit.alias("digit")).agg(
            F.count("*").alias("n")).toArrow()
        tops, digits, sizes = (bins[c].to_numpy() for c in ("top", "digit", "n"))
        if not ranks:
            n = int(sizes.sum())
            ranks = [max(1, math.ceil(float(p) * n)) for p in probabilities] if n else []
            begun = [0] * len(ranks)
            if not ranks:
                break
        order = np.lexsort((digits, tops))
        tops, digits, sizes = tops[order], digits[order], sizes[order]
        for i, (head, rank) in enumerate(zip(begun, ranks)):
            own = slice(*np.searchsorted(tops, [head, head + 1]))
            upto = np.cumsum(sizes[own])
            at = int(np.searchsorted(upto, rank))
            ranks[i] = rank - int(upto[at - 1] if at else 0)
            begun[i] = head << RADIX_BITS | int(digits[own][at])
    row = F.array(*[F.lit(_double(u)) for u in begun]) if begun else F.array()
    return df.sparkSession.range(1).select(row.cast("array<double>").alias("q"))


def quantiles(df: DataFrame, column: str, probabilities: Sequence[float],
              relative_error: float = 0.05) -> DataFrame:
    if relative_error > 0:
        return approximate_quantiles(df, column, probabilities, relative_error)
    return exact_quantiles(df, column, probabilities)


def null_outliers(df: DataFrame, column: str, relative_error: float = 0.05,
                  reach: float = 1.5, source: DataFrame | None = None) -> DataFrame:
    """Null the values outside [q1 - reach*iqr, q3 + reach*iqr]; every row stays.

    The quartiles come from ``source`` (the same values, read more cheaply) or from ``df``.
    A column without values has no quartiles and is left as it is.
    """
    values = df if source is None else source
    q = quantiles(values, column, [0.25, 0.75], relative_error).scalar()
    bounded = df.withColumn("_q", q)
    q1, q3 = F.get("_q", 0), F.get("_q", 1)
    v, margin = F.col(column), (q3 - q1) * reach
    inside = v.between(q1 - margin, q3 + margin)
    return bounded.withColumn(column, F.when(inside, v)).drop("_q")

"""Micro-averaged precision, recall and F1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.functions.lists import overlap_counts


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def scores(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return precision, recall, _ratio(2 * precision * recall, precision + recall)


def evaluate_lists(df: DataFrame, truth: str, predicted: str,
                   ignore_case: bool = False) -> DataFrame:
    """One row: totals over all rows of the set comparison of two list columns."""
    tp, fp, fn = overlap_counts(truth, predicted, ignore_case)
    totals = df.select(tp.alias("tp"), fp.alias("fp"), fn.alias("fn")).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in ("tp", "fp", "fn")]
    )
    p, r, f1 = scores(F.col("total_tp"), F.col("total_fp"), F.col("total_fn"))
    return totals.select(
        "total_tp", "total_fp", "total_fn",
        p.alias("precision"), r.alias("recall"), f1.alias("f1_score"),
    )


def evaluate_pairs(truth: DataFrame, predicted: DataFrame, key: str,
                   value: str = "skill") -> DataFrame:
    """The same totals from (key, value) rows; no list is ever built.

    Both sides meet in one aggregation on the pair, combined before the shuffle.
    """
    tagged = truth.select(key, value, F.lit(1).alias("t"), F.lit(0).alias("p")).unionByName(
        predicted.select(key, value, F.lit(0).alias("t"), F.lit(1).alias("p")))
    pairs = tagged.groupBy(key, value).agg(F.max("t").alias("t"), F.max("p").alias("p"))
    totals = pairs.agg(
        F.coalesce(F.sum(F.col("t") * F.col("p")), F.lit(0)).alias("total_tp"),
        F.coalesce(F.sum((1 - F.col("t")) * F.col("p")), F.lit(0)).alias("total_fp"),
        F.coalesce(F.sum(F.col("t") * (1 - F.col("p"))), F.lit(0)).alias("total_fn"),
    )
    p, r, f1 = scores(F.col("total_tp"), F.col("total_fp"), F.col("total_fn"))
    return totals.select(
        "total_tp", "total_fp", "total_fn",
        p.alias("precision"), r.alias("recall"), f1.alias("f1_score"),
    )


def common_values(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    return truth.intersect(predicted)


def missing_values(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    return truth.exceptAll(predicted)

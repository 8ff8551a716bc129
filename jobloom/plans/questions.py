"""Question files to the question table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.functions.text import clean_question, is_technical
from jobloom.operators.dedupe import first_question


def clean_questions(raw: DataFrame, order: list[Column]) -> DataFrame:
    """Strip, drop empty ones, keep technical topics, keep the first of equal questions."""
    cleaned = raw.withColumn("question", clean_question("question"))
    usable = cleaned.filter(F.col("question").isNotNull() & is_technical("topic"))
    return first_question(usable, order)

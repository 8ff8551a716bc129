"""One nested evaluation result: skills, vectors and texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.functions.text import line_count, mentions_all, mentions_any, word_count
from jobloom.operators.evaluation import evaluate_lists

# The phrases the two structure checks look for.
ANY_SECTION = ("skill gap", "roadmap", "week", "project", "networking")
ALL_SECTIONS = ("top skill gaps", "12-week learning roadmap", "networking", "alternative roles")


def similarity_scores(scored: DataFrame, key: str, score: str = "score") -> DataFrame:
    """Every score as a row (id, score): the table that belongs to the summary."""
    return scored.select(F.col(key).alias("id"), F.col(score).alias("score"))


def similarity_summary(scored: DataFrame, dim: Column | str = "dim",
                       score: str = "score") -> DataFrame:
    """Dimension and spread of the scores, in one pass."""
    return scored.agg(
        F.max(dim).alias("embedding_dimension"),
        F.count(score).alias("n_scores"),
        F.avg(score).alias("mean_similarity"),
        F.min(score).alias("min_similarity"),
        F.max(score).alias("max_similarity"),
    )


def text_summary(texts: DataFrame, text: str, any_of: Sequence[str] = ANY_SECTION,
                 all_of: Sequence[str] = ALL_SECTIONS) -> DataFrame:
    checked = texts.select(
        word_count(text).alias("words"), line_count(text).alias("lines"),
        mentions_any(text, any_of).alias("any_of"), mentions_all(text, all_of).alias("all_of"))
    return checked.agg(
        F.count("*").alias("n_texts"),
        F.sum("words").alias("output_word_count"), F.sum("lines").alias("output_line_count"),
        F.count_if("any_of").alias("with_any_section"),
        F.count_if("all_of").alias("with_all_sections"),
    )


def evaluation_report(lists: DataFrame, scored: DataFrame, texts: DataFrame,
                      text: str, ignore_case: bool = False) -> DataFrame:
    """One row of three structs, ready for ``write.json``.

    ``lists`` holds ``truth`` and ``predicted`` arrays, ``scored`` holds (dim, score). The
    scores themselves are rows of their own: see ``similarity_scores``.
    """
    def packed(df: DataFrame) -> Column:
        return df.select(F.struct(*df.columns)).scalar()

    spark = lists.sparkSession
    return spark.range(1).select(
        packed(evaluate_lists(lists, "truth", "predicted", ignore_case))
        .alias("skill_extraction"),
        packed(similarity_summary(scored)).alias("embeddings"),
        packed(text_summary(texts, text)).alias("roadmap"),
    )


def write_report(report: DataFrame, path: str, scores: DataFrame | None = None) -> None:
    """The report as JSON; all scores, where given, as JSON lines beside it."""
    report.write.mode("overwrite").json(path)
    if scores is not None:
        scores.write.mode("overwrite").json(f"{path.rstrip('/')}_scores")

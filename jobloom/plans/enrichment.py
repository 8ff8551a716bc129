"""Skills and vectors of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.functions.skills import extract_skills
from jobloom.functions.text import _col, skill_text, vector_text
from jobloom.operators.encode import embed_text_column


def pairs_of(rows: DataFrame, key: str = "job_id", unique_key: bool = False) -> DataFrame:
    """(key, skill) rows from ``skills`` lists, unique. A list holds a skill once, so where
    the key is unique as well (as in silver jobs) nothing needs to be shuffled."""
    pairs = rows.select(key, F.explode("skills").alias("skill"))
    return pairs if unique_key else pairs.dropDuplicates([key, "skill"])


def skill_pairs(df: DataFrame, key: str, text: Column | str, unique_key: bool = False,
                **options) -> DataFrame:
    """The same rows straight from texts. The lists are exploded where they are made: as a
    column of their own, the filters Spark infers for it would make them again."""
    pairs = df.select(key, F.explode(extract_skills(_col(text), **options)).alias("skill"))
    return pairs if unique_key else pairs.dropDuplicates([key, "skill"])


def job_skills(jobs: DataFrame, **options) -> DataFrame:
    return skill_pairs(jobs, "job_id", skill_text(), **options)


def question_skills(questions: DataFrame, **options) -> DataFrame:
    return skill_pairs(questions, "q_id", "question", **options)


def job_vectors(jobs: DataFrame, make_encoder=None, dim: int = 256) -> DataFrame:
    texts = jobs.select("job_id", vector_text().alias("_text"))
    return embed_text_column(texts, "_text", make_encoder, dim).select("job_id", "embedding")


def question_vectors(questions: DataFrame, make_encoder=None, dim: int = 256) -> DataFrame:
    return embed_text_column(questions.select("q_id", "question"), "question", make_encoder,
                             dim).select("q_id", "embedding")


def enrich_jobs(jobs: DataFrame, make_encoder=None, dim: int = 256, **options) -> DataFrame:
    """(job_id, skills, embedding) in one pass over the texts; write it, then take the two
    tables from it with ``pairs_of`` and a select, so that no text is read twice."""
    texts = jobs.select("job_id", extract_skills(skill_text(), **options).alias("skills"),
                        vector_text().alias("_text"))
    return embed_text_column(texts, "_text", make_encoder, dim).select(
        "job_id", "skills", "embedding")

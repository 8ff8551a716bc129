"""Table schemas, keys and names: the one place they are written down."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names]


VECTOR = T.ArrayType(T.FloatType(), containsNull=False)

BRONZE_JOBS = T.StructType(
    _fields(T.StringType(), "id", "title", "company", "location")
    + _fields(T.DoubleType(), "latitude", "longitude")
    + _fields(T.StringType(), "description", "category")
    + _fields(T.DoubleType(), "salary_min", "salary_max")
    + _fields(T.StringType(), "created", "redirect_url")
)

_DISPLAY = T.StructType(_fields(T.StringType(), "display_name"))
_LABEL = T.StructType(_fields(T.StringType(), "label"))

API_PAGE = T.StructType([
    T.StructField("count", T.LongType()),
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("company", _DISPLAY),
        T.StructField("location", _DISPLAY),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("description", T.StringType()),
        T.StructField("category", _LABEL),
        T.StructField("salary_min", T.DoubleType()),
        T.StructField("salary_max", T.DoubleType()),
        T.StructField("created", T.StringType()),
        T.StructField("redirect_url", T.StringType()),
    ]))),
])

JOBS = T.StructType(
    [T.StructField("job_id", T.StringType(), False)]
    + _fields(T.StringType(), "title", "company", "location")
    + _fields(T.DoubleType(), "lat", "lon")
    + _fields(T.StringType(), "description", "category")
    + _fields(T.DoubleType(), "salary_min", "salary_max", "salary_mid")
    + _fields(T.StringType(), "posted_raw")
    + _fields(T.TimestampType(), "posted_ts")
    + _fields(T.DateType(), "dt")
    + _fields(T.StringType(), "url")
)

JOB_SKILLS = T.StructType([
    T.StructField("job_id", T.StringType(), False),
    T.StructField("skill", T.StringType(), False),
])

JOB_EMBEDDINGS = T.StructType([
    T.StructField("job_id", T.StringType(), False),
    T.StructField("embedding", VECTOR),
])

INTERVIEW_QUESTIONS = T.StructType([
    T.StructField("q_id", T.LongType(), False),
    T.StructField("question", T.StringType(), False),
    T.StructField("topic", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

INTERVIEW_EMBEDDINGS = T.StructType([
    T.StructField("q_id", T.LongType(), False),
    T.StructField("embedding", VECTOR),
])

INTERVIEW_SKILLS = T.StructType([
    T.StructField("q_id", T.LongType(), False),
    T.StructField("skill", T.StringType(), False),
])

QUESTION_SNAPSHOT = T.StructType(_fields(T.StringType(), "question", "source", "topic"))


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: tuple[str, ...]
    # Columns an upsert replaces on a key match; the others keep their stored value.
    update_columns: tuple[str, ...] = ()


TABLES = {
    spec.name: spec
    for spec in (
        TableSpec("jobs", JOBS, ("job_id",),
                  ("title", "company", "location", "description",
                   "salary_mid", "posted_ts", "dt")),
        TableSpec("job_skills_ner", JOB_SKILLS, ("job_id", "skill")),
        TableSpec("job_embeddings", JOB_EMBEDDINGS, ("job_id",), ("embedding",)),
        TableSpec("interview_questions", INTERVIEW_QUESTIONS, ("q_id",)),
        TableSpec("interview_embeddings", INTERVIEW_EMBEDDINGS, ("q_id",), ("embedding",)),
        TableSpec("interview_skills_ner", INTERVIEW_SKILLS, ("q_id", "skill")),
    )
}

# Kept beside the six tables where a warehouse counts demand as it loads. A role is written
# with a sign before it, so that a missing one has a key as well.
ROLE_SKILL_COUNTS = TableSpec("role_skill_counts", T.StructType([
    T.StructField("role_key", T.StringType(), False),
    T.StructField("skill", T.StringType(), False),
    T.StructField("demand_count", T.LongType()),
]), ("role_key", "skill"), ("demand_count",))

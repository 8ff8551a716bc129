"""Vectors and retrieval (H1-H8, I2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import (
    JOB_VECTORS_SQL, JOBS_SQL, PROFILE_VECTORS_SQL, PROFILES_SQL, case, job_vectors, jobs,
    profile_vectors, profiles,
)
from catalog.joins import MEAN_VECTOR_SQL, mean_vector
from catalog.skills import _ROWS, SKILL_DOCS_SQL, pairs_sql, skill_docs
from jobloom.functions import vectors as V
from jobloom.functions.text import job_query_text
from jobloom.operators.encode import embed_queries, embed_text_column, encode_texts
from jobloom.operators.retrieval import (
    interview_questions, nearest_for_all, similar_jobs,
)
from jobloom.plans.career import shortlist_jobs, shortlist_questions
from jobloom.plans.enrichment import enrich_jobs, pairs_of
from jobloom.session import scratch_path
from jobloom.sources.questions import union_sources

DIM = 256


def _unit_checks(df, key):
    return df.select(key, F.size("embedding").cast("bigint").alias("dim"),
                     F.round(V.norm("embedding"), 4).alias("norm"))


@case(f"""select doc_id, cast({DIM} as bigint) as dim, case when trim(text) = '' then 0.0
        else 1.0 end as norm from documents""")
def h1(t):
    return _unit_checks(embed_text_column(t.documents, "text", dim=DIM), "doc_id")


def letter_encoder():
    """A stand-in model: counts of a..z, one row per text."""
    import numpy as np

    def encode(texts):
        # Letters are single bytes in UTF-8, and no other character holds these bytes.
        found = [np.bincount(np.frombuffer(s.lower().encode("utf-8", "replace"), np.uint8),
                             minlength=256)[97:123] for s in texts]
        return np.array(found, dtype=float).reshape(len(texts), 26)

    return encode


_LETTERS = ", ".join(
    f"len(lower(text)) - len(replace(lower(text), '{chr(97 + i)}', ''))" for i in range(26))


@case(f"""with v as (select doc_id, [{_LETTERS}]::double[] as v from documents)
      select doc_id, array_to_string(list_transform(v, lambda y: cast(round(1e4 * (y / sqrt(
        list_sum(list_transform(v, lambda x: x * x))))::float::double) as bigint)), ' ') as letters
      from v""")
def h1_model(t):
    v = encode_texts(t.documents.select("doc_id", "text"), "text", letter_encoder)
    return v.select("doc_id", F.array_join(F.transform("embedding", lambda x: F.round(
        x.cast("double") * 1e4).cast("bigint").cast("string")), " ").alias("letters"))


@case(f"""select profile_id, cast({DIM} as bigint) as dim, 1.0 as norm from ({PROFILES_SQL})""")
def h2(t):
    texts = profiles(t).select("profile_id", job_query_text("target_role", "skills").alias("query"))
    return _unit_checks(embed_queries(texts, "query", dim=DIM), "profile_id")


_CENTRES = "select vec_id as label, embedding as c from embeddings"


def _with_centre(t):
    centre = t.embeddings.select(F.col("vec_id").alias("label"), F.col("embedding").alias("c"))
    return t.embeddings.join(centre, "label")


@case(f"""select vec_id, round(list_distance(embedding::double[], c::double[]), 6) as distance
      from embeddings join ({_CENTRES}) using (label)""")
def h3(t):
    return _with_centre(t).select(
        "vec_id", F.round(V.euclidean_distance("embedding", "c"), 6).alias("distance"))


@case(f"""select vec_id, round(list_cosine_similarity(embedding::double[], c::double[]), 6) as cosine
      from embeddings join ({_CENTRES}) using (label)""")
def h4(t):
    return _with_centre(t).select(
        "vec_id", F.round(V.cosine_similarity("embedding", "c"), 6).alias("cosine"))


_ROUNDED = "round(list_distance(embedding::double[], {q}), 6)"


@case(f"""select j.job_id, title, company, location, salary_mid, url,
        {_ROUNDED.format(q=MEAN_VECTOR_SQL)} as distance
      from ({JOB_VECTORS_SQL}) v join ({JOBS_SQL}) j on j.job_id = v.job_id
      where title is not null
      order by list_distance(embedding::double[], {MEAN_VECTOR_SQL}), j.job_id limit 30""")
def h5(t):
    return similar_jobs(job_vectors(t), jobs(t), mean_vector(t), 30).withColumn(
        "distance", F.round("distance", 6))


_QUESTIONS_SQL = """select item_id as q_id, text as question, 'technical' as topic,
  'benchmark' as source from benchmark"""


def questions(t):
    return t.benchmark.select(F.col("item_id").alias("q_id"), F.col("text").alias("question"),
                              F.lit("technical").alias("topic"), F.lit("benchmark").alias("source"))


def question_vectors(t):
    return t.embeddings.select(F.col("vec_id").alias("q_id"), "embedding")


@case(f"""select q.q_id, question, topic, source, {_ROUNDED.format(q=MEAN_VECTOR_SQL)} as distance,
        round(1 / (1 + list_distance(embedding::double[], {MEAN_VECTOR_SQL})), 6) as similarity
      from embeddings join ({_QUESTIONS_SQL}) q on q.q_id = vec_id
      order by list_distance(embedding::double[], {MEAN_VECTOR_SQL}), q.q_id limit 15""")
def h6(t):
    found = interview_questions(question_vectors(t), questions(t), mean_vector(t), 15)
    return found.withColumns({c: F.round(c, 6) for c in ("distance", "similarity")})


@case("""select vec_id, cast(len(embedding) as bigint) as dim from embeddings""")
def h7(t):
    return t.embeddings.select("vec_id", F.size(V.checked_vector("embedding", 64)).cast(
        "bigint").alias("dim"))


SHORTLIST_SQL = f"""select profile_id, job_id, distance, rank from (
    select p.profile_id, v.job_id,
      list_distance(p.embedding::double[], v.embedding::double[]) as distance,
      row_number() over (partition by p.profile_id order by
        list_distance(p.embedding::double[], v.embedding::double[]), v.job_id) as rank
    from ({PROFILE_VECTORS_SQL}) p, ({JOB_VECTORS_SQL}) v
    where v.job_id in (select job_id from ({JOBS_SQL}) where title is not null))
  where rank <= 30"""

QUESTION_SHORTLIST_SQL = f"""select profile_id, q_id, distance, rank from (
    select p.profile_id, v.vec_id as q_id,
      list_distance(p.embedding::double[], v.embedding::double[]) as distance,
      row_number() over (partition by p.profile_id order by
        list_distance(p.embedding::double[], v.embedding::double[]), v.vec_id) as rank
    from ({PROFILE_VECTORS_SQL}) p, embeddings v
    where v.vec_id in (select item_id from benchmark))
  where rank <= 15"""


def _hits(df, key):
    return df.select("profile_id", key, F.round("distance", 6).alias("distance"), "rank")


def _hits_sql(inner, key):
    return f"select profile_id, {key}, round(distance, 6) as distance, rank from ({inner})"


@case(_hits_sql(SHORTLIST_SQL, "job_id"))
def h8(t):
    return _hits(shortlist_jobs(profile_vectors(t), job_vectors(t), jobs(t), 30), "job_id")


@case(_hits_sql(QUESTION_SHORTLIST_SQL, "q_id"))
def h8_questions(t):
    found = shortlist_questions(profile_vectors(t), question_vectors(t), questions(t), 15)
    return _hits(found, "q_id")


@case("""select profile_id, job_id, round(distance, 6) as distance, rank from (
        select p.vec_id as profile_id, v.vec_id as job_id,
          list_distance(p.embedding::double[], v.embedding::double[]) as distance,
          row_number() over (partition by p.vec_id order by
            list_distance(p.embedding::double[], v.embedding::double[]), v.vec_id) as rank
        from embeddings p, embeddings v) where rank <= 5""")
def h8_grid(t):
    """All vectors against all vectors, the queries in several blocks."""
    queries = t.embeddings.select(F.col("vec_id").alias("profile_id"), "embedding")
    corpus = t.embeddings.select(F.col("vec_id").alias("job_id"), "embedding")
    found = nearest_for_all(queries, corpus, "profile_id", "job_id", 5,
                            block_bytes=1 << 16)
    return _hits(found, "job_id")


@case(f"""select 'skill' as kind, doc_id as job_id, skill, cast(null as bigint) as dim
      from ({pairs_sql(SKILL_DOCS_SQL.replace("concat_ws(' ', text", "concat_ws(' ', '. ' || text"), _ROWS)})
      union all select 'vector', doc_id, null, {DIM} from documents""")
def i2(t):
    silver = skill_docs(t).select(F.col("doc_id").alias("job_id"),
                                  F.lit(None).cast("string").alias("title"),
                                  F.col("body").alias("description"))
    path = scratch_path(t.spark, "enriched")
    enrich_jobs(silver, dim=DIM).write.parquet(path)
    enriched, none = t.spark.read.parquet(path), F.lit(None)
    return union_sources([
        pairs_of(enriched).select(F.lit("skill").alias("kind"), "job_id", "skill",
                                  none.cast("bigint").alias("dim")),
        enriched.select(F.lit("vector").alias("kind"), "job_id",
                        none.cast("string").alias("skill"),
                        F.size("embedding").cast("bigint").alias("dim")),
    ])


CASES = {
    "h1_text_vectors": h1,
    "h1_text_vectors_own_model": h1_model,
    "h2_query_vectors": h2,
    "h3_euclidean_distance": h3,
    "h4_cosine_similarity": h4,
    "h5_similar_jobs": h5,
    "h6_similar_questions": h6,
    "h7_dimension_check": h7,
    "h8_jobs_for_all_profiles": h8,
    "h8_questions_for_all_profiles": h8_questions,
    "h8_nearest_on_a_grid": h8_grid,
    "i2_skills_and_vectors": i2,
}

"""Joins (F1-F6), id lists (C18) and unions (S1, S2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import JOB_SKILLS_SQL, case, job_skill_rows
from jobloom.functions.skills import extract_skills
from jobloom.functions.vectors import euclidean_distance
from jobloom.operators.demand import jobs_with_skills, skills_of_jobs
from jobloom.operators.evaluation import common_values, missing_values
from jobloom.operators.merge import new_pairs
from jobloom.sources.questions import union_sources


@case("""select doc_id, lang, label from embeddings join documents on doc_id = vec_id""")
def f1(t):
    return t.embeddings.join(t.documents, F.col("doc_id") == F.col("vec_id")).select(
        "doc_id", "lang", "label")


@case("""select item_id, md5(text) as question, label
      from embeddings join benchmark on item_id = vec_id""")
def f2(t):
    return t.embeddings.join(t.benchmark, F.col("item_id") == F.col("vec_id")).select(
        "item_id", F.md5("text").alias("question"), "label")


@case("""select job_id, o_orderpriority as title, skill, cast(count(*) as bigint) as rows
      from (select cast(o_orderkey as string) as job_id, o_orderpriority from orders)
      join (select cast(l_orderkey as string) as job_id, l_returnflag as skill from lineitem)
      using (job_id) group by 1, 2, 3""")
def f3(t):
    jobs = t.orders.select(F.col("o_orderkey").cast("string").alias("job_id"),
                           F.col("o_orderpriority").alias("title"))
    skills = t.lineitem.select(F.col("l_orderkey").cast("string").alias("job_id"),
                               F.col("l_returnflag").alias("skill"))
    return jobs_with_skills(jobs, skills).groupBy("job_id", "title", "skill").agg(
        F.count("*").alias("rows"))


MEAN_VECTOR_SQL = """(select list(m order by i) from (select i, round(avg(v), 6) as m from
  (select unnest(embedding) as v, generate_subscripts(embedding, 1) as i from embeddings)
  group by i))"""


def mean_vector(t):
    """The rounded mean of all vectors, as a scalar: one value per dimension."""
    parts = t.embeddings.select(F.posexplode("embedding").alias("i", "v")).groupBy("i").agg(
        F.round(F.avg(F.col("v").cast("double")), 6).alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "m")))
    return parts.agg(F.transform(ordered, lambda s: s["m"]).alias("q")).scalar()


@case(f"""select vec_id, round(list_distance(embedding::double[], {MEAN_VECTOR_SQL}), 6) as distance
      from embeddings""")
def f4(t):
    bound = t.embeddings.withColumn("q", mean_vector(t))
    return bound.select("vec_id", F.round(euclidean_distance("embedding", "q"), 6)
                        .alias("distance"))


@case("""select doc_id, md5(text) as text, cast(case when regexp_matches(text,
        '(?i)(^|[^\\p{L}\\p{N}_])the($|[^\\p{L}\\p{N}_])') then 1 else 0 end as bigint) as hits
      from documents""")
def f5(t):
    found = extract_skills("text", {"the": ["the"]})
    return t.documents.select("doc_id", F.md5("text").alias("text"),
                              F.size(found).cast("bigint").alias("hits"))


@case("""select 'known' as side, cast(count(*) as bigint) as rows from orders
        where o_orderkey in (select l_orderkey from lineitem)
      union all
      select 'unknown', cast(count(*) as bigint) from orders
        where o_orderkey not in (select l_orderkey from lineitem)""")
def f6(t):
    known = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    both = common_values(t.orders.select("o_orderkey"), known)
    new = new_pairs(known, t.orders, ["o_orderkey"])
    return both.agg(F.lit("known").alias("side"), F.count("*").alias("rows")).union(
        new.agg(F.lit("unknown").alias("side"), F.count("*").alias("rows")))


@case(f"""select job_id, skill, cast(count(*) as bigint) as rows from ({JOB_SKILLS_SQL})
      where job_id in (select cast(o_orderkey as string) from orders where o_orderstatus = 'F')
      group by 1, 2""")
def c18(t):
    ids = t.orders.filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").cast("string").alias("job_id"))
    return skills_of_jobs(job_skill_rows(t), ids).groupBy("job_id", "skill").agg(
        F.count("*").alias("rows"))


@case("""select source, cast(count(*) as bigint) as rows,
        cast(sum(length(question)) as bigint) as chars
      from (select text as question, 'documents' as source from documents
            union all select text, 'benchmark' from benchmark
            union all select text, 'conversations' from conversations) group by source""")
def s1(t):
    frames = [getattr(t, n).select(F.col("text").alias("question"), F.lit(n).alias("source"))
              for n in ("documents", "benchmark", "conversations")]
    return union_sources(frames).groupBy("source").agg(
        F.count("*").alias("rows"), F.sum(F.length("question")).alias("chars"))


_TRUTH = f"select job_id, skill from ({JOB_SKILLS_SQL}) where l_quantity > 25"
_FOUND = f"select job_id, skill from ({JOB_SKILLS_SQL}) where l_discount >= 0.05"


@case(f"""select 'both' as kind, job_id, skill from ({_TRUTH} intersect {_FOUND})
      union all select 'missed', job_id, skill from ({_TRUTH} except all {_FOUND})""")
def s2(t):
    rows = job_skill_rows(t)
    truth = rows.filter("l_quantity > 25").select("job_id", "skill")
    found = rows.filter("l_discount >= 0.05").select("job_id", "skill")
    kind = F.lit("both").alias("kind"), F.lit("missed").alias("kind")
    return common_values(truth, found).select(kind[0], "job_id", "skill").union(
        missing_values(truth, found).select(kind[1], "job_id", "skill"))


CASES = {
    "c18_rows_of_given_ids": c18,
    "f1_vectors_join_jobs": f1,
    "f2_vectors_join_questions": f2,
    "f3_jobs_join_skills": f3,
    "f4_one_vector_to_all": f4,
    "f5_results_keep_their_key": f5,
    "f6_known_and_unknown_keys": f6,
    "s1_union_of_sources": s1,
    "s2_skill_set_operations": s2,
}

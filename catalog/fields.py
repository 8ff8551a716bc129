"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import (
    JOB_VECTORS_SQL, JOBS_SQL, RAW_JOBS_ONCE_SQL, PROFILES_SQL, SQL_NON_WS, SQL_WS, case,
    job_vectors, jobs, profiles, raw_jobs_once, sql_collapse, sql_stamp, sql_strip, stamp,
)
from catalog.joins import MEAN_VECTOR_SQL, mean_vector
from jobloom.functions import text, values, vectors
from jobloom.functions.lists import deduplicate_skills, split_skills
from jobloom.operators.retrieval import similar_jobs
from jobloom.plans.report import ALL_SECTIONS, ANY_SECTION
from jobloom.plans.silver import select_raw


@case(f"""
    select id as job_id, title, company, location, try_cast(latitude as double) as lat,
      try_cast(longitude as double) as lon, md5(description) as description, category,
      cast(salary_min as double) as salary_min, cast(salary_max as double) as salary_max,
      created as posted_raw, redirect_url as url
    from ({RAW_JOBS_ONCE_SQL})""")
def c1(t):
    return select_raw(raw_jobs_once(t)).withColumn("description", F.md5("description"))


@case("""select doc_id, lower(trim(concat('  ', source, ' ', upper(lang), ' '))) as title,
         trim(concat(' ', lang, ' ')) as company from documents""")
def c2(t):
    d = t.documents.select(
        "doc_id", F.concat(F.lit("  "), "source", F.lit(" "), F.upper("lang"), F.lit(" "))
        .alias("title"), F.concat(F.lit(" "), "lang", F.lit(" ")).alias("company"))
    return d.select("doc_id", text.clean_title("title").alias("title"),
                    F.trim("company").alias("company"))


@case(r"""select doc_id, md5(regexp_replace(lower(text), '[\s\x{0b}]+', ' ', 'g')) as description
          from documents""")
def c3(t):
    return t.documents.select(
        "doc_id", F.md5(text.clean_description("text")).alias("description"))


_EVENT_TS = ("case when event_type = 'error' then concat('bad ', {ts}) else {ts} end")


@case(f"""with e as (select event_id, {_EVENT_TS.format(ts=sql_stamp('ts'))} as posted_raw
                     from events)
      select event_id, {sql_stamp('try_cast(posted_raw as timestamp)')} as posted_ts,
        strftime(try_cast(posted_raw as timestamp), '%Y-%m-%d') as dt from e""")
def c4(t):
    raw = F.when(F.col("event_type") == "error", F.concat(F.lit("bad "), stamp("ts"))
                 ).otherwise(stamp("ts"))
    e = t.events.select("event_id", values.posted_timestamp(raw).alias("ts"))
    return e.select("event_id", stamp("ts").alias("posted_ts"),
                    F.to_date("ts").cast("string").alias("dt"))


_PAY = ("nullif(l_discount, 0.0) as low", "nullif(l_tax, 0.0) as high")


@case(f"""select l_orderkey, l_linenumber, round(case when low is not null and high is not null
        then (low + high) / 2 else high end, 6) as salary_mid, cast(count(*) as bigint) as rows
      from (select l_orderkey, l_linenumber, {', '.join(_PAY)} from lineitem) group by 1, 2, 3""")
def c5(t):
    pay = t.lineitem.selectExpr("l_orderkey", "l_linenumber", *_PAY)
    mid = F.round(values.mid_salary("low", "high"), 6).alias("salary_mid")
    return (pay.select("l_orderkey", "l_linenumber", mid)
            .groupBy("l_orderkey", "l_linenumber", "salary_mid").agg(F.count("*").alias("rows")))


@case(f"""select doc_id, md5(coalesce(lower({sql_collapse(sql_strip("nullif(text, '')"))}), ''))
        as normalized from documents""")
def c6(t):
    return t.documents.select("doc_id", F.md5(text.normalize_text("text")).alias("normalized"))


def _sql_cleaned(e: str) -> str:
    e = f"regexp_replace({e}, '<[^>]+>', ' ', 'g')"
    e = f"regexp_replace({e}, 'http{SQL_NON_WS}+|www\\.{SQL_NON_WS}+', ' ', 'g')"
    e = f"regexp_replace({e}, '{SQL_NON_WS}+@{SQL_NON_WS}+', ' ', 'g')"
    return f"lower({sql_strip(sql_collapse(e))})"


@case(f"""select 'page' as kind, page_id as id, md5({_sql_cleaned('html')}) as cleaned from pages
      union all
      select 'document', doc_id, md5({_sql_cleaned('text')}) from documents""")
def c7(t):
    pages = t.pages.select(F.lit("page").alias("kind"), F.col("page_id").alias("id"),
                           F.col("html").alias("body"))
    docs = t.documents.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"),
                              F.col("text").alias("body"))
    return pages.union(docs).select(
        "kind", "id", F.md5(text.clean_job_description("body")).alias("cleaned"))


@case(f"""select doc_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(
        string_split(text, ' '), lambda s: {sql_strip('lower(s)')}), lambda s: s <> ''))), '|')
        as skills from documents""")
def c8(t):
    words = F.split("text", " ")
    return t.documents.select(
        "doc_id", F.array_join(deduplicate_skills(words), "|").alias("skills"))


@case(f"""with q as (select conv_id, turn, {sql_strip(
        "case when turn = 3 then ' nan ' else concat(' ', text, chr(9)) end")} as question
        from conversations)
      select conv_id, turn, md5(question) as question from q
      where question <> '' and question <> 'nan'""")
def c9(t):
    q = t.conversations.select("conv_id", "turn", text.clean_question(
        F.when(F.col("turn") == 3, F.lit(" nan ")).otherwise(
            F.concat(F.lit(" "), "text", F.lit("\t")))).alias("question"))
    return q.filter("question is not null").withColumn("question", F.md5("question"))


_TOPIC = "case p_type when 'ECONOMY' then 'bioTECHnology' when 'SMALL' then null else p_type end"


@case(f"""select p_partkey, topic from (select p_partkey, {_TOPIC} as topic from part)
      where topic ilike '%tech%'""")
def c10(t):
    topics = t.part.selectExpr("p_partkey", f"{_TOPIC} as topic")
    return topics.filter(text.is_technical("topic"))


@case(f"""select p_partkey, coalesce({_TOPIC}, 'technical') as topic, 'technical' as added
      from part""")
def c11(t):
    topics = t.part.selectExpr("p_partkey", f"{_TOPIC} as topic")
    return topics.select("p_partkey", text.default_topic("topic").alias("topic"),
                         text.default_topic(F.lit(None).cast("string")).alias("added"))


@case("""with d as (select doc_id, nullif(lang, 'es') as title,
        case when source = 'src2' then null else text end as description from documents)
      select doc_id,
        md5(coalesce(title, '') || '. ' || coalesce(description, '')) as skill_text,
        md5(coalesce(title, '') || ' | ' || coalesce(description, '')) as vector_text from d""")
def c14(t):
    d = t.documents.selectExpr("doc_id", "nullif(lang, 'es') as title",
                               "case when source = 'src2' then null else text end as description")
    return d.select("doc_id", F.md5(text.skill_text()).alias("skill_text"),
                    F.md5(text.vector_text()).alias("vector_text"))


@case(f"""select id, sha256(concat_ws('||', title, company, location)) as dup_key
      from ({RAW_JOBS_ONCE_SQL})""")
def c15(t):
    return raw_jobs_once(t).select(
        "id", text.duplicate_key("title", "company", "location").alias("dup_key"))


@case(f"""select profile_id, array_to_string(list_filter(list_transform(string_split(skills, ','),
        lambda s: {sql_strip('s')}), lambda s: s <> ''), '|') as skills from ({PROFILES_SQL})""")
def c16(t):
    return profiles(t).select(
        "profile_id", F.array_join(split_skills("skills"), "|").alias("skills"))


@case(f"""select j.job_id, title, round(list_distance(embedding::double[], {MEAN_VECTOR_SQL}), 6)
        as distance
      from ({JOB_VECTORS_SQL}) v join ({JOBS_SQL}) j on j.job_id = v.job_id
      where title is not null""")
def c17(t):
    """Every job with a title and a vector, as a search for more jobs than there are finds it."""
    found = similar_jobs(job_vectors(t), jobs(t), mean_vector(t), top_k=1_000_000)
    return found.select("job_id", "title", F.round("distance", 6).alias("distance"))


@case("""select e.vec_id, round(1 / (1 + list_distance(e.embedding::double[], c.embedding::double[])),
        6) as similarity
      from embeddings e join embeddings c on c.vec_id = e.label""")
def c19(t):
    centre = t.embeddings.select(F.col("vec_id").alias("label"), F.col("embedding").alias("c"))
    near = t.embeddings.join(centre, "label")
    return near.select("vec_id", F.round(vectors.similarity(
        vectors.euclidean_distance("embedding", "c")), 6).alias("similarity"))


@case(f"""select profile_id,
        concat('Target role: ', coalesce(target_role, ''), '. Current skills: ', skills)
          as job_query,
        concat('Technical interview questions for ', coalesce(target_role, ''),
               '. Candidate skills: ', skills) as question_query
      from ({PROFILES_SQL})""")
def c20(t):
    return profiles(t).select(
        "profile_id", text.job_query_text("target_role", "skills").alias("job_query"),
        text.question_query_text("target_role", "skills").alias("question_query"))


def _sql_contains(phrases, glue: str) -> str:
    return f" {glue} ".join(f"contains(lower(text), '{p}')" for p in phrases)


@case(f"""select doc_id,
        cast(len(list_filter(regexp_split_to_array(text, '{SQL_WS}+'), lambda w: w <> ''))
          as bigint) as words,
        cast(len(string_split(text, chr(10))) as bigint) as lines,
        {_sql_contains(('the', 'und'), 'or')} as some, {_sql_contains(('the', 'of'), 'and')} as every,
        {_sql_contains(ANY_SECTION, 'or')} as any_section,
        {_sql_contains(ALL_SECTIONS, 'and')} as all_sections
      from documents""")
def c21(t):
    return t.documents.select(
        "doc_id", text.word_count("text").cast("bigint").alias("words"),
        text.line_count("text").cast("bigint").alias("lines"),
        text.mentions_any("text", ("the", "und")).alias("some"),
        text.mentions_all("text", ("the", "of")).alias("every"),
        text.mentions_any("text", ANY_SECTION).alias("any_section"),
        text.mentions_all("text", ALL_SECTIONS).alias("all_sections"))


CASES = {
    "c1_select_cast_raw": c1,
    "c2_clean_title_company": c2,
    "c3_clean_description": c3,
    "c4_posted_timestamp": c4,
    "c5_mid_salary": c5,
    "c6_normalize_text": c6,
    "c7_clean_job_description": c7,
    "c8_deduplicate_skills": c8,
    "c9_clean_question": c9,
    "c10_technical_topics": c10,
    "c11_default_topic": c11,
    "c14_joined_texts": c14,
    "c15_duplicate_key": c15,
    "c16_split_skills": c16,
    "c17_titled_rows": c17,
    "c19_similarity": c19,
    "c20_query_texts": c20,
    "c21_text_checks": c21,
}

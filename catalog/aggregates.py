"""Aggregation, dedupe, sort and ids (E1-E6, D1-D8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import (
    JOB_SKILLS_SQL, RAW_JOBS_SQL, case, job_skill_rows, raw_jobs, sql_stamp, stamp,
)
from jobloom.operators import dedupe, demand, quantiles
from jobloom.operators.counts import counted
from jobloom.operators.evaluation import evaluate_lists, evaluate_pairs
from jobloom.plans.silver import clean_descriptions, clean_fields, clean_jobs, select_raw

# The cleaned postings in SQL: one row per raw row.
CLEAN_SQL = rf"""select id as job_id, lower(trim(title)) as title, trim(company) as company,
    trim(location) as location, try_cast(latitude as double) as lat,
    try_cast(longitude as double) as lon,
    regexp_replace(lower(description), '[\s\x{{0b}}]+', ' ', 'g') as description, category,
    cast(salary_min as double) as salary_min, cast(salary_max as double) as salary_max,
    case when salary_min is not null and salary_max is not null
      then (cast(salary_min as double) + cast(salary_max as double)) / 2
      else cast(salary_max as double) end as salary_mid,
    created as posted_raw, redirect_url as url, try_cast(created as timestamp) as posted_ts,
    cast(try_cast(created as timestamp) as date) as dt
  from ({RAW_JOBS_SQL})"""

_NEWEST = ("posted_ts desc nulls last, job_id, url nulls first, title nulls first, "
           "salary_mid desc nulls last")

DISTINCT_SQL = f"""select * exclude (rn) from (select *, row_number() over (
    partition by sha256(concat_ws('||', title, company, location)) order by {_NEWEST}) as rn
  from ({CLEAN_SQL})) where rn = 1"""

SILVER_SQL = f"""with d as ({DISTINCT_SQL}),
  q as (select quantile_disc(salary_mid, 0.25) as q1, quantile_disc(salary_mid, 0.75) as q3
        from d),
  o as (select d.* replace (case when salary_mid between q1 - 1.5 * (q3 - q1)
          and q3 + 1.5 * (q3 - q1) then salary_mid end as salary_mid) from d, q)
  select * exclude (rn) from (select *, row_number() over (
    partition by job_id order by {_NEWEST}) as rn from o) where rn = 1"""

_SHOWN_SQL = f"""job_id, title, company, location, lat, lon, md5(description) as description,
  category, salary_min, salary_max, salary_mid, posted_raw, {sql_stamp('posted_ts')} as posted_ts,
  cast(dt as string) as dt, url"""


def shown(df):
    """Long and engine-specific values in a comparable form."""
    return df.select(
        "job_id", "title", "company", "location", "lat", "lon",
        F.md5("description").alias("description"), "category", "salary_min", "salary_max",
        "salary_mid", "posted_raw", stamp("posted_ts").alias("posted_ts"),
        F.col("dt").cast("string").alias("dt"), "url")


@case(f"select {_SHOWN_SQL} from ({DISTINCT_SQL})")
def d1(t):
    return shown(clean_descriptions(dedupe.newest_posting(clean_fields(select_raw(raw_jobs(t))))))


@case(f"""select {_SHOWN_SQL} from (select *, row_number() over (
        partition by job_id order by {_NEWEST}) as rn from ({CLEAN_SQL})) where rn = 1""")
def d2(t):
    return shown(clean_descriptions(dedupe.newest_per_job(clean_fields(select_raw(raw_jobs(t))))))


@case("""select doc_id, source, md5(text) as question from (select *, row_number() over (
        partition by text order by source, doc_id) as rn from documents) where rn = 1""")
def d3(t):
    rows = t.documents.select("doc_id", "source", F.col("text").alias("question"))
    kept = dedupe.first_question(rows, [F.col("source").asc(), F.col("doc_id").asc()])
    return kept.withColumn("question", F.md5("question"))


@case("select distinct l_partkey, l_suppkey from lineitem")
def d4(t):
    return dedupe.distinct_pairs(t.lineitem, "l_partkey", "l_suppkey")


@case(f"""select user_id, event_id, event_type from (select *, row_number() over (
        partition by user_id order by ts, event_id) as rn from events) where rn = 1""")
def d5(t):
    seen = dedupe.first_seen(t.events.withColumn("user", F.col("user_id").cast("string")), "user",
                             [F.col("ts").asc(), F.col("event_id").asc()])
    return seen.select("user_id", "event_id", "event_type")


@case("select p_name as title, min(p_partkey) as rank from part group by 1 order by 2")
def d6(t):
    rows = t.part.select(F.col("p_name").alias("title"), F.col("p_partkey").alias("rank"))
    return dedupe.distinct_in_order(rows, "title", "rank")


@case("""select p_name as skill, cast(count(*) as bigint) as count
      from lineitem join part on l_partkey = p_partkey
      group by p_name order by count desc, skill limit 20""")
def d7(t):
    """The twenty most frequent values, ties by name."""
    named = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return demand.top_skills(named.select(F.col("p_name").alias("skill")), n=20)


@case("""select row_number() over (order by source, doc_id) as q_id, doc_id, source
      from documents""")
def d8(t):
    rows = t.documents.select("doc_id", "source")
    return dedupe.dense_ids(rows, [F.col("source").asc(), F.col("doc_id").asc()], "q_id")


@case("""select quantile_disc(o_totalprice, 0.25) as q1, quantile_disc(o_totalprice, 0.5) as q2,
        quantile_disc(o_totalprice, 0.75) as q3 from orders""")
def e1(t):
    q = quantiles.quantiles(t.orders, "o_totalprice", [0.25, 0.5, 0.75], relative_error=0)
    return q.select(*[F.col("q")[i].alias(f"q{i + 1}") for i in range(3)])


@case("select true as q1_close, true as q3_close from orders limit 1")
def e1_close(t):
    """Whether the approximate quartiles stay within the promised rank error."""
    q = quantiles.quantiles(t.orders, "o_totalprice", [0.25, 0.75], 0.05).scalar()
    ranked = t.orders.select("o_totalprice", q.alias("q"))
    below = ranked.agg(
        *[F.avg((F.col("o_totalprice") <= F.col("q")[i]).cast("int")).alias(f"s{i}")
          for i in (0, 1)])
    return below.select((F.abs(F.col("s0") - 0.25) <= 0.05).alias("q1_close"),
                        (F.abs(F.col("s1") - 0.75) <= 0.05).alias("q3_close"))


_SKEWED = "l_extendedprice * l_quantity"


@case(f"""with v as (select l_orderkey, l_linenumber, {_SKEWED} as pay from lineitem),
      q as (select quantile_disc(pay, 0.25) as q1, quantile_disc(pay, 0.75) as q3 from v)
      select l_orderkey, l_linenumber, cast(count(*) as bigint) as rows,
        cast(count(case when pay between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)
          then pay end) as bigint) as kept,
        round(max(case when pay between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)
          then pay end), 4) as most
      from v, q group by 1, 2""")
def e2(t):
    pay = t.lineitem.selectExpr("l_orderkey", "l_linenumber", f"{_SKEWED} as pay")
    return quantiles.null_outliers(pay, "pay", relative_error=0).groupBy(
        "l_orderkey", "l_linenumber").agg(
        F.count("*").alias("rows"), F.count("pay").alias("kept"),
        F.round(F.max("pay"), 4).alias("most"))


@case(f"""select skill, cast(count(*) as bigint) as count from ({JOB_SKILLS_SQL})
      where job_id in (select cast(o_orderkey as string) from orders
                       where o_orderpriority = '1-URGENT')
      group by 1 order by 2 desc, 1 limit 15""")
def e3(t):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").cast("string").alias("job_id"))
    return demand.top_skills(job_skill_rows(t).select("job_id", "skill"), urgent, 15)


_TRUTH = f"select distinct job_id, skill from ({JOB_SKILLS_SQL}) where l_quantity > 25"
_FOUND = f"select distinct job_id, skill from ({JOB_SKILLS_SQL}) where l_discount >= 0.05"

SCORES_SQL = f"""with c as (select
    count(case when a.skill is not null and b.skill is not null then 1 end) as tp,
    count(case when a.skill is null then 1 end) as fp,
    count(case when b.skill is null then 1 end) as fn
  from ({_TRUTH}) a full join ({_FOUND}) b on a.job_id = b.job_id and a.skill = b.skill)
  select cast(tp as bigint) as total_tp, cast(fp as bigint) as total_fp,
    cast(fn as bigint) as total_fn, round(tp / (tp + fp), 9) as precision,
    round(tp / (tp + fn), 9) as recall, round(2.0 * tp / (2 * tp + fp + fn), 9) as f1_score
  from c"""


def _rounded(df):
    return df.select("total_tp", "total_fp", "total_fn", *[
        F.round(c, 9).alias(c) for c in ("precision", "recall", "f1_score")])


def skill_lists(t):
    """Per job the two skill lists; an order has a handful of lines, so lists stay short."""
    rows = job_skill_rows(t)
    return rows.groupBy("job_id").agg(
        F.collect_set(F.when(F.col("l_quantity") > 25, F.col("skill"))).alias("truth"),
        F.collect_set(F.when(F.col("l_discount") >= 0.05, F.col("skill"))).alias("predicted"))


@case(SCORES_SQL)
def e4(t):
    return _rounded(evaluate_lists(skill_lists(t), "truth", "predicted"))


@case(SCORES_SQL)
def e4_pairs(t):
    rows = job_skill_rows(t)
    return _rounded(evaluate_pairs(rows.filter("l_quantity > 25"),
                                   rows.filter("l_discount >= 0.05"), "job_id"))


@case(f"""select lower(o_orderpriority) as role_title, skill, cast(count(*) as bigint)
        as demand_count
      from (select cast(o_orderkey as string) as job_id, o_orderpriority from orders)
      join ({JOB_SKILLS_SQL}) using (job_id) group by 1, 2""")
def e5(t):
    jobs = t.orders.select(F.col("o_orderkey").cast("string").alias("job_id"),
                           F.col("o_orderpriority").alias("title"))
    return demand.role_skill_demand(jobs, job_skill_rows(t).select("job_id", "skill"))


@case(f"""select 'found' as stage, cast(count(*) as bigint) as rows from ({RAW_JOBS_SQL})
      union all select 'kept', cast(count(*) as bigint) from ({DISTINCT_SQL})""")
def e6(t):
    raw, found = counted(clean_fields(select_raw(raw_jobs(t))), "found")
    kept, saved = counted(dedupe.newest_posting(raw), "kept")
    kept.write.format("noop").mode("overwrite").save()
    rows = [("found", found.get["rows"]), ("kept", saved.get["rows"])]
    return t.spark.createDataFrame(rows, "stage string, rows long")


@case(f"select {_SHOWN_SQL} from ({SILVER_SQL})")
def i1(t):
    return shown(clean_jobs(raw_jobs(t), relative_error=0))


_IDS = ("case when cast(id as bigint) % 7 = 0 then null when cast(id as bigint) % 11 = 0 "
        "then ' ' else id end")


@case(f"select {_SHOWN_SQL} from ({SILVER_SQL})".replace(
    f"from ({RAW_JOBS_SQL})", f"from (select * from (select * replace ({_IDS} as id) "
    f"from ({RAW_JOBS_SQL})) where trim(id) <> '')"))
def i1_bad_ids(t):
    """Postings without an id, or with a blank one, are dropped."""
    return shown(clean_jobs(raw_jobs(t).withColumn("id", F.expr(_IDS)), relative_error=0))


CASES = {
    "d1_newest_per_business_key": d1,
    "d2_newest_per_job": d2,
    "d3_first_of_equal_questions": d3,
    "d4_distinct_pairs": d4,
    "d5_first_seen_id": d5,
    "d6_distinct_in_first_order": d6,
    "d7_sorted_head": d7,
    "d8_dense_ids": d8,
    "e1_exact_quartiles": e1,
    "e1_approximate_quartiles": e1_close,
    "e2_outliers_to_null": e2,
    "e3_top_skills": e3,
    "e4_precision_recall_lists": e4,
    "e4_precision_recall_pairs": e4_pairs,
    "e5_role_skill_demand": e5,
    "e6_stage_counts": e6,
    "i1_silver_jobs": i1,
    "i1_silver_jobs_without_ids": i1_bad_ids,
}

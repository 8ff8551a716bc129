"""Sinks and table maintenance (B1-B11)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.aggregates import SCORES_SQL, skill_lists
from catalog.common import RAW_JOBS_ONCE_SQL, case, raw_jobs_once, sql_stamp, stamp
from jobloom.functions.vectors import parse_vector
from jobloom.operators import merge
from jobloom.operators.dedupe import dense_ids, first_per_key
from jobloom.operators.evaluation import evaluate_lists
from jobloom.plans.report import write_report
from jobloom.plans.silver import clean_fields, select_raw
from jobloom.session import scratch_path
from jobloom.sources import jobs as job_files
from jobloom.sources import tables


@case(f"""select id as job_id, strftime(try_cast(created as timestamp), '%Y-%m-%d') as dt,
        md5(description) as description from ({RAW_JOBS_ONCE_SQL})""")
def b1(t):
    path = scratch_path(t.spark, "jobs")
    tables.write_silver(clean_fields(select_raw(raw_jobs_once(t))), path)
    return tables.read_silver(t.spark, path).select(
        "job_id", F.col("dt").cast("string").alias("dt"),
        F.md5("description").alias("description"))


@case("""select o_orderkey, round(case when o_orderdate >= timestamp '1996-06-01' then 2 else 1 end
        * o_totalprice, 2) as o_totalprice,
        strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as dt from orders""")
def b1_update(t):
    """Orders up to 1996 as stored, those from June 1996 on as new rows at twice the price."""
    path, new = scratch_path(t.spark, "orders"), scratch_path(t.spark, "new-orders")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.trunc("o_orderdate", "month").alias("dt"))
    tables.write_silver(rows.filter("dt < date '1997-01-01'"), path)
    rows.filter("dt >= date '1996-06-01'").withColumn(
        "o_totalprice", F.col("o_totalprice") * 2).write.parquet(new)
    tables.update_silver(t.spark.read.parquet(new), path, "o_orderkey", lambda both: first_per_key(
        both, ["o_orderkey"], [F.col("o_totalprice").desc()]))
    return tables.read_silver(t.spark, path).select(
        "o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"),
        F.col("dt").cast("string").alias("dt"))


@case("select cast(doc_id as string) as id, md5(text) as description, lang as title from documents")
def b2(t):
    root = scratch_path(t.spark, "landed")
    rows = t.documents.select(F.col("doc_id").cast("string").alias("id"),
                              F.col("lang").alias("title"), F.col("text").alias("description"))
    job_files.write_bronze(rows, root, "2024-05-01")
    return job_files.read_bronze(t.spark, root).select(
        "id", F.md5("description").alias("description"), "title")


@case("""select l_orderkey, l_linenumber, cast(count(*) as bigint) as rows from lineitem
      group by 1, 2 having count(*) > 1""")
def b3(t):
    return merge.require_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


_MERGED = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
_TARGET = "o_orderdate < timestamp '1999-01-01'"
_STAGE = "o_orderdate >= timestamp '1997-01-01'"


@case(f"""with t as (select * from orders where {_TARGET}),
      s as (select o_orderkey, o_custkey + 1 as o_custkey, lower(o_orderstatus) as o_orderstatus,
              o_totalprice * 2 as o_totalprice, nullif(o_orderpriority, '5-LOW') as o_orderpriority
            from orders where {_STAGE})
      select coalesce(t.o_orderkey, s.o_orderkey) as o_orderkey,
        case when t.o_orderkey is not null then t.o_custkey else s.o_custkey end as o_custkey,
        case when s.o_orderkey is not null then s.o_orderstatus else t.o_orderstatus end
          as o_orderstatus,
        case when t.o_orderkey is not null then t.o_totalprice else s.o_totalprice end
          as o_totalprice,
        case when s.o_orderkey is not null then s.o_orderpriority else t.o_orderpriority end
          as o_orderpriority
      from t full join s on t.o_orderkey = s.o_orderkey""")
def b4(t):
    """Old orders as target, newer ones as stage; both hold 1997 and 1998."""
    target = t.orders.filter(_TARGET).select(*_MERGED)
    stage = t.orders.filter(_STAGE).selectExpr(
        "o_orderkey", "o_custkey + 1 as o_custkey", "lower(o_orderstatus) as o_orderstatus",
        "o_totalprice * 2 as o_totalprice", "nullif(o_orderpriority, '5-LOW') as o_orderpriority")
    return merge.upsert(target, stage, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


@case("""select l_partkey, l_suppkey from lineitem where l_returnflag <> 'R'
      except select l_partkey, l_suppkey from lineitem where l_returnflag = 'R'""")
def b5(t):
    keys = ["l_partkey", "l_suppkey"]
    return merge.new_pairs(t.lineitem.filter("l_returnflag = 'R'"),
                           t.lineitem.filter("l_returnflag <> 'R'"), keys)


@case("""with t as (select cast(vec_id as string) as job_id, embedding from embeddings
                  where label < 6),
      s as (select cast(vec_id as string) as job_id, list_reverse(embedding) as embedding
            from embeddings where label >= 4)
      select coalesce(s.job_id, t.job_id) as job_id, array_to_string(list_transform(
        coalesce(s.embedding, t.embedding), lambda x: cast(round(x::double * 1e6) as bigint)), ' ')
        as parts
      from t full join s on t.job_id = s.job_id""")
def b6(t):
    target = t.embeddings.filter("label < 6").select(
        F.col("vec_id").cast("string").alias("job_id"), "embedding")
    stage = t.embeddings.filter("label >= 4").select(
        F.col("vec_id").alias("job_id"),
        F.reverse("embedding").cast("array<double>").alias("embedding"))
    merged = merge.upsert_vectors(target, stage, "job_id", 64)
    parts = F.transform("embedding", lambda x: F.round(x.cast("double") * 1e6).cast("bigint"))
    return merged.select("job_id", F.array_join(parts.cast("array<string>"), " ").alias("parts"))


@case("""select row_number() over (order by conv_id, turn) as q_id, md5(text) as question,
        role as topic, true as stamped from conversations""")
def b7(t):
    rows = t.conversations.select("conv_id", "turn", F.col("text").alias("question"),
                                  F.col("role").alias("topic"))
    numbered = dense_ids(rows, [F.col("conv_id").asc(), F.col("turn").asc()], "q_id")
    path = scratch_path(t.spark, "questions")
    numbered.withColumn("created_at", F.current_timestamp()).write.parquet(path)
    return t.spark.read.parquet(path).select(
        "q_id", F.md5("question").alias("question"), "topic",
        F.col("created_at").isNotNull().alias("stamped"))


@case(SCORES_SQL)
def b8(t):
    path = scratch_path(t.spark, "report")
    write_report(evaluate_lists(skill_lists(t), "truth", "predicted"), path)
    schema = ("total_tp long, total_fp long, total_fn long, precision double, recall double, "
              "f1_score double")
    return t.spark.read.schema(schema).json(path).select(
        "total_tp", "total_fp", "total_fn",
        *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1_score")])


@case(f"""with r as (select *, cast(id as bigint) % 2 = 0 as again from ({RAW_JOBS_ONCE_SQL}))
      select id as job_id,
        case when again then 'second ' else '' end || lower(trim(title)) as title,
        redirect_url as url,
        trim(company) || case when again then '|more' else '' end as skills,
        round(case when again then embedding[64] else embedding[1] end::double, 6) as first
      from r join embeddings on cast(vec_id as string) = id""")
def b_warehouse(t):
    """Two loads through the warehouse: half of the postings come again, changed. The second
    load's address is not taken over, its title and vector are, its skill is added."""
    w = tables.Warehouse(t.spark, f"jobloom_{uuid.uuid4().hex[:12]}",
                         scratch_path(t.spark, "warehouse"), dim=64, buckets=4)
    w.ensure_tables()
    first = clean_fields(select_raw(raw_jobs_once(t)))
    again = F.col("job_id").cast("bigint") % 2 == 0
    second = first.filter(again).withColumns({
        "title": F.concat(F.lit("second "), "title"), "url": F.lit("another")})
    vectors = t.embeddings.select(F.col("vec_id").cast("string").alias("job_id"), "embedding")
    skills = first.select("job_id", F.col("company").alias("skill"))
    for rows, found, vector in (
            (first, skills, vectors),
            (second, skills.union(second.select("job_id", F.lit("more"))),
             vectors.filter(again).withColumn("embedding", F.reverse("embedding")))):
        w.upsert_jobs(rows)
        w.add_skills("job_skills_ner", found)
        w.upsert_embeddings("job_embeddings", vector)
    listed = w.table("job_skills_ner").groupBy("job_id").agg(F.array_sort(F.collect_list(
        F.struct((F.col("skill") == "more").alias("added"), "skill"))).alias("s"))
    return w.table("jobs").join(w.table("job_embeddings"), "job_id").join(listed, "job_id").select(
        "job_id", "title", "url",
        F.array_join(F.transform("s", lambda x: x["skill"]), "|").alias("skills"),
        F.round(F.col("embedding")[0].cast("double"), 6).alias("first"))


@case(f"""with j as (select id as job_id, lower(case when cast(id as bigint) % 2 = 0
          then company else location end) as role_title, category from ({RAW_JOBS_ONCE_SQL}))
      select trim(role_title) as role_title, skill, cast(count(*) as bigint) as demand_count from (
        select job_id, role_title, category as skill from j
        union select job_id, role_title, 'more' from j where cast(job_id as bigint) % 3 = 0)
      group by 1, 2""")
def b_counts(t):
    """Counts kept up to date over three loads: skills, then other titles for half of the jobs,
    then further skills."""
    w = tables.Warehouse(t.spark, f"jobloom_{uuid.uuid4().hex[:12]}",
                         scratch_path(t.spark, "warehouse"), dim=64, buckets=4, count_demand=True)
    w.ensure_tables()
    jobs = clean_fields(select_raw(raw_jobs_once(t))).withColumn("title", F.col("location"))
    w.upsert_jobs(jobs)
    w.add_skills("job_skills_ner", jobs.select("job_id", F.col("category").alias("skill")))
    w.upsert_jobs(jobs.filter("cast(job_id as bigint) % 2 = 0").withColumn("title", F.col("company")))
    w.add_skills("job_skills_ner", jobs.filter("cast(job_id as bigint) % 3 = 0").select(
        "job_id", F.lit("more").alias("skill")))
    return w.table("v_role_skill_counts")


@case("""select row_number() over (order by conv_id, turn) as q_id, md5(text) as question,
        role as topic, true as stamped from conversations""")
def b_questions(t):
    """Questions loaded twice through the warehouse: ids start anew, vectors are emptied."""
    w = tables.Warehouse(t.spark, f"jobloom_{uuid.uuid4().hex[:12]}",
                         scratch_path(t.spark, "warehouse"), dim=64, buckets=4)
    w.ensure_tables()
    rows = t.conversations.select("conv_id", "turn", F.col("text").alias("question"),
                                  F.col("role").alias("topic"), F.lit("talk").alias("source"))
    for _ in range(2):
        loaded = w.reload_questions(rows, [F.col("conv_id").asc(), F.col("turn").asc()])
    return loaded.select("q_id", F.md5("question").alias("question"), "topic",
                         F.col("created_at").isNotNull().alias("stamped"))


_BAD = "case when event_type = 'error' then 'soon' else {ts} end"


@case(f"""with e as (select event_id, {_BAD.format(ts=sql_stamp('ts'))} as posted_ts from events)
      select event_id, {sql_stamp('try_cast(posted_ts as timestamp)')} as posted_ts,
        strftime(try_cast(posted_ts as timestamp), '%Y-%m-%d') as dt from e""")
def b9(t):
    text = F.when(F.col("event_type") == "error", "soon").otherwise(stamp("ts"))
    loaded = merge.coerce_jobs(t.events.select("event_id", text.alias("posted_ts")))
    return loaded.select("event_id", stamp("posted_ts").alias("posted_ts"),
                         F.col("dt").cast("string").alias("dt"))


@case("""select vec_id, cast(len(embedding) as bigint) as dim,
        round(list_sum(embedding::double[]), 5) as total from embeddings""")
def b10(t):
    text = F.concat(F.lit("{"), F.array_join(F.col("embedding").cast("array<string>"), ","),
                    F.lit("}"))
    back = t.embeddings.select("vec_id", parse_vector(text).alias("v"))
    total = F.aggregate(F.col("v").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return back.select("vec_id", F.size("v").cast("bigint").alias("dim"),
                       F.round(total, 5).alias("total"))


CASES = {
    "b1_silver_write": b1,
    "b1_silver_update": b1_update,
    "b2_bronze_write": b2,
    "b3_key_check": b3,
    "b4_upsert_rows": b4,
    "b5_insert_new_pairs": b5,
    "b6_upsert_vectors": b6,
    "b7_b11_reload_with_ids": b7,
    "b3_b6_warehouse_loads": b_warehouse,
    "e5_counts_kept_by_loads": b_counts,
    "b7_b11_warehouse_questions": b_questions,
    "b8_report_json": b8,
    "b9_load_coercion": b9,
    "b10_vector_text": b10,
}

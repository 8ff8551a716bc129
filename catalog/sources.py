"""Scans (A1-A7) and question-file rules (C12, C13): files are written from the test
tables first, then read back by the operator."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.common import RAW_JOBS_ONCE_SQL, case, raw_jobs_once, sql_collapse, sql_strip
from jobloom.plans.questions import clean_questions
from jobloom.plans.silver import select_raw
from jobloom.schemas import API_PAGE, BRONZE_JOBS
from jobloom.session import checkpoint, scratch_path
from jobloom.sources import jobs, questions, tables
from jobloom.sources.ledger import Ledger


def bronze(t):
    """The raw postings with bronze types."""
    raw = select_raw(raw_jobs_once(t))
    back = {"job_id": "id", "lat": "latitude", "lon": "longitude", "posted_raw": "created",
            "url": "redirect_url"}
    return raw.withColumnsRenamed(back).select(*BRONZE_JOBS.fieldNames())




@case(f"""select id, title, company, location, try_cast(latitude as double) as latitude,
        cast(salary_min as double) as salary_min, md5(description) as description, created,
        case when category = 'src0' then '2024-03-01' else '2024-03-02' end as date
      from ({RAW_JOBS_ONCE_SQL})""")
def a1(t):
    root = scratch_path(t.spark, "bronze")
    day = F.when(F.col("category") == "src0", "2024-03-01").otherwise("2024-03-02")
    jobs.write_bronze(bronze(t), root, day)
    return jobs.read_bronze(t.spark, root).select(
        "id", "title", "company", "location", "latitude", "salary_min",
        F.md5("description").alias("description"), "created",
        F.col("date").cast("string").alias("date"))


@case("""select cast(doc_id as string) as id, md5(text) as description from documents
      where doc_id % 2 = 1""")
def a1_unread(t):
    """Two days of landed postings, of which the first has been loaded before."""
    root = scratch_path(t.spark, "landed")
    ledger = Ledger(t.spark, scratch_path(t.spark, "ledger"))
    rows = t.documents.select(F.col("doc_id").cast("string").alias("id"),
                              F.col("text").alias("description"), (F.col("doc_id") % 2).alias("odd"))
    for odd, day in ((0, "2024-05-01"), (1, "2024-05-02")):
        jobs.write_bronze(rows.filter(F.col("odd") == odd).drop("odd"), root, day)
        new = checkpoint(ledger.unread(root))
        ledger.record(new)
    paths = [r.path for r in new.select("path").collect()]
    return jobs.read_bronze(t.spark, root, paths).select("id", F.md5("description").alias("description"))


@case("""select strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as dt,
        cast(count(*) as bigint) as rows,
        round(sum(o_totalprice), 2) as price from orders group by 1""")
def a2(t):
    path = scratch_path(t.spark, "silver")
    tables.write_silver(t.orders.withColumn("dt", F.trunc("o_orderdate", "month")), path)
    return tables.read_silver(t.spark, path).groupBy(F.col("dt").cast("string").alias("dt")).agg(
        F.count("*").alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("price"))


def _write_csv(df, path, encoding):
    df.write.option("header", True).option("encoding", encoding).option("escape", '"').option(
        "quoteAll", True).mode("append").csv(path)


# Latin-1 cannot hold every letter, so those files carry hashes and one accented word.
_CSV_ROWS = """
  select trim(text) as question, 'technical' as topic from benchmark
  union all select 'résumé ' || md5(text), case when role = 'user' then 'TECHnical' else 'hr' end
  from conversations"""


def _question_folder(t):
    root = scratch_path(t.spark, "questions")
    _write_csv(t.benchmark.select(F.trim("text").alias(" Questions ")), f"{root}/a", "UTF-8")
    talk = t.conversations.select(
        F.when(F.col("role") == "user", "TECHnical").otherwise("hr").alias("Topic"),
        F.concat(F.lit("résumé "), F.md5("text")).alias("QUESTION"))
    _write_csv(talk, f"{root}/b", "ISO-8859-1")
    _write_csv(t.benchmark.select("item_id", F.col("text").alias("answer")), f"{root}/c", "UTF-8")
    return f"{root}/*"


@case(f"""select md5(question) as question, topic, cast(count(*) as bigint) as rows
      from ({_CSV_ROWS}) group by 1, 2""")
def a3(t):
    read = questions.read_question_csvs(t.spark, _question_folder(t))
    return read.groupBy(F.md5("question").alias("question"), "topic").agg(
        F.count("*").alias("rows"))


@case(f"""select md5(question) as question, topic from (
        select distinct {sql_strip('question')} as question, topic from ({_CSV_ROWS})
        where topic ilike '%tech%')""")
def i3(t):
    read = questions.read_question_csvs(t.spark, _question_folder(t))
    kept = clean_questions(read, questions.row_order())
    return kept.select(F.md5("question").alias("question"), "topic")


@case(f"""with q as (select trim(text) as question from benchmark
        union all select regexp_replace(trim(text), '\\s+', ' ', 'g') from benchmark
        union all select 'item ' || doc_id || ' ' || lang from documents)
      select md5(question) as question, 'technical' as topic from (
        select distinct {sql_strip('question')} as question from q) where question <> ''""")
def i3_folder(t):
    """One folder with a CSV that begins with a blank line, numbered and tabbed text, HTML."""
    root = scratch_path(t.spark, "folder")
    quoted = F.concat(F.lit('"'), F.replace(F.trim("text"), F.lit('"'), F.lit('""')), F.lit('"'))
    t.benchmark.select(F.concat(F.lit("\n  \nQuestions\n"), quoted)).repartition(3).write.option(
        "lineSep", "\n").option("maxRecordsPerFile", 1).text(f"{root}/csv")
    line = F.regexp_replace(F.trim("text"), r"\s+", " ")
    number = F.col("item_id").cast("string")
    t.benchmark.select(F.concat(number, F.when(F.col("item_id") % 2 == 0, ". ").otherwise("\t"),
                                line)).write.text(f"{root}/lists")
    item = F.concat(F.lit("<li>item "), F.col("doc_id").cast("string"), F.lit(" <b>"), "lang",
                    F.lit("</b></li>"))
    t.documents.select(item).write.text(f"{root}/pages")
    for part, kind in (("csv", "csv"), ("lists", "txt"), ("pages", "html")):
        _rename(t.spark, f"{root}/{part}", kind)
    raw = questions.read_question_folder(t.spark, f"{root}/*")
    return clean_questions(raw, questions.row_order()).select(
        F.md5("question").alias("question"), "topic")


def _rename(spark, folder, kind):
    """Text files under the name that a reader looks for."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(place):
        old = f.getPath()
        if old.getName().endswith(".txt"):
            fs.rename(old, jvm.org.apache.hadoop.fs.Path(place, old.getName()[:-3] + kind + ".tmp"))
    for f in fs.listStatus(place):
        old = f.getPath()
        if old.getName().endswith(".tmp"):
            fs.rename(old, jvm.org.apache.hadoop.fs.Path(place, old.getName()[:-4]))


@case("""with o as (select regexp_replace(trim(text), '\\s+', ' ', 'g') as q from benchmark)
      select 'numbered' as form, md5(q) as question, 'technical' as topic from o
      union all select 'tabbed', md5(q), 'technical' from o""")
def a4(t):
    root = scratch_path(t.spark, "lists")
    line = t.benchmark.select("item_id", F.regexp_replace(
        F.trim("text"), r"\s+", " ").alias("q"))
    line.select(F.concat(F.col("item_id").cast("string"), F.lit(". "), "q")).write.text(
        f"{root}/numbered")
    line.select(F.col("item_id").alias("S.No"), F.col("q").alias("Questions")).write.csv(
        f"{root}/tabbed", sep="\t", header=True, quoteAll=True, escape='"')
    numbered = questions.read_numbered_text(t.spark, f"{root}/numbered")
    tabbed = questions.read_tabbed_text(t.spark, f"{root}/tabbed")
    return numbered.select(F.lit("numbered").alias("form"), F.md5("question").alias("question"),
                           "topic").union(
        tabbed.select(F.lit("tabbed"), F.md5("question"), "topic"))


@case(f"""with i as (select page_id, unnest(list_filter(list_transform(
          string_split_regex(html, '(?i)<li\\b[^>]*>')[2:],
          lambda p: {sql_strip(sql_collapse(
              "regexp_replace(string_split_regex(p, '(?i)</?(?:li|ul|ol)\\b')[1], "
              "'<[^>]+>', ' ', 'g')"))}), lambda p: p <> '')) as question from pages)
      select page_id, question, cast(count(*) as bigint) as rows from i group by 1, 2""")
def a4_html(t):
    items = t.pages.select("page_id", F.explode(questions.list_items("html")).alias("question"))
    return items.groupBy("page_id", "question").agg(F.count("*").alias("rows"))


@case("""select md5(text) as question, role as topic, '2025-12-06 01:02:03' as loaded_at
      from conversations""")
def a5(t):
    root = scratch_path(t.spark, "snapshots")
    rows = t.conversations.select(F.col("text").alias("question"), F.lit("talk").alias("source"),
                                  F.col("role").alias("topic"))
    rows.write.json(f"{root}/interview_raw_20251205_220439.jsonl")
    rows.write.json(f"{root}/interview_raw_20251206_010203.jsonl")
    newest = questions.read_latest_snapshot(t.spark, f"{root}/*")
    return newest.select(F.md5("question").alias("question"), "topic", F.date_format(
        "loaded_at", "yyyy-MM-dd HH:mm:ss").alias("loaded_at"))


def pages(t):
    """One landed page per document: its posting twice, ids shared by equal lengths."""
    d = t.documents
    posting = F.struct(
        F.col("n_chars").cast("string").alias("id"), F.col("lang").alias("title"),
        F.struct(F.col("source").alias("display_name")).alias("company"),
        F.struct(F.nullif(F.col("lang"), F.lit("es")).alias("display_name")).alias("location"),
        F.col("doc_id").cast("double").alias("latitude"), F.col("text").alias("description"),
        F.struct(F.lit("it").alias("label")).alias("category"))
    again = posting.withField("title", F.concat(F.lit("again "), "lang"))
    body = F.to_json(F.struct(F.lit(2).alias("count"), F.array(posting, again).alias("results")))
    return d.select(F.col("doc_id").alias("page"), body.alias("body"))


_FLAT = """select doc_id as page, 0 as position, cast(n_chars as string) as id, lang as title,
    source as company, nullif(lang, 'es') as location, cast(doc_id as double) as latitude,
    md5(text) as description, 'it' as category from documents
  union all select doc_id, 1, cast(n_chars as string), 'again ' || lang, source,
    nullif(lang, 'es'), cast(doc_id as double), md5(text), 'it' from documents"""


def _parsed(t):
    return pages(t).select("page", F.from_json("body", API_PAGE).alias("p")).select("page", "p.*")


@case(f"select * from ({_FLAT})")
def a6(t):
    return jobs.flatten_pages(_parsed(t)).select(
        "page", "position", "id", "title", "company", "location", "latitude",
        F.md5("description").alias("description"), "category")


@case(f"""select id, title, company, location, latitude, description, category
      from (select *, row_number() over (partition by id order by page, position) as rn
            from ({_FLAT})) where rn = 1""")
def a6_landed(t):
    return jobs.land_jobs(_parsed(t)).select(
        "id", "title", "company", "location", "latitude",
        F.md5("description").alias("description"), "category")


@case("""select o_orderpriority, cast(count(*) as bigint) as rows from orders
      where o_totalprice >= 1000.5 and o_orderstatus <> 'P' group by 1""")
def a7(t):
    view = f"orders_{uuid.uuid4().hex}"
    t.orders.createOrReplaceTempView(view)
    return tables.run_query(
        t.spark, f"""select o_orderpriority, count(*) as rows from {view}
        where o_totalprice >= :least and o_orderstatus <> :status group by 1""",
        {"least": 1000.5, "status": "P"})


CASES = {
    "i3_question_folder": i3_folder,
    "a1_bronze_jobs_scan": a1,
    "a1_unread_files": a1_unread,
    "a2_silver_scan": a2,
    "a3_c12_c13_question_csv_folder": a3,
    "a4_question_lists": a4,
    "a4_html_list_items": a4_html,
    "a5_latest_snapshot": a5,
    "a6_flatten_pages": a6,
    "a6_land_first_seen": a6_landed,
    "a7_parameterised_sql": a7,
    "i3_question_cleaning": i3,
}

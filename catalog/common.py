"""Shared pieces: table access and the derived inputs, written once for both engines."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Case:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Tables:
    """Attribute access to the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def case(sql: str | None = None):
    """Turn a function of Tables into a Case."""

    def wrap(fn: Callable[[Tables], DataFrame]) -> Case:
        return Case(lambda spark, folder: fn(Tables(spark, folder)), sql)

    return wrap


# Postings made from documents: name -> expression valid in Spark and in DuckDB.
RAW_JOB = {
    "id": "cast(doc_id as string)",
    "title": "concat('  ', lang, ' Role ', cast(n_chars as string), ' ')",
    "company": "concat(' ', lang, ' ')",
    "location": "nullif(lang, 'es')",
    "latitude": "case when source = 'src4' then 'unknown' else cast(n_chars as string) end",
    "longitude": "case when source = 'src6' then null else cast(doc_id as string) end",
    "description": "text",
    "category": "source",
    "salary_min": "case when source = 'src3' then null else n_chars * 10 end",
    "salary_max": "case when source = 'src5' then null else n_chars * 12 end",
    "created": "case when source = 'src7' then 'not a date' else concat('2024-01-', "
               "lpad(cast(doc_id * 7 % 28 + 1 as string), 2, '0'), ' 00:00:00') end",
    "redirect_url": "concat('https://jobs.example/', cast(doc_id as string))",
}

# A later version of every posting: other title, same id, one month on.
_UPDATED = {
    **RAW_JOB,
    "title": "concat('updated ', lang, ' role ', cast(n_chars as string))",
    "created": "case when source = 'src9' then null else concat('2024-02-', "
               "lpad(cast(doc_id * 5 % 28 + 1 as string), 2, '0'), ' 00:00:00') end",
}


def _select(columns: dict[str, str], table: str) -> str:
    return "select " + ", ".join(f"{e} as {n}" for n, e in columns.items()) + f" from {table}"


RAW_JOBS_SQL = f"{_select(RAW_JOB, 'documents')} union all {_select(_UPDATED, 'documents')}"
RAW_JOBS_ONCE_SQL = _select(RAW_JOB, "documents")


def raw_jobs_once(t: Tables) -> DataFrame:
    return t.documents.selectExpr(*[f"{e} as {n}" for n, e in RAW_JOB.items()])


def raw_jobs(t: Tables) -> DataFrame:
    later = t.documents.selectExpr(*[f"{e} as {n}" for n, e in _UPDATED.items()])
    return raw_jobs_once(t).unionByName(later)


# (job, skill) pairs: the brands of the parts on an order.
JOB_SKILLS_SQL = ("select cast(l_orderkey as string) as job_id, p_brand as skill, "
                  "l_quantity, l_discount from lineitem join part on l_partkey = p_partkey")


def job_skill_rows(t: Tables) -> DataFrame:
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").cast("string").alias("job_id"), F.col("p_brand").alias("skill"),
        "l_quantity", "l_discount")


# Jobs with vectors: documents and embeddings share their ids.
JOBS = {
    "job_id": "cast(doc_id as string)",
    "title": "nullif(concat(lang, ' role ', source), 'en role src1')",
    "company": "lang",
    "location": "source",
    "salary_mid": "cast(n_chars as double)",
    "url": "concat('https://jobs.example/', cast(doc_id as string))",
    "description": "text",
}
JOBS_SQL = _select(JOBS, "documents")
JOB_VECTORS_SQL = "select cast(vec_id as string) as job_id, embedding from embeddings"


def jobs(t: Tables) -> DataFrame:
    return t.documents.selectExpr(*[f"{e} as {n}" for n, e in JOBS.items()])


def job_vectors(t: Tables) -> DataFrame:
    return t.embeddings.selectExpr("cast(vec_id as string) as job_id", "embedding")


# Profiles: one per customer; the vector is the embedding with the customer's number.
PROFILES = {
    "profile_id": "c_custkey",
    "target_role": "nullif(c_mktsegment, 'HOUSEHOLD')",
    "skills": "concat(' Brand#', cast(c_custkey % 25 + 1 as string), ', brand#', "
              "cast(c_custkey * 3 % 25 + 1 as string), ', ,')",
}
PROFILES_SQL = _select(PROFILES, "customer")
PROFILE_VECTORS_SQL = ("select c_custkey as profile_id, embedding from customer "
                       "join embeddings on vec_id = c_custkey")


def profiles(t: Tables) -> DataFrame:
    return t.customer.selectExpr(*[f"{e} as {n}" for n, e in PROFILES.items()])


def profile_vectors(t: Tables) -> DataFrame:
    return t.customer.join(t.embeddings, F.col("vec_id") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("profile_id"), "embedding")


# White space as one class, for an engine whose \s is ASCII only.
SQL_WS = (r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
          r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
SQL_NON_WS = "[^" + SQL_WS[1:]


def sql_strip(e: str) -> str:
    return f"regexp_replace({e}, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')"


def sql_collapse(e: str) -> str:
    return f"regexp_replace({e}, '{SQL_WS}+', ' ', 'g')"


def stamp(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def sql_stamp(e: str) -> str:
    return f"strftime({e}, '%Y-%m-%d %H:%M:%S')"

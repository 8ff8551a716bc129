"""Bringing the whole warehouse up to date: postings and questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from jobloom.operators.counts import counted
from jobloom.operators.dedupe import newest_per_job
from jobloom.plans.enrichment import (
    enrich_jobs, pairs_of, question_skills, question_vectors,
)
from jobloom.plans.questions import clean_questions
from jobloom.plans.silver import clean_jobs
from jobloom.session import checkpoint, scratch_path
from jobloom.sources.jobs import land_jobs, read_bronze, read_pages, write_bronze
from jobloom.sources.ledger import Ledger
from jobloom.sources.questions import QUESTION_NAMES, read_question_folder, row_order
from jobloom.sources.storage import names
from jobloom.sources.tables import Warehouse, read_silver, update_silver, write_silver


def refresh_jobs(spark: SparkSession, bronze: str, silver: str, warehouse: Warehouse,
                 make_encoder=None, relative_error: float = 0.05) -> dict[str, int]:
    """Bronze files to silver tables to warehouse; returns the row counts on the way.

    Each silver table is written once and read back, so neither the cleaning nor the
    encoder runs twice.
    """
    raw, found = counted(read_bronze(spark, bronze), "bronze")
    cleaned, kept = counted(clean_jobs(raw, relative_error), "silver")
    write_silver(cleaned, f"{silver}/jobs")
    jobs = read_silver(spark, f"{silver}/jobs")
    enrich_jobs(jobs, make_encoder, warehouse.dim).write.mode("overwrite").parquet(
        f"{silver}/job_enriched")
    enriched = read_silver(spark, f"{silver}/job_enriched")
    skills, pairs = counted(pairs_of(enriched, unique_key=True), "pairs")
    skills.write.mode("overwrite").parquet(f"{silver}/job_skills_ner")

    warehouse.ensure_tables()
    warehouse.upsert_jobs(jobs)
    warehouse.add_skills("job_skills_ner", read_silver(spark, f"{silver}/job_skills_ner"))
    warehouse.upsert_embeddings("job_embeddings", enriched.select("job_id", "embedding"))
    return {"found": found.get["rows"], "cleaned": kept.get["rows"], "pairs": pairs.get["rows"]}


def refresh_new_jobs(spark: SparkSession, bronze: str, silver: str, warehouse: Warehouse,
                     ledger: Ledger, make_encoder=None,
                     relative_error: float = 0.05) -> dict[str, int]:
    """As ``refresh_jobs``, for the bronze files that no earlier load has taken.

    Only those are opened, cleaned and encoded. Their postings replace older rows of their ids in
    silver, where only the dates they touch are written anew, and in the warehouse, where only
    their buckets are. Equal postings under other ids are found among the new ones alone, and
    outliers are judged by the salaries of all. Skills and vectors are kept by the warehouse.
    The files are noted last: a load that fails is repeated as a whole, which changes nothing
    that it had done.
    """
    files = checkpoint(ledger.unread(bronze))
    paths = [r.path for r in files.select("path").collect()]
    if not paths:
        return {"files": 0, "found": 0, "cleaned": 0, "pairs": 0}
    raw, found = counted(read_bronze(spark, bronze, paths), "bronze")
    known = read_silver(spark, f"{silver}/jobs") if names(spark, f"{silver}/jobs") else None
    cleaned, kept = counted(clean_jobs(raw, relative_error, known), "silver")
    rows, texts = scratch_path(spark, "new-jobs"), scratch_path(spark, "new-enriched")
    cleaned.write.parquet(rows)
    new = spark.read.parquet(rows)
    stored = update_silver(new, f"{silver}/jobs", "job_id", newest_per_job)
    jobs = checkpoint(stored.join(new.select("job_id"), "job_id", "left_semi"))
    enrich_jobs(jobs, make_encoder, warehouse.dim).write.parquet(texts)
    enriched = spark.read.parquet(texts)
    skills, pairs = counted(pairs_of(enriched, unique_key=True), "pairs")
    listed = scratch_path(spark, "new-pairs")
    skills.write.parquet(listed)

    warehouse.ensure_tables()
    warehouse.upsert_jobs(jobs)
    warehouse.add_skills("job_skills_ner", spark.read.parquet(listed))
    warehouse.upsert_embeddings("job_embeddings", enriched.select("job_id", "embedding"))
    ledger.record(files)
    return {"files": len(paths), "found": found.get["rows"], "cleaned": kept.get["rows"],
            "pairs": pairs.get["rows"]}


def land_and_refresh(spark: SparkSession, pages: str, bronze: str, date: str, silver: str,
                     warehouse: Warehouse, make_encoder=None,
                     relative_error: float = 0.05) -> dict[str, int]:
    """From the landed API pages: flatten and land them as one day of bronze, then refresh."""
    write_bronze(land_jobs(read_pages(spark, pages)), bronze, date)
    return refresh_jobs(spark, bronze, silver, warehouse, make_encoder, relative_error)


def refresh_questions(spark: SparkSession, folder: str, warehouse: Warehouse,
                      make_encoder=None, silver: str | None = None, skip_name: str = "behavioral",
                      candidates: Sequence[str] = QUESTION_NAMES,
                      topic: str = "technical") -> dict[str, int]:
    """Question files of every kind to freshly numbered questions, their vectors and skills.

    With ``silver``, the three tables are also written there as parquet.
    """
    warehouse.ensure_tables()
    raw = read_question_folder(spark, folder, skip_name, candidates, topic)
    questions = warehouse.reload_questions(clean_questions(raw, row_order()), row_order())
    vectors = question_vectors(questions, make_encoder, warehouse.dim)
    skills = question_skills(questions, unique_key=True)
    if silver:
        for name, table in (("interview_questions", questions), ("interview_skills_ner", skills),
                            ("interview_embeddings", vectors)):
            table.write.mode("overwrite").parquet(f"{silver}/{name}")
        vectors = read_silver(spark, f"{silver}/interview_embeddings")
        skills = read_silver(spark, f"{silver}/interview_skills_ner")
    warehouse.upsert_embeddings("interview_embeddings", vectors)
    warehouse.replace_skills("interview_skills_ner", skills)
    # Numbering reads its input twice, so the count comes from the written table's footers.
    return {"loaded": questions.count()}

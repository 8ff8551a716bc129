"""Skill demand."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def jobs_with_skills(jobs: DataFrame, job_skills: DataFrame) -> DataFrame:
    return jobs.join(job_skills, "job_id")


def role_skill_demand(jobs: DataFrame, job_skills: DataFrame) -> DataFrame:
    """How often each skill is asked for under each (lower-cased) title."""
    return (
        jobs_with_skills(jobs.select("job_id", F.lower("title").alias("role_title")), job_skills)
        .groupBy("role_title", "skill").agg(F.count("*").alias("demand_count"))
    )


def skills_of_jobs(job_skills: DataFrame, job_ids: DataFrame) -> DataFrame:
    """All skill rows of the given jobs; an id that is given twice counts once."""
    return job_skills.join(job_ids.select("job_id"), "job_id", "left_semi")


def top_skills(job_skills: DataFrame, job_ids: DataFrame | None = None, n: int = 30) -> DataFrame:
    """The n skills most asked for by the given jobs (all jobs when none are given)."""
    chosen = job_skills
    if job_ids is not None:
        chosen = skills_of_jobs(job_skills, job_ids)
    return (
        chosen.groupBy("skill").agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "skill").limit(n)
    )


def ranked_skills(shortlist: DataFrame, job_skills: DataFrame, n: int = 30) -> DataFrame:
    """(profile_id, skill, count, rank): per profile its n most demanded skills, ties by name.

    ``shortlist`` holds (profile_id, job_id) pairs, k per profile.
    """
    counted = (
        shortlist.select("profile_id", "job_id").join(job_skills, "job_id")
        .groupBy("profile_id", "skill").agg(F.count("*").alias("count"))
    )
    rank = F.row_number().over(
        Window.partitionBy("profile_id").orderBy(F.desc("count"), F.col("skill").asc()))
    return counted.withColumn("rank", rank).filter(F.col("rank") <= n)


def top_skills_per_profile(shortlist: DataFrame, job_skills: DataFrame, n: int = 30) -> DataFrame:
    """The ranked skills of each profile as one ordered array; a list has at most one entry per
    skill."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "skill", "count")))
    return ranked_skills(shortlist, job_skills, n).groupBy("profile_id").agg(
        F.transform(ordered, lambda s: s["skill"]).alias("target_skills"),
        F.transform(ordered, lambda s: s["count"]).alias("skill_counts"),
    )

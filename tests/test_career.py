import json

import pytest
from pyspark.sql import functions as F

from jobloom.functions.vectors import cosine_similarity
from jobloom.operators.demand import role_skill_demand, top_skills
from jobloom.operators.encode import embed_text_column
from jobloom.plans import career, enrichment
from jobloom.plans.report import (
    ALL_SECTIONS, ANY_SECTION, evaluation_report, similarity_scores, write_report,
)
from jobloom.plans.roadmap import RoadmapWording, prompt_text, roadmap_text
from jobloom.session import scratch_path

CASE = ("Machine Learning Engineer", ["python", "pandas", "sql"],
        ["pytorch", "tensorflow", "docker", "kubernetes", "aws"],
        ["Data Scientist", "ML Ops Engineer"],
        ["Explain backpropagation", "What is gradient descent?"])
SCHEMA = ("role string, user array<string>, target array<string>, roles array<string>, "
          "questions array<string>")


def text_of(spark, row, fn):
    return spark.createDataFrame([row], SCHEMA).select(
        fn("role", "user", "target", "roles", "questions")).first()[0]


def test_roadmap_sections(spark):
    text = text_of(spark, CASE, roadmap_text)
    assert [line[:5] for line in text.split("\n") if line.startswith("## ")] == [
        f"## {i}." for i in range(1, 7)]
    assert "- kubernetes" in text and "2. What is gradient descent?" in text
    low = text.lower()
    assert any(p in low for p in ANY_SECTION) and not all(p in low for p in ALL_SECTIONS)


def test_roadmap_cuts_its_lists(spark):
    many = [f"x{i}" for i in range(30)]
    text = text_of(spark, ("r", [], many, [f"role{i}" for i in range(9)],
                           [f"q{i}" for i in range(15)]), roadmap_text)
    assert text.count("- role") == 6 and "10. q9" in text and "11. " not in text
    assert "- x19\n" in text and "x20" not in text
    assert text.count("- x0\n") == 2 and text.count("- x7\n") == 2 and text.count("- x8\n") == 1


def test_roadmap_fallbacks(spark):
    w = RoadmapWording()
    for empty in ([], None):
        text = text_of(spark, ("", empty, empty, empty, empty), roadmap_text)
        for part in (w.none_listed, w.no_roles, w.no_skills, w.no_gaps, w.no_questions):
            assert part.strip() in text
        assert text.startswith("# Career roadmap for your target role\n")


def test_prompt(spark):
    text = text_of(spark, ("ML", ["b", "a", "b"], CASE[2], [f"r{i}" for i in range(9)],
                           [f"q{i}" for i in range(9)]), prompt_text)
    assert "Skills the person has: a, b\n" in text
    assert "r0, r1, r2, r3, r4\n" in text and "- q7" in text and "q8" not in text
    empty = text_of(spark, ("ML", [], [], [], []), prompt_text)
    assert "not specified" in empty and empty.count("N/A") == 3


JOBS = [("1", "Data Engineer", "Spark, SQL and Kafka"), ("2", "data engineer", "SQL, Airflow"),
        ("3", "Web Developer", "React, HTML and CSS"), ("4", None, "SQL")]


def tables(spark):
    jobs = spark.createDataFrame(JOBS, "job_id string, title string, description string")
    questions = spark.createDataFrame([(1, "What is SQL?"), (2, "What is React?")],
                                      "q_id long, question string")
    enriched = enrichment.enrich_jobs(jobs, dim=64)
    skills, vectors = enrichment.pairs_of(enriched), enriched.select("job_id", "embedding")
    assert sorted(map(tuple, skills.collect())) == sorted(
        map(tuple, enrichment.job_skills(jobs).collect()))
    return jobs, vectors, skills, questions, enrichment.question_vectors(questions, dim=64)


def test_whole_analysis(spark):
    profiles = spark.createDataFrame([(1, "Data Engineer", "sql, git"), (2, "Web Developer", "")],
                                     "profile_id long, target_role string, skills string")
    jobs, vectors, skills, questions, question_vectors = tables(spark)
    got = {r["profile_id"]: r for r in career.analyze_careers(
        profiles, jobs, vectors, skills, questions, question_vectors, dim=64,
        k_jobs=2, k_questions=1).collect()}
    assert set(got) == {1, 2}
    assert len(got[1]["similar_roles"]) <= 2 and None not in got[1]["similar_roles"]
    assert "sql" not in got[1]["skill_gap"] and got[1]["user_skills"] == ["sql", "git"]
    assert got[2]["user_skills"] == [] and len(got[2]["questions"]) == 1
    assert "## 6." in got[2]["roadmap"]


def test_profile_without_any_hit_keeps_its_row(spark):
    profiles = spark.createDataFrame([(1, None, "sql")],
                                     "profile_id long, target_role string, skills string")
    jobs, vectors, skills, questions, question_vectors = tables(spark)
    none = spark.createDataFrame([], "profile_id long, embedding array<float>")
    row = career.analyze_careers(profiles, jobs, vectors, skills, questions, question_vectors,
                                 queries=(none, none)).first()
    assert row["similar_roles"] == [] and row["questions"] == []
    assert RoadmapWording().no_questions in row["roadmap"]


def test_demand(spark):
    jobs, _, skills, _, _ = tables(spark)
    top = top_skills(skills, jobs.filter("title is not null"), 1).collect()
    assert [(r["skill"], r["count"]) for r in top] == [("sql", 2)]
    roles = {(r["role_title"], r["skill"]): r["demand_count"]
             for r in role_skill_demand(jobs, skills).collect()}
    assert roles[("data engineer", "sql")] == 2


def test_report(spark):
    lists = spark.createDataFrame([(["a", "b"], ["a", "c"])],
                                  "truth array<string>, predicted array<string>")
    docs = spark.createDataFrame([(1, "python sql"), (2, "react")], "id long, t string")
    query = embed_text_column(spark.createDataFrame([("python",)], "t string"), "t").select(
        "embedding").scalar()
    scored = embed_text_column(docs, "t").withColumn("q", query).select(
        "id", F.size("embedding").alias("dim"),
        cosine_similarity("embedding", "q").alias("score"))
    report = evaluation_report(lists, scored, docs, "t")
    path = scratch_path(spark, "report")
    write_report(report, path, similarity_scores(scored, "id"))
    got = json.loads(spark.read.text(path).first()[0])
    assert got["skill_extraction"]["total_tp"] == 1
    assert got["embeddings"]["embedding_dimension"] == 256
    assert got["embeddings"]["n_scores"] == 2
    scores = spark.read.json(f"{path}_scores").orderBy("id").collect()
    assert [(s["id"], s["score"]) for s in scores] == [(1, pytest.approx(2 ** -0.5)), (2, 0.0)]
    assert got["roadmap"]["output_word_count"] == 3


def test_profiles_that_ask_alike_are_encoded_once(spark):
    """Query texts reach the model once for each role and skill list, not once a profile."""
    seen = spark.sparkContext.accumulator(0)

    def model():
        def encode(texts):
            seen.add(len(texts))
            return [[float(len(t)), 1.0] for t in texts]
        return encode

    rows = [(i, [None, "Engineer"][i % 2], ["sql", "java, sql", None][i % 3]) for i in range(60)]
    known = [r for r in rows if r[2]]
    profiles = spark.createDataFrame(known, "profile_id long, target_role string, skills string")
    jobs = spark.createDataFrame([("a", "A"), ("b", "B")], "job_id string, title string")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])],
                                    "job_id string, embedding array<float>")
    skills = spark.createDataFrame([("a", "sql")], "job_id string, skill string")
    asked = spark.createDataFrame([(1, "why")], "q_id long, question string")
    q_vectors = spark.createDataFrame([(1, [1.0, 0.0])], "q_id long, embedding array<float>")
    out = career.analyze_careers(profiles, jobs, vectors, skills, asked, q_vectors,
                                 make_encoder=model).collect()
    assert sorted(r.profile_id for r in out) == [r[0] for r in known]
    assert all(set(r.similar_roles) == {"A", "B"} and r.target_skills == ["sql"] for r in out)
    assert {r.profile_id: r.target_role for r in out} == {r[0]: r[1] for r in known}
    assert seen.value < len(known)

import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import jobloom.functions.skills as matcher
from jobloom.functions.skills import extract_skills
from jobloom.functions.vocabulary import (
    SKILL_STOPWORDS, default_vocabulary, extend_vocabulary, phrase_rows,
)
from jobloom.operators.evaluation import evaluate_lists
from jobloom.operators import phrases
from jobloom.operators.phrases import match_phrases, word_sequences
from jobloom.plans.enrichment import question_skills

VOCABULARY = default_vocabulary()


def brute(text, vocabulary=VOCABULARY, stopwords=SKILL_STOPWORDS):
    if not text:
        return []
    return sorted(s for s, phrases in vocabulary.items() if s not in stopwords and any(
        re.search(r"\b" + re.escape(p) + r"\b", text, re.IGNORECASE) for p in phrases))


def extract(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", extract_skills("t", **options).alias("s")).orderBy("i").collect()
    return [r["s"] for r in rows]


def test_vocabulary_size():
    assert len(VOCABULARY) == 245
    assert sum(len(p) for p in VOCABULARY.values()) == 273
    assert max(len(p.split()) for ps in VOCABULARY.values() for p in ps) == 3


def test_known_canonicals_keep_their_aliases():
    assert extend_vocabulary({"sql": ["sql", "s q l"]}, ["SQL", "Kdb"]) == {
        "sql": ["sql", "s q l"], "kdb": ["kdb"]}


TEXTS = [
    None, "", "nothing here", "uses C++ and C#", "C++x c#9", "golang and go", "spring boot",
    "Spring Boot, postgres; NODEJS", "machine  learning", "machine learning", "éjava java_",
    "sql server", "google cloud platform", "React.js/vue.js", "k8s-docker", "scikit-learn",
    "Poſtgres Kafka GİT lınux", "tcp/ip", "ci cd", " r ", "python3 python",
    "javá x", "²sql sql²", "html\nCSS", "node js node.js",
]


def test_same_as_trying_every_phrase(spark):
    assert extract(spark, TEXTS) == [brute(t) for t in TEXTS]


PIECES = sorted({p for ps in VOCABULARY.values() for p in ps})


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.sampled_from(PIECES), st.sampled_from(
    [" ", "", ", ", "_", "é", "9", "\n", "+", "#", "."])), max_size=6), min_size=40, max_size=80))
def test_any_mixture_of_phrases(spark, rows):
    texts = ["".join(p.title() + s if len(s) else p + s for p, s in row) for row in rows]
    assert extract(spark, texts) == [brute(t) for t in texts]


def test_symbol_edges(spark):
    texts = ["uses C++ and C#", "c++17", "(c#)"]
    assert extract(spark, texts) == [[], ["c++"], []]
    assert extract(spark, texts, symbol_safe=True) == [["c#", "c++"], [], ["c#"]]


def test_large_vocabularies_are_cut_into_several_patterns(spark, monkeypatch):
    monkeypatch.setattr(matcher, "PHRASES_PER_PATTERN", 20)
    assert extract(spark, TEXTS) == [brute(t) for t in TEXTS]


def test_table_of_phrases_gives_the_same_pairs(spark):
    texts = [t for t in TEXTS if t] + ["c++x sql", "object oriented programming", "elastic search"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    table = spark.createDataFrame(phrase_rows(VOCABULARY), "phrase string, skill string")
    got = {(r["i"], r["skill"]) for r in match_phrases(df, "i", "t", table).collect()}
    assert got == {(i, s) for i, t in enumerate(texts) for s in brute(t)}


def test_table_of_phrases_with_symbols_at_their_edges(spark):
    vocabulary = {"net": [".net"], "c": ["c++", "c#"], "plus": ["++"], "at": ["@a b/", "x"]}
    texts = ["a.net asp.net .net", "c++x c++ c+++x", "a++b", "z@a b/c", "c# c#x", "@a b/c",
             "x++", "C++ÉX"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    table = spark.createDataFrame(phrase_rows(vocabulary), "phrase string, skill string")
    want = {(i, s) for i, t in enumerate(texts) for s in brute(t, vocabulary)}
    assert {tuple(r) for r in match_phrases(df, "i", "t", table).collect()} == want
    assert extract(spark, texts, vocabulary=vocabulary) == [brute(t, vocabulary) for t in texts]
    texts += ["c++ and .net", "c++.", "++", "a ++ b", ".net.net", "(@a b/)", "@a  b/ @a b//", "+++"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    want = extract(spark, texts, vocabulary=vocabulary, symbol_safe=True)
    got = match_phrases(df, "i", "t", table, symbol_safe=True).collect()
    assert {tuple(r) for r in got} == {(i, s) for i, found in enumerate(want) for s in found}
    assert want[8] == ["c", "net"] and want[10] == ["plus"] and want[13] == ["at"]


def test_only_sequences_that_may_begin_a_phrase_leave_a_text(spark):
    """Whatever the case, also of the letters that fold to i, s and k."""
    df = spark.createDataFrame([("the machine learning of the machINE shop, ſql K8S c++ cs",)], "t string")
    shapes = [(1, 0, 0), (1, 0, 2), (2, 0, 0)]
    heads = {(1, 0, 0): ["sql", "k8s"], (1, 0, 2): ["c"], (2, 0, 0): ["machine"]}
    got = df.select(word_sequences(F.col("t"), shapes, True, heads)).first()[0]
    assert got == ["sql", "k8s", "c++", "machine learning", "machine shop"]


@pytest.mark.parametrize("symbol_safe", [False, True])
def test_many_first_words_give_the_same_pairs(spark, monkeypatch, symbol_safe):
    texts = [t for t in TEXTS if t] + [
        "asp.net .net", "c++. C++", "Σ'σ ΟΔΟΣ οδος", "K8s İ ı", "sql sql server sql-server"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = phrase_rows(VOCABULARY) + [("ΟΔΟΣ", "way"), (".net", "net"), ("i", "i"), ("server sql", "x")]
    table = spark.createDataFrame(rows, "phrase string, skill string")
    few = {tuple(r) for r in match_phrases(df, "i", "t", table, symbol_safe).collect()}
    monkeypatch.setattr(phrases, "PHRASES_PER_PATTERN", 3)
    assert {tuple(r) for r in match_phrases(df, "i", "t", table, symbol_safe).collect()} == few
    assert {s for _, s in few} >= {"way", "i", "x"}


# Labelled texts with the scores that are known for them.
SHORT = [
    ("Senior Software Engineer working with Python, React, AWS, Docker, Kubernetes, "
     "PostgreSQL, Redis.",
     ["python", "react", "aws", "docker", "kubernetes", "postgresql", "redis"]),
    ("Machine Learning Engineer using PyTorch, TensorFlow, MLOps, Airflow, Python, SQL.",
     ["pytorch", "tensorflow", "python", "sql", "airflow"]),
    ("Data Engineer with Spark, Kafka, Airflow, Python, SQL, Snowflake, dbt.",
     ["spark", "kafka", "airflow", "python", "sql", "snowflake", "dbt"]),
]


LONG = [
    ("Senior Software Engineer - We seek an experienced engineer with Python, \n"
     "React, and AWS expertise. Must have strong knowledge of Docker, Kubernetes, \n"
     "and CI/CD pipelines. Experience with PostgreSQL and Redis required.",
     ["python", "react", "aws", "docker", "kubernetes", "postgresql", "redis"]),
    ("Machine Learning Engineer - Build ML models using PyTorch and TensorFlow. \n"
     "Need experience with MLOps, Airflow, and cloud platforms (AWS/GCP). \n"
     "Strong Python and SQL skills essential.",
     ["pytorch", "tensorflow", "python", "sql", "airflow", "mlops"]),
    ("Data Engineer - Design data pipelines with Spark, Kafka, and Airflow. \n"
     "Proficiency in Python, SQL, and Snowflake. Experience with dbt and \n"
     "data modeling required.",
     ["spark", "kafka", "airflow", "python", "sql", "snowflake", "dbt"]),
]


def scored(spark, labelled, **options):
    df = spark.createDataFrame(labelled, "t string, truth array<string>").withColumn(
        "predicted", extract_skills("t"))
    return evaluate_lists(df, "truth", "predicted", **options).first()


def test_known_scores(spark):
    row = scored(spark, SHORT)
    assert (row["total_tp"], row["total_fp"], row["total_fn"]) == (19, 2, 0)
    assert row["precision"] == pytest.approx(0.9047619047619048)
    assert row["recall"] == 1.0
    assert row["f1_score"] == pytest.approx(0.95)


def test_known_scores_of_longer_texts(spark):
    row = scored(spark, LONG, ignore_case=True)
    assert (row["total_tp"], row["total_fp"], row["total_fn"]) == (20, 4, 0)
    assert row["precision"] == pytest.approx(20 / 24)


def test_scores_without_any_match(spark):
    df = spark.createDataFrame([([], [])], "truth array<string>, predicted array<string>")
    row = evaluate_lists(df, "truth", "predicted").first()
    assert (row["precision"], row["recall"], row["f1_score"]) == (0.0, 0.0, 0.0)


def test_case_blind_scores(spark):
    df = spark.createDataFrame([(["SQL"], ["sql"])], "truth array<string>, predicted array<string>")
    assert evaluate_lists(df, "truth", "predicted").first()["total_tp"] == 0
    assert evaluate_lists(df, "truth", "predicted", ignore_case=True).first()["total_tp"] == 1


def test_question_pairs_are_unique(spark):
    df = spark.createDataFrame([(1, "sql or SQL"), (1, "sql"), (2, "kafka")],
                               "q_id long, question string")
    got = sorted(tuple(r) for r in question_skills(df).collect())
    assert got == [(1, "sql"), (2, "kafka")]


def test_extraction_is_one_narrow_pass(spark):
    df = spark.range(10).select(F.lit("sql").alias("t")).select(extract_skills("t"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Generate" not in plan

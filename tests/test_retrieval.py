import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from jobloom.functions import vectors as V
from jobloom.operators import encode
from jobloom.operators import retrieval
from jobloom.operators.retrieval import (
    _Block, interview_questions, nearest_for_all, similar_jobs,
)


def frame(spark, key, matrix, kind="long"):
    keys = [i if kind == "long" else f"j{i}" for i in range(len(matrix))]
    return spark.createDataFrame([(k, [float(x) for x in v]) for k, v in zip(keys, matrix)],
                                 f"{key} {kind}, embedding array<float>")


def brute(queries, corpus, k, name=lambda i: i):
    out = {}
    for i, q in enumerate(queries):
        d = np.sqrt(((corpus - q) ** 2).sum(axis=1))
        order = sorted(range(len(corpus)), key=lambda j: (d[j], name(j)))[:k]
        out[i] = [name(j) for j in order]
    return out


def found(df, key):
    out = {}
    for r in df.orderBy("profile_id", "rank").collect():
        out.setdefault(r["profile_id"], []).append(r[key])
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_nearest_for_all_equals_brute_force(spark, block_bytes, kind):
    rng = np.random.default_rng(0)
    # A third of the corpus is one vector.
    corpus = rng.normal(size=(300, 8)).astype(np.float32)
    corpus[::3] = corpus[0]
    queries = np.concatenate([rng.normal(size=(20, 8)).astype(np.float32), corpus[:3]])
    name = (lambda i: i) if kind == "long" else (lambda i: f"j{i}")
    got = nearest_for_all(frame(spark, "profile_id", queries),
                          frame(spark, "job_id", corpus, kind).repartition(5),
                          "profile_id", "job_id", 7, block_bytes=block_bytes)
    assert found(got, "job_id") == brute(
        queries.astype(float), corpus.astype(float), 7, name)


@pytest.mark.parametrize("scale", [1e-25, 1.0, 1e18])
def test_near_ties_are_settled_in_double_precision(scale):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(1, 96))
    rows = (base + rng.normal(size=(2000, 96)) * 1e-7) * scale
    queries = (base + rng.normal(size=(300, 96)) * 1e-7) * scale
    best = _Block(queries, 5)
    for at in range(0, 2000, 500):
        part = rows[at:at + 500]
        best.add(np.arange(at, at + 500), part, (part ** 2).sum(axis=1))
    got = {}
    for i, j in zip(best.q.tolist(), best.key.tolist()):
        got.setdefault(i, []).append(j)
    assert got == brute(queries, rows, 5)


def test_fewer_rows_than_asked_for(spark):
    q, c = frame(spark, "profile_id", [[0, 0]]), frame(spark, "job_id", [[0, 1], [1, 0], [3, 0]])
    assert found(nearest_for_all(q, c, "profile_id", "job_id", 10), "job_id") == {0: [0, 1, 2]}
    assert nearest_for_all(q, c.limit(0), "profile_id", "job_id", 10).count() == 0
    assert nearest_for_all(q.limit(0), c, "profile_id", "job_id", 10).count() == 0


def test_corpus_is_not_shuffled(spark, tmp_path):
    frame(spark, "job_id", np.random.default_rng(2).normal(size=(200, 4))).write.parquet(
        str(tmp_path / "c"))
    got = nearest_for_all(frame(spark, "profile_id", np.eye(4)), spark.read.parquet(
        str(tmp_path / "c")), "profile_id", "job_id", 3, block_bytes=40)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and not any(
        x in plan for x in ("Join", "Repartition", "Generate"))
    assert got.count() == 12


def test_no_query_passes_through_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def refuse(*_, **__):
        raise AssertionError("rows on the driver")

    rng = np.random.default_rng(4)
    matrix = rng.normal(size=(900, 6)).astype(np.float32)
    q, c = frame(spark, "profile_id", matrix), frame(spark, "job_id", matrix).repartition(7)
    for name in ("collect", "toArrow", "toPandas", "toLocalIterator"):
        monkeypatch.setattr(DataFrame, name, refuse)
    got = nearest_for_all(q, c, "profile_id", "job_id", 2, block_bytes=4096)
    monkeypatch.undo()
    assert found(got, "job_id") == brute(matrix.astype(float), matrix.astype(float), 2)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.integers(-2, 2), min_size=3, max_size=3), min_size=1, max_size=40))
def test_many_equal_distances(spark, matrix):
    c = np.array(matrix, dtype=float)
    got = nearest_for_all(frame(spark, "profile_id", matrix), frame(spark, "job_id", matrix),
                          "profile_id", "job_id", 3)
    assert found(got, "job_id") == brute(c, c, 3)


def test_single_query_with_title_filter(spark):
    vectors = frame(spark, "job_id", [[0, 0], [1, 0], [2, 0], [3, 0]], "string")
    jobs = spark.createDataFrame([(f"j{i}", None if i == 1 else "t", "c", "l", 1.0, "u")
                                  for i in range(4)],
                                 "job_id string, title string, company string, location string, "
                                 "salary_mid double, url string")
    got = similar_jobs(vectors, jobs, V.vector_literal([1.0, 0.0]), 2).collect()
    assert [(r["job_id"], r["distance"]) for r in got] == [("j0", 1.0), ("j2", 1.0)]


def test_question_similarity(spark):
    vectors = frame(spark, "q_id", [[0, 0], [3, 4]])
    q = spark.createDataFrame([(0, "a", "t", "s"), (1, "b", "t", "s")],
                              "q_id long, question string, topic string, source string")
    got = interview_questions(vectors, q, V.vector_literal([0.0, 0.0])).collect()
    assert [(r["question"], r["similarity"]) for r in got] == [("a", 1.0), ("b", 1 / 6)]


def test_vector_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0]), (None, [1.0, 0.0])],
                               "a array<float>, b array<float>")
    got = df.select(V.euclidean_distance("a", "b"), V.cosine_similarity("a", "b")).collect()
    assert [tuple(r) for r in got] == [(5.0, 0.0), (None, None)]
    odd = spark.createDataFrame([([1.0], [1.0, 2.0])], "a array<float>, b array<float>")
    with pytest.raises(Exception, match="differ in length"):
        odd.select(V.euclidean_distance("a", "b")).collect()
    text = spark.createDataFrame([("{1,2.5}",), ("[1,2.5]",)], "s string")
    assert [r[0] for r in text.select(V.parse_vector("s")).collect()] == [[1.0, 2.5]] * 2


def test_hashed_vectors(spark):
    df = spark.createDataFrame([(1, "Sql sql python"), (2, "sql  SQL Python"), (3, ""), (4, None)],
                               "id int, t string")
    rows = {r["id"]: r["embedding"] for r in
            encode.embed_text_column(df, "t", dim=64).collect()}
    assert rows[1] == rows[2] and len(rows[1]) == 64
    assert np.linalg.norm(rows[1]) == pytest.approx(1.0, abs=1e-6)
    assert set(rows[3]) == set(rows[4]) == {0.0}
    assert encode.embed_text_column(df.limit(0), "t").count() == 0


def test_own_encoder_gets_small_batches(spark):
    def make():
        def run(texts):
            assert len(texts) <= 4
            return np.array([[len(t), 1.0] for t in texts])

        return run

    df = spark.range(10).select("id", F.when(F.col("id") < 9, F.repeat(F.lit("x"), F.col("id").cast("int"))).alias("t"))
    rows = {r["id"]: r["embedding"] for r in encode.encode_texts(df, "t", make, 4).collect()}
    assert rows[9] is None
    assert rows[3] == pytest.approx([3 / 10 ** 0.5, 1 / 10 ** 0.5], abs=1e-6)


def test_empty_query_is_an_error(spark):
    with pytest.raises(Exception, match="query text is empty"):
        encode.embed_queries(spark.createDataFrame([("",)], "t string"), "t").collect()


def test_model_is_loaded_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def make():
        import os
        import uuid

        open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return lambda texts: np.ones((len(texts), 3))

    df = spark.createDataFrame([(str(i) if i % 5 else None,) for i in range(400)], "t string")
    for _ in range(2):
        got = encode.encode_texts(df.repartition(32), "t", make).collect()
        assert sum(r["embedding"] is None for r in got) == 80
        assert all(len(r["embedding"]) == 3 for r in got if r["embedding"] is not None)
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert len(loads) == len(set(loads))


@pytest.mark.parametrize("kind", ["long", "string"])
def test_many_queries_are_dealt_out(spark, monkeypatch, kind):
    """Each query meets the whole corpus in one task: no shuffle of found rows, no window."""
    monkeypatch.setattr(retrieval, "_BLOCK", 8)
    rng = np.random.default_rng(5)
    corpus = rng.normal(size=(3000, 6)).astype(np.float32)
    corpus[::3] = corpus[0]
    name = (lambda i: i) if kind == "long" else (lambda i: f"j{i}")
    got = nearest_for_all(frame(spark, "profile_id", corpus[:200]),
                          frame(spark, "job_id", corpus, kind).repartition(5),
                          "profile_id", "job_id", 7, block_bytes=4096)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("MapInArrow") == 1
    assert found(got, "job_id") == brute(corpus[:200].astype(float), corpus.astype(float), 7, name)

import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from jobloom.operators import dedupe, merge, quantiles
from jobloom.operators.counts import counted
from jobloom.schemas import BRONZE_JOBS, TABLES
from jobloom.plans.silver import clean_jobs, select_raw
from jobloom.session import scratch_path
from jobloom.sources import versions
from jobloom.sources.tables import Warehouse, read_silver, write_silver


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def bronze(spark, items):
    names = BRONZE_JOBS.fieldNames()
    return spark.createDataFrame([tuple(i.get(n) for n in names) for i in items], BRONZE_JOBS)


def test_newest_wins_and_ties_are_settled(spark):
    items = [
        dict(id="1", title=" Dev ", company="a", created="2024-01-01 00:00:00"),
        dict(id="2", title="dev", company="a", created="2024-02-01 00:00:00"),
        dict(id="3", title="DEV", company="a", created="bad"),
        dict(id="5", title="ops", company="b", created="2024-02-01 00:00:00"),
        dict(id="4", title="ops", company="b", created="2024-02-01 00:00:00"),
    ]
    kept = clean_jobs(bronze(spark, items))
    assert rows(kept.select("job_id", "title")) == [("2", "dev"), ("4", "ops")]


def test_all_null_salaries_pass_through(spark):
    items = [dict(id=str(i), title=f"t{i}") for i in range(4)]
    assert clean_jobs(bronze(spark, items)).filter("salary_mid is null").count() == 4
    assert quantiles.quantiles(bronze(spark, items), "salary_min", [0.25], 0).first()["q"] == []
    assert quantiles.quantiles(bronze(spark, items), "salary_min", [0.25], 0.05).first()["q"] == []


def test_outliers_become_null_and_rows_stay(spark):
    items = [dict(id=str(i), title=f"t{i}", salary_max=float(100 + i)) for i in range(20)]
    items.append(dict(id="x", title="x", salary_max=1e6))
    got = clean_jobs(bronze(spark, items), relative_error=0)
    assert got.count() == 21
    assert rows(got.filter("salary_mid is null").select("job_id")) == [("x",)]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(0, 5).map(float),
                          st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=60))
def test_exact_quantiles(spark, items):
    df = spark.createDataFrame([(v,) for v in items], "v double")
    probabilities = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = quantiles.quantiles(df, "v", probabilities, relative_error=0).first()["q"]
    assert got == df.approxQuantile("v", probabilities, 0.0)


def test_exact_quantiles_where_one_value_fills_the_table(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("v"))
    probabilities = [0.1, 0.25, 0.34, 0.5, 0.75, 0.9999]
    got = quantiles.quantiles(df, "v", probabilities, relative_error=0).first()["q"]
    assert got == df.approxQuantile("v", probabilities, 0.0)


def test_default_quartiles_are_within_the_error(spark):
    df = spark.range(1, 10_001).select(F.col("id").cast("double").alias("v"))
    q1, q3 = quantiles.quantiles(df, "v", [0.25, 0.75]).first()["q"]
    assert abs(q1 - 2500) <= 500 and abs(q3 - 7500) <= 500


def test_dedupe_is_idempotent(spark):
    df = spark.range(200).select((F.col("id") % 17).cast("string").alias("question"), "id")
    once = dedupe.first_question(df, [F.col("id").asc()])
    assert rows(dedupe.first_question(once, [F.col("id").asc()])) == rows(once)
    assert [r[1] for r in rows(once)] == sorted(range(17), key=lambda i: str((str(i), i)))


def test_one_row_per_key_leaves_each_map_task(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedupe.first_per_key(df, ["k"], [F.col("id").asc()])
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_dense_ids_follow_the_order(spark):
    df = spark.range(1000).select((1000 - F.col("id")).alias("n"), (F.col("id") % 2).alias("src"))
    got = dedupe.dense_ids(df, [F.col("src").asc(), F.col("n").asc()], "q_id").orderBy("q_id")
    found = [tuple(r) for r in got.collect()]
    assert [r[0] for r in found] == list(range(1, 1001))
    want = sorted(((i % 2, 1000 - i) for i in range(1000)))
    assert [(r[2], r[1]) for r in found] == want


def test_first_seen_drops_missing_ids(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 0), ("", 0)], "id string, p int")
    assert rows(dedupe.first_seen(df, "id", [F.col("p").asc()])) == [("a", 1)]


def test_counts_need_no_second_pass(spark):
    df, seen = counted(spark.range(7), "rows_seen")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 7


JOB = ("job_id", "title", "salary_min", "salary_mid")


def test_upsert_replaces_listed_columns_only(spark):
    target = spark.createDataFrame([("1", "old", 1.0, 2.0), ("2", "keep", 1.0, 2.0)], list(JOB))
    stage = spark.createDataFrame([("1", None, 9.0, 8.0), ("3", "new", 5.0, 6.0)],
                                  "job_id string, title string, salary_min double, salary_mid double")
    merged = merge.upsert(target, stage, ["job_id"], ["title", "salary_mid"])
    assert rows(merged) == [("1", None, 1.0, 8.0), ("2", "keep", 1.0, 2.0), ("3", "new", 5.0, 6.0)]
    again = merge.upsert(merged, stage, ["job_id"], ["title", "salary_mid"])
    assert rows(again) == rows(merged)


def test_vector_of_wrong_length_fails(spark):
    target = spark.createDataFrame([("1", [1.0, 0.0])], "job_id string, embedding array<float>")
    stage = spark.createDataFrame([(2, [1.0, 0.0, 0.0])], "job_id long, embedding array<double>")
    with pytest.raises(Exception, match="expected 2 dimensions"):
        merge.upsert_vectors(target, stage, "job_id", 2).collect()


def test_coercion_before_load(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("soon",)], "posted_ts string")
    assert [r["dt"] for r in merge.coerce_jobs(df).collect()] == [dt.date(2024, 1, 2), None]
    plain = merge.coerce_jobs(spark.range(1)).select((F.col("dt") == F.current_date()).alias("o"))
    assert plain.first()["o"]


def test_missing_columns_of_bronze_stay_null(spark):
    got = select_raw(bronze(spark, [dict(id="1", latitude=1.5)])).first()
    assert (got["job_id"], got["lat"], got["url"]) == ("1", 1.5, None)


def test_silver_round_trip_prunes_partitions(spark):
    path = scratch_path(spark, "silver")
    df = spark.createDataFrame([("1", "2024-01-01"), ("2", None)], "job_id string, d string")
    write_silver(df.select("job_id", F.to_date("d").alias("dt")), path)
    back = read_silver(spark, path)
    assert rows(back.filter("dt is null").select("job_id")) == [("2",)]
    chosen = back.filter("dt = date '2024-01-01'")
    assert "PartitionFilters: [isnotnull(dt" in chosen._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def warehouse(spark):
    w = Warehouse(spark, "careers_test", scratch_path(spark, "warehouse"), dim=2, buckets=2)
    w.ensure_tables()
    return w


def jobs_frame(spark, items):
    schema = TABLES["jobs"].schema
    return spark.createDataFrame([tuple(i.get(n) for n in schema.fieldNames()) for i in items],
                                 schema)


def test_warehouse_upserts(spark, warehouse):
    w = warehouse
    w.ensure_tables()
    assert {f.name for f in w.table("jobs").schema} == set(TABLES["jobs"].schema.fieldNames())
    w.upsert_jobs(jobs_frame(spark, [dict(job_id="1", title="a", url="u", salary_mid=1.0)]))
    w.upsert_jobs(jobs_frame(spark, [dict(job_id="1", title="b", url="v", salary_mid=2.0),
                                     dict(job_id="2", title="c")]))
    assert rows(w.table("jobs").select("job_id", "title", "url", "salary_mid")) == [
        ("1", "b", "u", 2.0), ("2", "c", None, None)]
    assert w.duplicate_keys("jobs").count() == 0

    pairs = spark.createDataFrame([("1", "sql"), ("1", "sql"), ("2", "git")],
                                  "job_id string, skill string")
    w.add_skills("job_skills_ner", pairs)
    w.add_skills("job_skills_ner", pairs)
    w.add_skills("job_skills_ner", pairs.limit(0))
    assert rows(w.table("job_skills_ner")) == [("1", "sql"), ("2", "git")]

    vectors = spark.createDataFrame([("1", [1.0, 0.0])], "job_id string, embedding array<double>")
    w.upsert_embeddings("job_embeddings", vectors)
    w.upsert_embeddings("job_embeddings", vectors.select(
        "job_id", F.reverse("embedding").alias("embedding")))
    assert rows(w.table("job_embeddings")) == [("1", [0.0, 1.0])]


def test_repeated_keys_in_a_stage_are_an_error(spark, warehouse):
    twice = jobs_frame(spark, [dict(job_id="1", title="a"), dict(job_id="1", title="b")])
    with pytest.raises(ValueError, match="repeated keys"):
        warehouse.upsert_jobs(twice)


def test_warehouse_reload_restarts_ids(spark, warehouse):
    w = warehouse
    df = spark.createDataFrame([("b?", "t", "f", 2), ("a?", "t", "f", 1)],
                               "question string, topic string, source string, line int")
    for _ in range(2):
        got = w.reload_questions(df, [F.col("source").asc(), F.col("line").asc()])
        assert rows(got.select("q_id", "question")) == [(1, "a?"), (2, "b?")]
        assert got.filter("created_at is null").count() == 0
        w.upsert_embeddings("interview_embeddings", spark.createDataFrame(
            [(1, [1.0, 2.0])], "q_id int, embedding array<double>"))
        assert w.table("interview_embeddings").count() == 1


def test_bucketed_target_is_not_shuffled(spark, warehouse):
    stage = spark.createDataFrame([("1", [1.0, 0.0])], "job_id string, embedding array<float>")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merge.upsert(warehouse.table("job_embeddings"), stage, ["job_id"], ["embedding"])
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_refresh_from_files_to_warehouse(spark, tmp_path):
    from jobloom.plans.refresh import refresh_jobs, refresh_questions
    from jobloom.sources.jobs import write_bronze

    root = str(tmp_path)
    items = [dict(id=str(i), title=f"dev {i}", description="SQL and Kafka", company="a",
                  created="2024-01-01 00:00:00", salary_max=1.0) for i in range(3)]
    write_bronze(bronze(spark, items + items[:1]), f"{root}/bronze", "2024-01-05")
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "a.csv").write_text("question\nWhat is SQL?\nWhy?\nWhy?\n")
    w = Warehouse(spark, "careers_refresh", scratch_path(spark, "warehouse"), dim=16, buckets=2)
    for _ in range(2):
        assert refresh_jobs(spark, f"{root}/bronze", f"{root}/silver", w) == {
            "found": 4, "cleaned": 3, "pairs": 6}
        assert refresh_questions(spark, f"{root}/q", w) == {"loaded": 2}
        assert w.table("jobs").count() == w.table("job_embeddings").count() == 3
        assert w.table("job_skills_ner").count() == 6
        assert rows(w.table("interview_skills_ner")) == [(1, "sql")]
        assert rows(w.table("interview_embeddings").select("q_id", F.size("embedding"))) == [
            (1, 16), (2, 16)]
    demand = spark.table("careers_refresh.v_role_skill_demand")
    assert ("dev 1", "kafka", 1) in rows(demand)


def test_only_new_files_are_loaded(spark, tmp_path):
    from jobloom.plans.refresh import refresh_new_jobs
    from jobloom.sources.jobs import write_bronze
    from jobloom.sources.ledger import Ledger

    root = str(tmp_path)

    def land(day, items):
        write_bronze(bronze(spark, items), f"{root}/bronze", day)

    def posting(i, day, text="SQL and Kafka", **more):
        return dict(id=str(i), title=f"dev {i}", description=text, company="a",
                    created=f"2024-01-{day:02} 00:00:00", salary_max=1.0, **more)

    w = Warehouse(spark, "careers_new_files", f"{root}/w", dim=16, buckets=4)
    ledger = Ledger(spark, f"{root}/ledger")
    run = lambda: refresh_new_jobs(
        spark, f"{root}/bronze", f"{root}/silver", w, ledger)
    files = lambda: {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns
                     for p in (tmp_path / "silver" / "jobs").glob("dt=*/part-*")}
    land("2024-02-01", [posting(i, 1 + i % 3) for i in range(30)])
    assert run()["cleaned"] == 30
    before = files()
    assert run() == {"files": 0, "found": 0, "cleaned": 0, "pairs": 0} and files() == before
    # One changed posting, one that moves to another date, one older than what is stored, one new.
    land("2024-02-02", [posting(0, 1, "git"), posting(4, 9, "git"), posting(5, 1, "git"),
                        posting(77, 2, "spark")])
    got = run()
    assert got["files"] == len(list((tmp_path / "bronze" / "date=2024-02-02").glob("*.json")))
    assert (got["found"], got["cleaned"]) == (4, 4)
    silver = read_silver(spark, f"{root}/silver/jobs")
    assert silver.count() == 31 == silver.select("job_id").distinct().count()
    text = {r.job_id: (r.description, str(r.dt)) for r in silver.collect()}
    assert text["4"] == ("git", "2024-01-09") and text["5"] == ("sql and kafka", "2024-01-03")
    assert text["77"] == ("spark", "2024-01-02") and text["0"][1] == "2024-01-01"
    assert w.table("jobs").count() == 31 and w.table("job_embeddings").count() == 31
    assert rows(w.table("jobs").filter("job_id in ('4', '5')").select("job_id", "description")) == [
        ("4", "git"), ("5", "sql and kafka")]
    # A date that nothing touched keeps its files; one that all rows leave goes.
    before = files()
    land("2024-02-03", [posting(4, 10, "git")])
    assert run()["cleaned"] == 1
    after = files()
    gone, came = before.keys() - after.keys(), after.keys() - before.keys()
    assert {p.split("/")[2] for p in gone} == {"dt=2024-01-09"}
    assert {p.split("/")[2] for p in came} == {"dt=2024-01-10"}
    assert all(after[p] == t for p, t in before.items() if p in after)


def piece_files(root):
    """Every data file below a table's folder, with its time and size."""
    return {str(p.relative_to(root)): (p.stat().st_mtime_ns, p.stat().st_size)
            for p in root.glob("load=*/bucket=*/part-*.parquet")}


def test_buckets_are_files_and_old_versions_go(spark, tmp_path):
    w = Warehouse(spark, "careers_files", str(tmp_path / "w"), dim=2, buckets=3, keep=2)
    w.ensure_tables()
    for n in range(4):
        w.upsert_jobs(jobs_frame(spark, [dict(job_id=str(i), title=f"t{n}") for i in range(500)]))
    root = tmp_path / "w" / "jobs"
    assert sorted(p.name for p in root.glob("load=*")) == ["load=3", "load=4"]
    assert sorted(p.name for p in root.glob("manifest/*")) == ["version=3", "version=4"]
    assert len(piece_files(root)) == 6 and w.table("jobs").filter("title = 't3'").count() == 500
    # The version before is still whole.
    assert spark.table("careers_files.jobs__v3").filter("title = 't2'").count() == 500


def test_a_merge_leaves_other_buckets_alone(spark, tmp_path):
    w = Warehouse(spark, "careers_cow", str(tmp_path / "w"), dim=2, buckets=8, keep=2)
    w.ensure_tables()
    w.upsert_jobs(jobs_frame(spark, [dict(job_id=str(i), title="old", url="u") for i in range(400)]))
    vectors = spark.range(400).selectExpr("cast(id as string) job_id", "array(id, 0D) embedding")
    w.upsert_embeddings("job_embeddings", vectors)
    before = {n: piece_files(tmp_path / "w" / n) for n in ("jobs", "job_embeddings")}
    assert len(before["jobs"]) == 8
    w.upsert_jobs(jobs_frame(spark, [dict(job_id="7", title="new"), dict(job_id="x", title="more")]))
    w.upsert_embeddings("job_embeddings", vectors.filter("job_id = '7'").selectExpr(
        "job_id", "reverse(embedding) embedding"))
    for name, touched in (("jobs", 2), ("job_embeddings", 1)):
        after = piece_files(tmp_path / "w" / name)
        assert before[name].items() <= after.items() and len(after) <= 8 + touched
        store = w.stores[name]
        kept = store.pieces(store.version()) & store.pieces(store.version() - 1)
        assert len(kept) >= 8 - touched
    assert rows(w.table("jobs").groupBy("title", "url").count()) == [
        ("more", None, 1), ("new", "u", 1), ("old", "u", 399)]
    assert rows(w.table("job_embeddings").filter("job_id in ('6', '7')")) == [
        ("6", [6.0, 0.0]), ("7", [0.0, 7.0])]
    # Only the touched bucket is read for a merge.
    plan = w.stores["jobs"].rows([3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "(bucket#" in plan
    # One more version, and what only the dropped one named is gone.
    w.upsert_jobs(jobs_frame(spark, [dict(job_id="7", title="newest")]))
    left = piece_files(tmp_path / "w" / "jobs")
    store = w.stores["jobs"]
    named = store.pieces(store.version()) | store.pieces(store.version() - 1)
    assert len(left) == len(named) and w.table("jobs").count() == 401


def test_pairs_are_appended_and_compacted(spark, tmp_path):
    w = Warehouse(spark, "careers_pairs", str(tmp_path / "w"), dim=2, buckets=4, keep=100)
    w.ensure_tables()
    pairs = lambda a, z: spark.range(a, z).selectExpr(
        "cast(id % 50 as string) job_id", "cast(id as string) skill")
    store, root, seen = w.stores["job_skills_ner"], tmp_path / "w" / "job_skills_ner", {}
    for n in range(1, 9):
        w.add_skills("job_skills_ner", pairs(0, n * 40).union(pairs(0, 3)))
        now = piece_files(root)
        assert seen.items() <= now.items()
        seen = now
        assert w.table("job_skills_ner").count() == n * 40 and store.version() == n
        assert spark.table(store.store(1)).count() == 40
    w.add_skills("job_skills_ner", pairs(10, 200))  # nothing new: no version
    assert store.version() == 8
    w.add_skills("job_skills_ner", pairs(0, 2000))
    assert store.version() == 10 and w.duplicate_keys("job_skills_ner").count() == 0
    assert len(store.pieces(10)) == 4 and w.table("job_skills_ner").count() == 2000
    w.replace_skills("job_skills_ner", pairs(0, 5))
    assert w.table("job_skills_ner").count() == 5


def test_counts_follow_the_loads(spark, tmp_path):
    w = Warehouse(spark, "careers_counts", str(tmp_path / "w"), dim=2, buckets=4, count_demand=True)
    w.ensure_tables()

    def same():
        got = rows(spark.table("careers_counts.v_role_skill_counts"))
        assert got == rows(spark.table("careers_counts.v_role_skill_demand"))
        return len(got)

    pairs = lambda *p: spark.createDataFrame(p, "job_id string, skill string")
    w.add_skills("job_skills_ner", pairs(("1", "sql"), ("9", "sql")))  # before their job
    assert same() == 0
    w.upsert_jobs(jobs_frame(spark, [dict(job_id="1", title="Dev"), dict(job_id="2", title="dev"),
                                     dict(job_id="3", title=None)]))
    assert same() == 1
    w.add_skills("job_skills_ner", pairs(("1", "sql"), ("2", "sql"), ("3", "sql"), ("2", "git")))
    assert same() == 3
    w.upsert_jobs(jobs_frame(spark, [dict(job_id="1", title="ops"), dict(job_id="3", title="DEV"),
                                     dict(job_id="2", title="DEV"), dict(job_id="9", title="")]))
    assert same() == 4
    before = piece_files(tmp_path / "w" / "role_skill_counts")
    w.upsert_jobs(jobs_frame(spark, [dict(job_id="2", title="dev", company="x")]))  # nothing to count
    assert same() == 4 and piece_files(tmp_path / "w" / "role_skill_counts") == before
    w.rebuild_demand()
    assert same() == 4
    w.replace_skills("job_skills_ner", pairs(("1", "c")))
    assert same() == 1


def test_buckets_grow_with_their_table(spark, tmp_path, monkeypatch):
    """No bucket of much more than the bound, whether rows come at once or over several loads."""
    monkeypatch.setattr(versions, "BUCKET_BYTES", 200_000)
    w = Warehouse(spark, "careers_grown", str(tmp_path / "w"), dim=2, buckets=2, keep=1, count_demand=True)
    w.ensure_tables()
    store = w.stores["jobs"]

    def jobs(a, z, title):
        some = TABLES["jobs"].schema.fieldNames()
        return spark.range(a, z).selectExpr(
            "cast(id as string) job_id", f"'{title}' title", "'u' url",
            "concat_ws(' ', transform(sequence(1, 400), i -> md5(concat(id, '-', i)))) description",
            *[f"cast(null as {TABLES['jobs'].schema[n].dataType.simpleString()}) {n}" for n in some
              if n not in ("job_id", "title", "url", "description")])

    def bucket_sizes():
        now = spark.table(store.store(store.version()))
        return [r.n for r in now.groupBy("bucket").agg(F.sum(F.octet_length("description")).alias("n")).collect()]

    w.upsert_jobs(jobs(0, 20, "a"))
    few = store.number()
    w.upsert_jobs(jobs(0, 400, "b"))
    many = store.number()
    assert 2 <= few < 32 <= many and max(bucket_sizes()) < 500_000
    assert len({b for _, b in store.pieces(store.version())}) > 16
    w.upsert_jobs(jobs(0, 1, "c"))  # a small load: nothing grows, one bucket is written
    assert store.number() == many and w.table("jobs").count() == 400
    # A load from the table itself, although only one version is kept.
    w.upsert_jobs(w.table("jobs").withColumns({
        "job_id": F.concat(F.lit("x"), "job_id"), "title": F.lit("d")}))
    assert store.number() > many
    assert rows(w.table("jobs").groupBy("title").count()) == [("b", 399), ("c", 1), ("d", 400)]
    assert w.duplicate_keys("jobs").count() == 0
    # Pairs and counts, and all rows anew.
    w.add_skills("job_skills_ner", w.table("jobs").selectExpr("job_id", "concat('s', job_id) skill"))
    w.add_skills("job_skills_ner", w.table("jobs").selectExpr("job_id", "concat(repeat('t', 2000), job_id) skill"))
    assert w.stores["job_skills_ner"].number() > 2 and w.counts.number() > 2
    assert w.table("job_skills_ner").count() == 1600
    assert rows(spark.table("careers_grown.v_role_skill_counts")) == rows(
        spark.table("careers_grown.v_role_skill_demand"))
    again = Warehouse(spark, "careers_grown_again", str(tmp_path / "w"), dim=2, buckets=2, keep=1)
    again.ensure_tables()
    assert again.stores["jobs"].number() == store.number()
    again.upsert_jobs(jobs(5, 6, "e"))
    assert rows(again.table("jobs").groupBy("title").count()) == [
        ("b", 398), ("c", 1), ("d", 400), ("e", 1)]
    again.replace_skills("job_skills_ner", spark.range(3).selectExpr("cast(id as string) job_id", "'s' skill"))
    assert again.stores["job_skills_ner"].number() == 2 and again.table("job_skills_ner").count() == 3


def test_a_buckets_share_hardly_grows_with_its_table():
    """A load's bytes for one bucket, from 0.2 GB (four buckets) up to 60 GB."""
    table = versions.BucketTable(None, "d", "r", TABLES["jobs"], 4, 2)
    shares = [n / table._wanted(n, 4) for n in range(200_000_000, 60_000_000_000, 100_000_000)]
    assert max(shares) <= 1.5 * shares[0]
    assert min(shares) >= shares[0] / 2


def test_manifests_without_numbers_are_read(spark, tmp_path):
    """As loads of before wrote them."""
    first = Warehouse(spark, "careers_old", str(tmp_path / "w"), dim=2, buckets=2)
    first.ensure_tables()
    first.upsert_jobs(jobs_frame(spark, [dict(job_id=str(i), title="a") for i in range(50)]))
    manifest = f"{first.stores['jobs'].root}/manifest/version=1"
    listed = spark.createDataFrame(sorted(first.stores["jobs"].pieces(1)), "load int, bucket int")
    listed.coalesce(1).write.mode("overwrite").parquet(manifest)
    again = Warehouse(spark, "careers_old_again", str(tmp_path / "w"), dim=2, buckets=2)
    again.ensure_tables()
    again.upsert_jobs(jobs_frame(spark, [dict(job_id="7", title="b"), dict(job_id="x", title="b")]))
    assert rows(again.table("jobs").groupBy("title").count()) == [("a", 49), ("b", 2)]


def test_tables_are_found_again_without_a_catalog(spark, tmp_path):
    first = Warehouse(spark, "careers_one", str(tmp_path / "w"), dim=2, buckets=2)
    first.ensure_tables()
    first.upsert_jobs(jobs_frame(spark, [dict(job_id="1", title="a")]))
    again = Warehouse(spark, "careers_two", str(tmp_path / "w"), dim=2, buckets=2)
    again.ensure_tables()
    assert rows(again.table("jobs").select("job_id", "title")) == [("1", "a")]
    again.upsert_jobs(jobs_frame(spark, [dict(job_id="2", title="b")]))
    assert again.table("jobs").count() == 2


def test_truncated_lines_do_not_stop_a_load(spark, tmp_path):
    from jobloom.plans.refresh import refresh_jobs

    day = tmp_path / "bronze" / "date=2024-01-05"
    day.mkdir(parents=True)
    (day / "a.jsonl").write_text('{"id": "1", "title": "Dev", "description": "python"}\n'
                                 '{"id": "2", "title": "Ops"\n{"title": "No id"}\n')
    w = Warehouse(spark, "careers_truncated", scratch_path(spark, "warehouse"), dim=4, buckets=2)
    got = refresh_jobs(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), w)
    assert got["cleaned"] == 1 and w.table("jobs").count() == 1


def test_bronze_is_read_once(spark, tmp_path):
    from jobloom.sources.jobs import read_bronze, write_bronze

    write_bronze(bronze(spark, [dict(id="1", title="a", description="x")]), str(tmp_path / "b"),
                 "2024-01-05")
    plan = clean_jobs(read_bronze(spark, str(tmp_path / "b")), 0)._jdf.queryExecution().toString()
    assert "json" not in plan.lower().replace("jsonl", "")


def test_exact_quantiles_with_one_value_in_most_rows(spark):
    from jobloom.operators import quantiles

    values = [5.0] * 700 + [float(i) for i in range(200)] + [float("nan")] * 3
    values += [-0.0, -1.5, -1e300, 1e300, 5e-324, -5e-324, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(7)
    ordered = sorted(values, key=lambda v: (v != v, v))
    n = len(values)
    ps = [0.0, 0.001, 0.0022, 0.01, 0.1, 0.25, 0.5, 0.8, 0.95, 0.995]
    want = [ordered[max(1, int(np.ceil(p * n))) - 1] for p in ps]
    assert quantiles.exact_quantiles(df, "x", ps).first()["q"] == want
    assert np.isnan(quantiles.exact_quantiles(df, "x", [1.0]).first()["q"][0])
    assert quantiles.exact_quantiles(df.filter("x < 0 and x > 1"), "x", ps).first()["q"] == []


def test_all_ranks_take_the_same_four_passes(spark):
    from jobloom.operators import quantiles

    rng = np.random.default_rng(6)
    data = {"even": rng.normal(size=3000), "steep": 10.0 ** rng.uniform(-300, 300, 3000)}
    jobs = set()
    for name, x in data.items():
        df = spark.createDataFrame([(float(v),) for v in x], "x double")
        for ps in ([0.5], [0.01, 0.2, 0.25, 0.5, 0.75, 0.9, 0.999]):
            spark.sparkContext.setJobGroup(f"{name} {len(ps)}", "quantiles")
            got = quantiles.exact_quantiles(df, "x", ps)
            jobs.add(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"{name} {len(ps)}")))
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
            x = np.sort(x)
            assert got.first()["q"] == [x[max(1, int(np.ceil(p * 3000))) - 1] for p in ps]
    assert len(jobs) == 1 and max(jobs) <= 10

import re
import time

from hypothesis import HealthCheck, given, settings, strategies as st

from jobloom.functions import lists, text, values


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(fn("c").alias("o")).first()["o"]


def many(spark, items, fn):
    rows = spark.createDataFrame(list(enumerate(items)), "i int, c string")
    return [r["o"] for r in rows.select("i", fn("c").alias("o")).orderBy("i").collect()]


TEXTS = st.text(alphabet=" \t\n\x0b\x1c\x85\xa0 aB@.<>é/:wpht", max_size=40)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXTS, min_size=30, max_size=60))
def test_cleanup_agrees_with_plain_regular_expressions(spark, items):
    def cleaned(s):
        for pattern in (r"<[^>]+>", r"http\S+|www\.\S+", r"\S+@\S+", r"\s+"):
            s = re.sub(pattern, " ", s)
        return s.strip().lower()

    assert many(spark, items, text.clean_job_description) == [cleaned(s) for s in items]
    assert many(spark, items, text.normalize_text) == [
        re.sub(r"\s+", " ", s.strip()).lower() for s in items]
    assert many(spark, items, text.word_count) == [len(s.split()) for s in items]


def test_long_odd_texts_take_no_long_time(spark):
    texts = ["a" + " " * 50_000 + "b", "< " * 30_000, "a" * 300_000 + "@", "<>" * 20_000 + "<x"]
    start = time.time()
    cleaned = many(spark, texts, text.clean_job_description)
    assert cleaned[0] == "a b" and cleaned[1] == ("< " * 30_000).strip()
    assert cleaned[2] == texts[2] and cleaned[3] == texts[3]
    assert many(spark, texts[:1], text.normalize_text) == ["a b"]
    assert time.time() - start < 20


def test_null_text_becomes_empty(spark):
    assert many(spark, [None, ""], text.normalize_text) == ["", ""]
    assert many(spark, [None, ""], text.clean_job_description) == ["", ""]


def test_description_keeps_its_ends(spark):
    assert one(spark, "  A \n\t B ", text.clean_description) == " a b "
    assert one(spark, "  Senior  Dev ", text.clean_title) == "senior  dev"


def test_question_cleanup(spark):
    got = many(spark, [None, "", "  ", "nan", "\t What? \n"], text.clean_question)
    assert got == [None, None, None, None, "What?"]


def test_topics(spark):
    topics = ["TECHNICAL", "hr", None, "biotech"]
    assert many(spark, topics, text.is_technical) == [True, False, False, True]
    assert many(spark, [None, "hr"], text.default_topic) == ["technical", "hr"]


def test_separator_stays_beside_nulls(spark):
    df = spark.createDataFrame([(None, None), ("t", None)], "title string, description string")
    assert [r[0] for r in df.select(text.skill_text()).collect()] == [". ", "t. "]
    assert [r[0] for r in df.select(text.vector_text()).collect()] == [" | ", "t | "]


def test_duplicate_key_skips_nulls(spark):
    rows = [("t", None, "x"), ("t", "x", None), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    keys = [r[0] for r in df.select(text.duplicate_key("a", "b", "c")).collect()]
    assert keys[0] == keys[1] and keys[2] == keys[3] != keys[0]


def test_mid_salary(spark):
    df = spark.createDataFrame([(1.0, 3.0), (None, 3.0), (1.0, None), (None, None)],
                               "a double, b double")
    assert [r[0] for r in df.select(values.mid_salary("a", "b")).collect()] == [2.0, 3.0, None, None]


def test_bad_values_become_null(spark):
    assert one(spark, "soon", values.posted_timestamp) is None
    assert one(spark, "many", values.to_double) is None


def test_skill_lists(spark):
    assert one(spark, " a, b,, \t,a", lists.split_skills) == ["a", "b", "a"]
    got = one(spark, [" SQL", "sql", "", "Go "], lists.deduplicate_skills, "array<string>")
    assert got == ["go", "sql"]


def test_gap_keeps_order_spelling_and_repeats(spark):
    df = spark.createDataFrame(
        [([" Python", "SQL "], ["Docker", "python", " ", "docker", "sql", "AWS"])],
        "u array<string>, t array<string>")
    assert df.select(lists.skill_gap("u", "t")).first()[0] == ["Docker", "docker", "AWS"]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.lists(st.sampled_from(["a", "B", " c", "d "]), max_size=4),
                          st.lists(st.sampled_from(["A", "b", "c", "D", ""]), max_size=6)),
                min_size=20, max_size=40))
def test_gap_never_holds_a_known_skill(spark, rows):
    df = spark.createDataFrame(rows, "u array<string>, t array<string>")
    for u, t, gap in df.select("u", "t", lists.skill_gap("u", "t")).collect():
        known = {s.strip().lower() for s in u}
        assert gap == [s for s in t if s.strip() and s.strip().lower() not in known]


def test_structure_checks(spark):
    df = spark.createDataFrame([("A Skill GAP\nfor weeks",)], "c string")
    row = df.select(text.line_count("c").alias("lines"),
                    text.mentions_any("c", ["skill gap", "zzz"]).alias("some"),
                    text.mentions_all("c", ["skill gap", "zzz"]).alias("every")).first()
    assert (row["lines"], row["some"], row["every"]) == (2, True, False)


def test_query_texts(spark):
    df = spark.createDataFrame([("ML", "sql, r")], "r string, s string")
    row = df.select(text.job_query_text("r", "s"), text.question_query_text("r", "s")).first()
    assert row[0] == "Target role: ML. Current skills: sql, r"
    assert row[1] == "Technical interview questions for ML. Candidate skills: sql, r"


def test_zones_are_dropped(spark):
    got = many(spark, ["2024-01-02T03:04:05+02:00", "2024-01-02 03:04:05.5Z", "2024-01-02", None],
               values.without_zone)
    assert got == ["2024-01-02T03:04:05", "2024-01-02 03:04:05.5", "2024-01-02", None]

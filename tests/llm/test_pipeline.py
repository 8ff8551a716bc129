"""Every stage of the pipeline on the rows that its predecessor kept, against plain versions."""

import os
import zlib
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from jobloom.llm import decontaminate, language, mixing, simhash
from tests.llm import plain

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark):
    """Rows of documents, with some odd ones, and of what each stage returns."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame(
        [(9001, None, "en", "src1", 0), (9002, "", None, None, 0), (9003, "12 - 34", "en", "src1", 7),
         (9004, "One plain text", "en", None, 14), (9005, "one plain TEXT", "en", None, 14)],
        docs.schema)
    frames, now = {}, docs.union(odd)
    frames["documents"] = now
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, FOLDER)
        now = spark.createDataFrame(now.collect(), now.schema)
        frames[name] = now
    return {name: [r.asDict() for r in f.collect()] for name, f in frames.items()}


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_stages_keep_the_columns(kept):
    for name, rows in list(kept.items())[:-1]:
        assert all(list(r) == COLUMNS for r in rows), name
    known = {r["doc_id"]: r for r in kept["documents"]}
    for name in ("language_id", "near_dedup", "decontaminate", "mix"):
        assert all(r == known[r["doc_id"]] for r in kept[name])


def test_texts_without_a_letter_go(kept):
    want = [r["doc_id"] for r in kept["documents"] if any(c.isalpha() for c in r["text"] or "")]
    assert ids(kept["language_id"]) == sorted(want)


def test_one_of_each_group_stays(kept):
    groups = plain.simhash([(r["doc_id"], r["text"]) for r in kept["language_id"]])
    assert ids(kept["near_dedup"]) == sorted({root for _, root in groups.values()})


def test_contaminated_documents_go(kept):
    items = duckdb.sql(f"select item_id, text from '{FOLDER}/benchmark.parquet'").fetchall()
    hits = plain.benchmark_hits([(r["doc_id"], r["text"]) for r in kept["near_dedup"]], items)
    assert ids(kept["decontaminate"]) == sorted(i for i, h in hits.items() if not h[4])


def test_the_mix_comes_near_its_targets(kept):
    size = {r["doc_id"]: len(plain.SPACED.findall(plain.lower(r["text"]))) for r in kept["decontaminate"]}
    of = {r["doc_id"]: r["source"] for r in kept["decontaminate"]}
    total, taken = Counter(), Counter()
    for i, n in size.items():
        total[of[i]] += n
    copies = Counter(r["doc_id"] for r in kept["mix"])
    for i, k in copies.items():
        assert k <= 3
        taken[of[i]] += k * size[i]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, mixing.targets([total[s] for s in order],
                                          [1 + i % 3 for i in range(len(order))])))
    longest = max(size.values())
    assert all(abs(taken[s] - goal[s]) <= longest for s in order)


def test_rows_of_the_mix_are_sharded(kept):
    text = {r["doc_id"]: r["text"] for r in kept["mix"]}
    assert ids(kept["shard"]) == ids(kept["mix"])
    slots, held = {}, {}
    for r in kept["shard"]:
        data = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        slots.setdefault(r["shard"], []).append(r["slot"])
        held.setdefault(text[r["doc_id"]], set()).add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in held.values()) and set(slots) <= set(range(24))


@pytest.mark.parametrize("stage", [
    language.keep_identified, simhash.drop_near_copies, mixing.mixed_documents,
    lambda docs: decontaminate.remove_contaminated(
        docs, docs.selectExpr("doc_id as item_id", "'tiny item' as text"))])
def test_columns_of_any_name_pass_through(odd, stage):
    known = {r.doc_id: tuple(r) for r in odd.collect()}
    got = stage(odd)
    rows = got.collect()
    assert got.schema == odd.schema and rows and all(tuple(r) == known[r.doc_id] for r in rows)
    assert stage(odd.limit(0)).count() == 0


def test_run_gives_the_rows_of_the_last_stage(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    again = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)

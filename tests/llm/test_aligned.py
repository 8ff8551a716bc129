"""Tokenizer alignment, fill-in-the-middle and web archives, against plain versions."""

import base64
import gzip
import hashlib
import io
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from jobloom.llm import align, fim, warc
from tests.llm import plain
from tests.llm.conftest import ODD

BYTES, PIECES = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
DOCS = [r[:2] for r in ODD]
STRANGE = ["▁x y", "a▁b", "<s> </s> <0x41>", "<|endoftext|>", "  two  blanks ", "\n", " ", "\x00\x01",
           "é" * 300, "=" * 500 + "-" * 500, "́́", "👩‍👩‍👧 fam", "ab\tcd\r\n\n\nxy", "ﬁ ½ Å",
           "z" * 3000, "1234567890" * 20, "x" + " " * 400 + "y"]


def tools():
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    return tokenizer, SentencePieceProcessor(model_file=PIECES)


def aligned(df):
    return sorted(tuple(r) for r in align.alignment_table(df, BYTES, PIECES).collect())


def test_alignment_of_odd_rows(odd, spark, monkeypatch):
    rows = DOCS + [(100 + k, t) for k, t in enumerate(STRANGE)] + [(4, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pairs", F.lit("x"))
    want = sorted(plain.alignment(rows, *tools()))
    assert aligned(df.repartition(3)) == want
    # Whatever is frequent, and however few pairs are paired at once.
    for frequent, long in ((0, 1), (20, 2)):
        monkeypatch.setattr(align, "FREQUENT", frequent)
        monkeypatch.setattr(align, "LONG_GROUP", long)
        assert aligned(df) == want
    assert aligned(df.limit(0)) == []
    null = spark.createDataFrame([(None, None), (None, "a b")], "doc_id long, text string")
    assert [r[1:4] for r in align.alignment_table(null, BYTES, PIECES).collect()] in (
        [(0, 0, 0), (2, 2, 2)], [(2, 2, 2), (0, 0, 0)])


def test_alignment_of_the_smallest_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert aligned(docs) == sorted(plain.alignment(rows, *tools()))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=40), st.data())
def test_groups_are_cut_where_both_cut(sizes, data):
    ends = np.cumsum(sizes)
    inner = data.draw(st.sets(st.integers(1, int(ends[-1]))))
    other = np.array(sorted(inner | {int(ends[-1])}))
    common = np.intersect1d(ends, other)
    for got, mine in zip(align.groups_of(ends, other), (ends, other)):
        assert got.tolist() == np.searchsorted(common, mine).tolist()


# Fill-in-the-middle

@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \t\n\x0b\x1fab é日😀\xa0<PSM>", max_size=80), st.integers(-5, 500))
def test_cuts_fall_at_the_units(text, key):
    assert fim.cut(text, key) == plain.middle(key, text)


def test_skip_list_reaches_every_rank():
    rng = random.Random(5)
    text = "".join(rng.choice(["word ", "é  ", "日本\n", "x\t"]) for _ in range(5000))
    ends = fim.unit_ends(text)
    units = fim.SkipList(ends)
    assert len(units.lanes) > 4 and all(int(u.sum()) <= len(ends) for u, _, _ in units.lanes)
    assert [units.find(k) for k in range(len(ends) + 1)] == [0, *ends.tolist()]
    assert fim.SkipList(np.zeros(0, np.int64)).find(0) == 0


def test_middle_of_odd_rows(odd, spark):
    made = fim.fill_in_middle(odd)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    back = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(tuple(r)[:6] for r in back) == sorted((i, *plain.middle(i, t)) for i, t in DOCS)
    assert {r.doc_id: r.back for r in back} == {i: t or "" for i, t in DOCS}
    assert fim.middle_table(odd.limit(0)).count() == 0
    extra = [(None, "a b c"), (7, "a<P>b"), (None, None), (7, "a<P>b")]
    got = fim.fill_in_middle(spark.createDataFrame(extra, "doc_id long, text string"), rate=100).collect()
    assert len(got) == 4 and [r.output for r in got if r.doc_id == 7] == ["a<P>b"] * 2
    assert {r.n for r in got if r.doc_id is None} == {0, 3}


def test_long_text(spark):
    text = "lorem ipsum é " * 200_000
    df = spark.createDataFrame([(k, text) for k in range(4)], "doc_id long, text string")
    for r in fim.fill_in_middle(df, rate=100).collect():
        parts = {"psm": (1, 3, 2), "spm": (2, 3, 1)}[r.form]
        cells = r.output.replace("<P>", "<S>").replace("<M>", "<S>").split("<S>")
        assert r.n == 600_001 and "".join(cells[k] for k in parts) == text
        p, m = cells[parts[0]], cells[parts[1]]
        assert (r.prefix_chars, r.middle_chars) == (len(p), len(m))
        h = fim.draws(42, r.doc_id)
        cuts = sorted(x % 600_002 for x in h[:2])
        assert [len(plain.UNITS.findall(t)) for t in (p, p + m)] == cuts


# Web archives

PAGES = [(1, "u", "<p>a</p>"), (2, "v", "<p>a</p>"), (3, None, None), (4, "w", ""), (5, "x\r\ny", "A\r\n\r\nB"),
         (6, "x", "\r\n\r\n"), (7, "é", "日本 \x00 WARC/1.1\r\n\r\n\r\n"), (8, "x", "A\r\n\r\nB"),
         (9, "big", "long text " * 300_000), (10, "x", "\r\n"), (10, "x", "\r\n"), (2, "v", "<p>a</p>"),
         (None, "n", "only"), (None, "n", "<p>a</p>"), (11, "x", "\r\n\r\n\r\n\r\n")]


def paged(rows):
    best = {}
    for i, _, t in rows:
        if i is not None:
            best[t or ""] = max(best.get(t or "", i), i)
    out = []
    for i, _, t in rows:
        data = (t or "").encode()
        first = best.get(t or "") == i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if first else "revisit", None if first else best[t or ""]))
    return sorted(out, key=str)


def test_archives_of_odd_pages(spark, monkeypatch):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    df = df.withColumn("same", F.lit(1)).withColumn("size", F.lit("s")).withColumn("payload", F.lit(0))
    for share, held in ((1000, 1 << 23), (1, 100)):
        monkeypatch.setattr(warc, "HOT_SHARE", share)
        monkeypatch.setattr(warc, "ARCHIVE_BYTES", held)
        got = warc.archived_pages(df.repartition(3))
        assert sorted(map(tuple, got.collect()), key=str) == paged(PAGES)
    assert warc.archived_pages(df.limit(0)).count() == 0
    same = df.filter("page_id is null").union(df.filter("page_id is null"))
    assert {r.record_type for r in warc.archived_pages(same).collect()} == {"response"}


def test_small_payloads_are_never_revisits(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = {(r.id, r.size): r.record_type for r in warc.paged(df, least_bytes=8).collect() if r.id}
    assert got["1", 8] == got["2", 8] == "revisit" or got["2", 8] == "response"
    assert {v for (_, n), v in got.items() if n < 8} == {"response"}


def test_every_record_is_a_member_and_the_index_finds_it(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 400)
    df = spark.createDataFrame([p for p in PAGES if p[0]], "page_id long, url string, html string")
    warc.write_archives(df.coalesce(1), f"{tmp_path}/whole")
    warc.normalise(spark, f"{tmp_path}/whole", f"{tmp_path}/new")
    files = {r.file: bytes(r.content) for r in spark.read.parquet(f"{tmp_path}/new/archives").collect()}
    index = spark.read.parquet(f"{tmp_path}/new/index").collect()
    assert len(files) > 1 and len(index) == df.count()
    for r in index:
        data = gzip.GzipFile(fileobj=io.BytesIO(files[r.file][r.offset:r.offset + r.length])).read()
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in tmp_path.glob("whole/*.gz"))
    assert sorted(b"".join(gzip.decompress(f) for f in files.values())) == sorted(whole)
    want = spark.createDataFrame([("<urn:page:9>",), ("<urn:page:7>",), ("<urn:page:7>",), ("none",)], "k string")
    got = {r.record_id: r for r in warc.read_records(spark, f"{tmp_path}/new", want, "k").collect()}
    assert set(got) == {"<urn:page:9>", "<urn:page:7>"}
    assert bytes(got["<urn:page:9>"].payload).decode() == PAGES[8][2]
    assert got["<urn:page:7>"].target_uri == "é"
    # Archives that are normal already give the same records again.
    again = [(n, b) for n, b in sorted(files.items())]
    (tmp_path / "members").mkdir()
    for n, b in again:
        (tmp_path / "members" / n).write_bytes(b)
    warc.normalise(spark, f"{tmp_path}/members", f"{tmp_path}/twice")
    twice = warc.read_archives(spark, f"{tmp_path}/twice").drop("payload")
    once = warc.read_archives(spark, f"{tmp_path}/new").drop("payload")
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_broken_archives_fail(spark, tmp_path):
    good = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    for k, bad in enumerate([good[:-8], good.replace(b": 5", b": 2"), good.replace(b"WARC", b"wrac")]):
        (tmp_path / str(k)).mkdir()
        (tmp_path / str(k) / "a.warc.gz").write_bytes(gzip.compress(bad))
        with pytest.raises(Exception):
            warc.normalise(spark, f"{tmp_path}/{k}", f"{tmp_path}/out{k}")


@pytest.mark.parametrize("name, sql", [("documents", fim.SQL), ("pages", warc.SQL)])
def test_against_sql(spark, name, sql):
    from jobloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    duckdb.sql(f"create or replace view {name} as select * from '{folder}/{name}.parquet'")
    query = "op12_fill_in_middle" if name == "documents" else "op13_warc_members"
    got = QUERIES[query](spark, folder)
    want = duckdb.sql(sql)
    cells = want.fetchall()
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        (tuple(r[k] for k in order) for r in cells), key=str)

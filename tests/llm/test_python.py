"""The operators with Python in their tasks: mixing, decontamination, tokens, languages, scores."""

import math
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobloom.llm import decontaminate, language, mixing, perfect, scoring, tokens
from tests.llm import plain
from tests.llm.conftest import ITEMS, ODD

DOCS = [r[:2] for r in ODD]


# Mixing

@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 40)), min_size=1, max_size=8),
       st.integers(0, 120))
def test_apportionment_goes_by_highest_quotient(pairs, seats):
    weights, caps = [float(w) for w, _ in pairs], [c for _, c in pairs]
    assert mixing.apportion(weights, caps, seats) == plain.sainte_lague(weights, caps, seats)


def test_targets_stop_at_three_times():
    got = mixing.targets([10, 1000, 1000], [1, 2, 3])
    assert got[0] == 30 and got[1] == pytest.approx(1980 * 2 / 5) and got[2] == pytest.approx(1980 * 3 / 5)
    assert mixing.targets([0, 0], [1, 2]) == [0, 0] and mixing.targets([], []) == []
    assert mixing.targets([5], [1]) == [5]


def check_mix(rows, got, shards=1):
    size = {}
    for i, t, *_, s in rows:
        size[s] = size.get(s, 0) + len(plain.SPACED.findall(plain.lower(t)))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, mixing.targets([size[s] for s in order],
                                          [1 + i % 3 for i in range(len(order))])))
    taken = dict.fromkeys(order, 0)
    by = {}
    for i, _, *_, s in rows:
        by.setdefault(i, s)
    for r in got:
        s = by[r.doc_id]
        assert r.source_size == size[s] and r.target == pytest.approx(goal[s])
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in order:
        assert abs(taken[s] - goal[s]) <= 4 * shards + 4


def test_mix_of_odd_rows(odd):
    got = mixing.mix_sources(odd).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in DOCS)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix_sources(odd.repartition(5)).collect()))
    check_mix([(i, t, s) for i, t, _, s in ODD], got)
    whole = mixing.mixed_documents(odd)
    assert whole.columns == odd.columns and mixing.mix_sources(odd.limit(0)).count() == 0


def test_mix_over_many_shards_with_a_hot_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 2000)
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 40), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(2000)]
    rows += rows[:4]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(df).collect()
    assert len(got) == len(rows)
    check_mix(rows, got, shards=len({r.shard for r in got}))


# Decontamination

def test_hits_of_odd_rows(odd, items):
    got = decontaminate.contamination(odd, items).collect()
    want = plain.benchmark_hits(DOCS, [x for x in ITEMS if x[0] is not None])
    lines = {i: plain.benchmark_hits(DOCS, ITEMS)[i] for i in (8, 18)}
    assert len(got) == len(DOCS)
    for r in got:
        mine = (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
        if r.doc_id in lines:  # the item without an id hits, and is not named
            assert mine[:3] == (900, 900, 0) and r.contaminated and lines[r.doc_id][1] == 900
        else:
            assert mine == want[r.doc_id], r.doc_id
    clean = decontaminate.remove_contaminated(odd, items)
    assert clean.columns == odd.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(
        r.doc_id for r in got if not r.contaminated)


def test_hits_do_not_depend_on_blocks_or_shards(spark, monkeypatch):
    rng = random.Random(1)
    word = lambda: rng.choice("a b c d e f".split())
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 300)))) for i in range(80)]
    items = [(i, " ".join(docs[i * 3][1].split()[5:5 + rng.randint(0, 30)])) for i in range(20)]
    want = plain.benchmark_hits(docs, items)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for chars, shard, blocks in ((1 << 24, 1 << 20, 4), (100, 50, 2)):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", chars)
        monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
        monkeypatch.setattr(decontaminate, "PASS_BLOCKS", blocks)
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
               for r in decontaminate.contamination(df, bench).collect()}
        assert got == want
    none = decontaminate.contamination(df, bench.limit(0))
    assert none.filter("n_hit > 0 or contaminated").count() == 0
    assert decontaminate.contamination(df.limit(0), bench).count() == 0


# Token files

@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(-2**63, 2**63 - 1), max_size=300), st.integers(-2**63, 2**63 - 1))
def test_perfect_hash(keys, other):
    keys_ = np.array(sorted(keys), np.int64)
    got = perfect.PerfectHash(*perfect.build(keys_))(keys_)
    assert sorted(got.tolist()) == list(range(len(keys)))
    rows = [np.arange(k % 5, dtype="<u4") for k in range(len(keys))]
    if keys:
        file = tokens.TokenFile(tokens.pack(keys_.tolist(), [r.tobytes() for r in rows]))
        for k, r in zip(keys_.tolist(), rows):
            assert [x.tolist() for x in file.get(k)] == [r.tolist()]
        assert other in keys or file.get(other) == []


@pytest.mark.parametrize("segment", [1, 100, 1 << 19])
def test_token_files_of_odd_rows(spark, odd, tmp_path, segment):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens.write_tokens(odd, path, str(tmp_path / "t"), segment_ids=segment)
    got = tokens.read_tokens(spark, str(tmp_path / "t")).collect()
    want = plain.token_table(DOCS, Tokenizer.from_file(path))
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == want
    keys = spark.createDataFrame([(10,), (17,), (999,)], "doc_id long")
    found = {r.key: r.ids for r in tokens.read_keys(spark, str(tmp_path / "t"), keys).collect()}
    encode = Tokenizer.from_file(path).encode
    assert found == {i: encode(dict(DOCS)[i], add_special_tokens=False).ids + [2] for i in (10, 17)}


def test_token_files_of_repeated_ids(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(5, "a b"), (5, "a b"), (5, "c"), (1, None), (None, "lost"), (9, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = tokens.token_table(df, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [1, 5, 5, 5, 9]
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got[:-1]]))
    assert tokens.token_table(df.limit(0), path).count() == 0


def test_a_batch_is_not_unpacked_whole(monkeypatch):
    """Of a batch of 40 MB only the texts of a run are Python strings at a time, and what a
    batch has taken goes back."""
    monkeypatch.setattr(tokens, "RUN_CHARS", 1 << 20)
    back = []
    monkeypatch.setattr(tokens, "give_back", lambda: back.append(1))
    texts = pa.array(["x" * 100_000] * 400, pa.string())
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(400), pa.int64()), texts, pa.array([3] * 400, pa.int32())], names=["i", "t", "s"])
    tracemalloc.start()
    try:
        files = list(tokens.segments(iter([batch, batch]), lambda run: [b"\1\0\0\0"] * len(run), 500))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 8 << 20 and len(back) == 2
    assert [f.column(5).to_pylist() for f in files] == [[500], [500], [500], [100]]
    assert [f.column(0).to_pylist() for f in files] == [[3]] * 4


@settings(max_examples=80, deadline=None)
@given(st.text(st.one_of(st.sampled_from(list(" \t\n'aB9.é中 　<|>_")), st.characters(
    exclude_categories=["Cs"])), max_size=60))
def test_pieces_encode_as_the_whole(text):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = test_pieces_encode_as_the_whole.__dict__.setdefault("e", tokens.Encoder(path))
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    got = encoder([text, "a plain text,\nof words.", text])
    assert np.frombuffer(got[0], "<u4").tolist() == whole and got[2] == got[0]
    assert np.frombuffer(got[1], "<u4").tolist() == encoder.tokenizer.encode(
        "a plain text,\nof words.", add_special_tokens=False).ids


# Languages

@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.lists(st.integers(-9, 0), min_size=3, max_size=3), max_size=12),
                min_size=1, max_size=6), st.integers(0, 6))
def test_viterbi_over_many_texts(texts, switch):
    flat = [row for t in texts for row in t]
    scores = np.array(flat or np.zeros((0, 3)), np.float32).reshape(-1, 3)
    lengths = np.array([len(t) for t in texts])
    got = language.viterbi(scores, np.arange(len(flat)), lengths, switch).tolist()
    assert got == [x for t in texts if t for x in plain.viterbi(t, switch)]


SYLLABLES = {"en": "th ing er on and", "fr": "eau ou ai elle ion", "ru": "ов ст ен ни при"}


def make_text(lang, n, rng):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_languages_and_mixed_spans(spark):
    rng = random.Random(4)
    rows = [(i, make_text(lang, rng.randint(3, 40), rng), lang)
            for i in range(300) for lang in [("en", "fr", "ru")[i % 3]]]
    mixed = make_text("en", 30, rng) + " " + make_text("fr", 50, rng) + " " + make_text("ru", 20, rng)
    rows += [(1000, mixed, None), (1001, None, "en"), (1002, "123 ² --", "fr"), (1003, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(df).collect()}
    assert len(got) == len(rows)
    assert all(r.held_out == (plain.crc(i) % 4 == 2) for i, r in got.items())
    assert np.mean([got[i].lang_pred == lang for i, _, lang in rows[:300]]) > 0.98
    spans = got[1000].spans
    assert [s.lang for s in spans] == ["en", "fr", "ru"] and got[1000].lang_pred == "fr"
    assert abs(spans[1].first_word - 30) <= 2 and abs(spans[2].first_word - 80) <= 2
    for i in (1001, 1002, 1003):
        assert (got[i].lang_pred, got[i].score, got[i].spans) == ("und", 0.0, [])
    kept = language.keep_identified(df)
    assert kept.columns == df.columns and kept.count() == 301
    # Neither language, nor id, nor source is an input of a prediction.
    other = language.label_texts(language.fit(df, "doc_id", "text", "lang"), [rows[0][1]])
    assert other[0]["lang"] == got[0].lang_pred


def test_languages_without_labels(spark, odd):
    none = language.identify(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert language.identify(odd.limit(0)).count() == 0
    assert {r.doc_id: r.lang_pred for r in language.identify(odd).collect()}[0] == "und"


# Scores

def check_base(rows, got):
    want = plain.base_scores(rows)
    assert len(got) == len(rows)
    for r in got:
        held, n, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score <= 0 and math.isfinite(r.score)


@pytest.mark.parametrize("head", [4, 131_070])
def test_scores_of_odd_rows(odd, monkeypatch, head):
    monkeypatch.setattr(scoring, "HEAD_WORDS", head)
    check_base(DOCS, scoring.score_texts(odd).collect())


def test_scores_prefer_text_like_the_training(spark):
    rng = random.Random(8)
    rows = [(i, make_text("en" if i % 5 else "fr", 60, rng)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = scoring.score_texts(df).filter("held_out").collect()
    rate = {k: np.mean([r.bits_per_byte for r in got if bool(r.doc_id % 5) == k]) for k in (True, False)}
    assert rate[True] < rate[False] < 4
    assert scoring.score_texts(df.limit(0)).count() == 0
    held = df.filter(F.col("doc_id").isin([i for i, _ in rows if plain.crc(i) % 10 == 0]))
    alone = scoring.score_texts(held).collect()
    assert all(r.base_score == 0 and r.n_known == 0 and r.score < 0 for r in alone)


def test_words_of_slices_are_those_of_python():
    texts = [None, "", " \n", "Ab  É\x0bc\x1cd ", "x y", "\u3000 a\u00a0b", "ÀÉ one", None, "Z\tz"] * 3
    column = pa.array(texts)
    for start in (0, 3, 10):
        words, lengths = scoring.split(column.slice(start, 14))
        want = [(t or "").encode().lower().split() for t in texts[start:start + 14]]
        assert lengths.tolist() == [len(w) for w in want]
        assert words.to_pylist() == [x for w in want for x in w]


def test_long_text_in_stretches(monkeypatch):
    rng = np.random.default_rng(9)
    code = code_of(50)
    model = {"code": code, "counts": counts_of(7, 9), "weights": scoring.first_weights()}
    run = scoring.Run(code, [" ".join(f"w{i}" for i in rng.integers(0, 60, 3000))] * 2 + ["w1"])
    whole = scoring.score_run(model, run)
    monkeypatch.setattr(scoring, "STRETCH_WORDS", 300)
    assert scoring.score_run(model, run) == pytest.approx(whole, rel=1e-5)


def test_context_tables_grow_with_the_training_words():
    bits = [scoring.context_bits(scoring.SLOT_WORDS * n) for n in (0, 1 << 18, (1 << 18) + 1, 1 << 40)]
    assert bits == [18, 18, 19, scoring.MOST_BITS]


def test_sums_of_table_pieces(spark):
    rng = np.random.default_rng(4)
    tables = [rng.integers(0, 1 << k, (scoring.SLOTS, 2)) for k in (3, 9, 40)]
    rows = [r for i, t in enumerate(tables) for b in scoring._pieces(t, 63 + i) for r in b.to_pylist()]
    sent = spark.createDataFrame([(r["piece"], r["part"], r["counts"]) for r in rows], scoring._PIECES)
    assert (scoring._summed(sent, scoring.CONTEXT_BITS) == sum(tables)).all()


def code_of(n):
    return scoring.Code([(f"w{i}".encode(), n - i) for i in range(n)] + [(scoring.END, 5), (scoring.ESCAPE, 3)])


@pytest.mark.parametrize("n", [0, 1, 7, 300])
def test_code_is_complete(n):
    code = code_of(n)
    assert sum(2.0 ** -x for x in code.length) == pytest.approx(1.0)
    paths = {tuple(code.step[a:a + k] & 1) for a, k in zip(code.start, code.length)}
    assert len(paths) == n + 2


def counts_of(seed, most):
    rng = np.random.default_rng(seed)
    return scoring.table(rng.integers(0, most, (scoring.SLOTS, 2)))


def test_next_symbol_probabilities_sum_to_one():
    code = code_of(6)
    model = {"counts": counts_of(2, 50), "weights": scoring.first_weights()}
    length, bit, slots = scoring.code_bits(code, np.arange(8), np.full(8, 3), np.full(8, 1))
    x, gate = scoring.inputs(model["counts"], slots)
    log2 = scoring.mix(model["weights"], np.int32(0), x, gate, bit, [len(bit)])
    assert (2.0 ** np.bincount(np.repeat(np.arange(8), length), log2)).sum() == pytest.approx(1, abs=1e-3)


def test_next_byte_probabilities_sum_to_one():
    model = {"counts": counts_of(4, 30), "weights": scoring.first_weights()}
    short = scoring.spell(model, [b"ab"])[0]
    longer = [b"ab" + bytes([x]) for x in range(256) if x != 32]
    # What follows "ab" is a space, or another byte; the end of the longer word is divided out.
    given = scoring.spell(model, [b"a"])
    assert short < 0 and given[0] < 0 and len(scoring.spell(model, longer)) == 255
    _, bit, slots = scoring.byte_bits([b"ab" + bytes([x]) for x in range(256)])
    x, gate = scoring.inputs(model["counts"], slots)
    log2 = scoring.mix(model["weights"], np.int32(0), x, gate, bit, [len(bit)]).reshape(256, 4, 8)
    assert (2.0 ** log2[:, 2].sum(1)).sum() == pytest.approx(1, abs=1e-3)


def test_refining_learns_the_text_at_hand():
    code = code_of(50)
    total = np.zeros((scoring.SLOTS, 2), np.int64)
    rng = np.random.default_rng(1)
    run = scoring.Run(code, [" ".join(f"w{i}" for i in rng.integers(0, 50, 4000))])
    _, bit, slots = scoring.code_bits(code, run.symbol, run.before, run.before2)
    scoring.tally(total, bit, slots)
    model = {"code": code, "counts": scoring.table(total), "weights": scoring.first_weights()}
    text = " ".join(f"w{i}" for i in rng.integers(0, 50, 4000))
    fixed = scoring.score_run(model | {"weights": model["weights"].copy()},
                              scoring.Run(code, [text[:500]]))[0] / 500
    assert scoring.score_run(model, scoring.Run(code, [text]))[0] / len(text) > 1.02 * fixed


def test_score_does_not_depend_on_neighbours():
    rng = np.random.default_rng(3)
    code = code_of(50)
    model = {"code": code, "counts": counts_of(5, 9), "weights": scoring.first_weights()}
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 60, n)) for n in (0, 5, 200, 1000, 1)] + [None]
    together = scoring.score_run(model, scoring.Run(code, texts))
    alone = [scoring.score_run(model, scoring.Run(code, [t]))[0] for t in texts]
    assert together == pytest.approx(alone, rel=1e-4)
    assert model["weights"].tolist() == scoring.first_weights().tolist()


def test_model_counts_every_training_text(spark):
    """Nothing that the model holds is fitted on a part of the training texts."""
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 300)))) for i in range(60)]
    model, _ = scoring.fit(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    codes, code = model["codes"], model["codes"]["code"]
    total = np.zeros((scoring.SLOTS, 2), np.int64)
    run = scoring.Run(code, [t for i, t in rows if plain.crc(i) % 10])
    scoring.tally(total, *scoring.code_bits(code, run.symbol, run.before, run.before2)[1:])
    want = scoring.table(total)
    assert all((codes["counts"][k] == want[k]).all() for k in want)
    for part in ("codes", "letters"):
        assert (model[part]["weights"] == scoring.first_weights()).all()

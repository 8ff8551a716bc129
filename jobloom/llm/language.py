"""Language of texts: script ranges, per-word scores, and Viterbi with a switching penalty."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from jobloom.llm.words import crc32_mod, known, whole_row

FOLDS = 4               # crc32(id) mod FOLDS == HELD_OUT is never learned from
HELD_OUT = 2
SAMPLE_DOCS = 5000      # documents learned from per language, about: the bound of the sample
BUCKETS = 1 << 15       # hashed letter trigrams
SWITCH = 10.0           # nats that a change of language costs
SCRIPT_SHARE = 0.005    # a language is a candidate for a script that has this share of its words
RUN_CHARS = 1 << 23     # characters of texts labelled together
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")

# First code point of Unicode stretches and their script.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"),
    (0x0980, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C00, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"),
    (0xFF5B, "other"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"),
    (0x20000, "han"), (0x30000, "other"),
]
_SCRIPT_STARTS = np.array([a for a, _ in SCRIPTS], np.int64)
SCRIPT_NAMES = sorted({s for _, s in SCRIPTS})
_SCRIPT_OF = np.array([SCRIPT_NAMES.index(s) for _, s in SCRIPTS])


def letter_words(text: str | None) -> list[str]:
    """Runs of letters, lower-cased; runs of other numerals are not words."""
    return [w for w in _LETTERS.findall(text.lower()) if w.isalpha()] if text else []


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigrams of all words, where each word's begin, and each word's script."""
    codes = np.frombuffer("\n".join(["", *words, ""]).encode("utf-32-le"), "<u4").astype(np.int64)
    inner = codes[1:-1] != 10
    a, b, c = codes[:-2][inner], codes[1:-1][inner], codes[2:][inner]
    h = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) & 0xFFFFFFFF
    h ^= h >> 15
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    script = _SCRIPT_OF[np.searchsorted(_SCRIPT_STARTS, b[starts], "right") - 1] if len(
        words) else np.zeros(0, np.int64)
    return h % BUCKETS, starts, script


def learn(docs: DataFrame, text_col: str, lang_col: str, sample_docs: int = SAMPLE_DOCS,
          id_col: str = "doc_id") -> dict:
    """Trigram and script counts of each language, from about ``sample_docs`` documents of each.

    The sample is drawn by a hash of id and text against the share that the language's count
    allows, so it is bounded at every size, also where many rows hold one text, and the same
    in every run. Counts are summed in
    the tasks first and then by Spark; the result has at most BUCKETS rows per language.
    """
    labelled = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"),
        F.col(lang_col).cast("string").alias("l"))
    counts = {r.l: r["count"] for r in labelled.groupBy("l").count().collect()}
    if not counts:
        return {}
    draw = F.pmod(F.xxhash64("i", "t"), F.lit(1 << 30))
    share = F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("l") == lang, int(min(1.0, sample_docs / n) * (1 << 30))).otherwise(share)
    langs = sorted(counts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), BUCKETS + len(SCRIPT_NAMES)), np.int64)
        for batch in batches:
            texts, labels = (c.to_pylist() for c in batch.columns)
            for i, lang in enumerate(langs):
                words = [w for t, l in zip(texts, labels) if l == lang for w in letter_words(t)]
                h, _, script = trigrams(words)
                total[i, :BUCKETS] += np.bincount(h, minlength=BUCKETS)
                total[i, BUCKETS:] += np.bincount(script, minlength=len(SCRIPT_NAMES))
        i, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(total[i, at])],
            names=["l", "at", "n"])

    rows = labelled.filter(draw < share).select("t", "l").mapInArrow(count, "l int, at int, n long").groupBy(
        "l", "at").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((len(langs), BUCKETS + len(SCRIPT_NAMES)))
    l, at, n = (rows[c].to_numpy() for c in ("l", "at", "n"))
    table[l, at] = n
    grams, scripts = table[:, :BUCKETS], table[:, BUCKETS:]
    logp = np.log((grams + 0.1) / (grams.sum(1, keepdims=True) + 0.1 * BUCKETS))
    seen = scripts / np.maximum(scripts.sum(1, keepdims=True), 1) >= SCRIPT_SHARE
    # A script that no language uses leaves all of them as candidates.
    barred = np.where(seen | ~seen.any(0), 0.0, -1000.0)
    return {"langs": langs, "logp": np.ascontiguousarray(logp.T.astype(np.float32)),
            "barred": np.ascontiguousarray(barred.T.astype(np.float32))}


def word_scores(model: dict, words: list[str]) -> np.ndarray:
    """log P(word | language) of each word, candidates only."""
    h, starts, script = trigrams(words)
    if not len(words):
        return np.zeros((0, len(model["langs"])), np.float32)
    return np.add.reduceat(model["logp"][h], starts, axis=0) + model["barred"][script]


def viterbi(scores: np.ndarray, word: np.ndarray, lengths: np.ndarray,
            switch: float = SWITCH) -> np.ndarray:
    """The best language of every word of every text, all texts advancing together.

    ``word`` holds the score row of each word, text after text. A step keeps the language or
    leaves the best one so far for ``switch``; ties keep, and go to the first language.
    """
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")
    n_langs = scores.shape[1]
    came = np.empty((len(word), n_langs), np.uint8 if n_langs <= 256 else np.int16)
    value = np.zeros((len(sizes), n_langs), np.float64)
    own = np.arange(n_langs, dtype=came.dtype)
    for t, n in enumerate(active):
        rows, v = begin[:n] + t, value[:n]
        if t:
            best = v.argmax(1)
            leave = v[np.arange(n), best][:, None] - switch
            jump = leave > v
            came[rows] = np.where(jump, best[:, None].astype(came.dtype), own)
            v = np.where(jump, leave, v)
        value[:n] = v + scores[word[rows]]
    label = np.empty(len(word), np.int64)
    state = value.argmax(1)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        rows = begin[:n] + t
        label[rows] = state[:n]
        if t:
            state[:n] = came[rows, state[:n]]
    return label


def label_texts(model: dict, texts: list[str | None]) -> list[dict]:
    """lang, score and spans (language, first word, last word) of each text."""
    split = [letter_words(t) for t in texts]
    number: dict[str, int] = {}
    word = np.fromiter((number.setdefault(w, len(number)) for ws in split for w in ws), np.int64)
    lengths = np.fromiter(map(len, split), np.int64, len(split))
    names = list(number)
    label = viterbi(word_scores(model, names), word, lengths) if len(word) else word
    letters = np.fromiter(map(len, names), np.int64, len(names))[word] if len(word) else word
    n_langs = len(model["langs"])
    doc = np.repeat(np.arange(len(split)), lengths)
    held = np.bincount(doc * n_langs + label, letters, len(split) * n_langs).reshape(-1, n_langs)
    edge = np.ones(len(word), bool)
    edge[1:] = (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(word)) - 1
    begin = np.cumsum(lengths) - lengths
    low, high = np.searchsorted(doc[first], np.arange(len(split) + 1)[:-1]), np.searchsorted(
        doc[first], np.arange(1, len(split) + 1))
    out = []
    for i in range(len(split)):
        if not lengths[i]:
            out.append({"lang": UNKNOWN, "score": 0.0, "spans": []})
            continue
        best = int(held[i].argmax())
        out.append({
            "lang": model["langs"][best], "score": float(held[i, best] / held[i].sum()),
            "spans": [{"lang": model["langs"][label[a]], "first_word": int(a - begin[i]),
                       "last_word": int(z - begin[i])}
                      for a, z in zip(first[low[i]:high[i]], last[low[i]:high[i]])]})
    return out


_LABEL = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct(
    [("lang", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64())])))])
_LABEL_DDL = ("struct<lang:string,score:double,spans:array<struct<lang:string,first_word:long,"
              "last_word:long>>>")


def labels(text: Column, model: dict, spark) -> Column:
    """struct(lang, score, spans) of a text column."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf(_LABEL_DDL)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts, out, at = batch.to_pylist(), [], 0
            while at < len(texts):
                stop, chars = at, 0
                while stop < len(texts) and (stop == at or chars + len(texts[stop] or "") <= RUN_CHARS):
                    chars += len(texts[stop] or "")
                    stop += 1
                out += label_texts(sent.value, texts[at:stop])
                at = stop
            yield pa.array(out, type=_LABEL)

    return run(text.cast("string"))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> dict:
    """The model of all documents that are not held out."""
    return learn(docs.filter(crc32_mod(F.col(id_col), FOLDS) != HELD_OUT), text_col, lang_col,
                 id_col=id_col)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score, spans.

    lang_pred is the language that Viterbi gives the most letters, score its share of the
    letters; ``und`` with score 0 where the text is null or has no letter, or where no labelled
    document could be learned from. Rows without an id are not held out. Ties go to the first
    language by code point; rows that repeat give equal rows; an empty table gives none.
    """
    model = fit(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_t"),
                       (crc32_mod(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"))
    return rows.withColumn("_l", _label_or_none(model, docs)).select(
        id_col, "held_out", F.col("_l.lang").alias("lang_pred"), F.col("_l.score").alias("score"),
        F.col("_l.spans").alias("spans"))


def _label_or_none(model: dict, docs: DataFrame, text: str = "_t") -> Column:
    if not model:
        none = f"named_struct('lang', '{UNKNOWN}', 'score', 0.0D, 'spans', array())"
        return F.expr(none).cast(_LABEL_DDL)
    return labels(F.col(text), model, docs.sparkSession)


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The documents that have a language; those labelled ``und`` go. All columns are kept,
    whatever their names."""
    model = fit(docs, id_col, text_col, lang_col)
    rows = docs.select(whole_row(docs), F.col(text_col).cast("string").alias("_t"))
    kept = rows.withColumn("_label", _label_or_none(model, docs))
    return kept.filter(F.col("_label.lang") != UNKNOWN).select("_row.*")

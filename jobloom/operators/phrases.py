"""Phrase matching against a vocabulary table of any size.

Word sequences of the texts are joined to the phrases, so the vocabulary may be as large
as a table. For a vocabulary that fits in code use ``functions.skills`` instead: it needs
no join at all. Both give the same pairs, under either rule for symbols at a phrase's edge.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.functions.skills import PHRASES_PER_PATTERN, WORD, _tree_pattern, fold
from jobloom.functions.text import _col
from jobloom.session import checkpoint

# The vocabulary filter takes up to two to this power bits: 2 MiB.
MOST_BITS = 24

_SYMBOL = r"[^\p{L}\p{N}_]"
_GAP = _SYMBOL + "+"


Shape = tuple[int, int, int]  # words, symbols before, symbols behind


def _sequence_pattern(words: int, lead: int, trail: int, symbol_safe: bool,
                      heads: list[str] | None = None) -> str:
    """``words`` words with the gaps between them, tried at every place of the text.

    A phrase that starts or ends with a symbol must have a word character beyond it, so
    its symbols fill the whole gap beside the word: ``lead`` and ``trail`` take that gap in.
    With ``symbol_safe`` they are as many symbols as the phrase has there, with no word
    character beyond them. ``heads``: the folded words that may stand first, if not all may.
    A sequence that starts with a word is looked for at the starts of words only.
    """
    body = "(?:" + _GAP + WORD + "+){%d}" % (words - 1) if words > 1 else ""
    first = "" if heads is None or not words else f"(?=(?iu:{_tree_pattern(heads, True)}))"
    core = first + WORD + "+" + body if words else ""
    past = "" if lead or not words else WORD + "+"
    if symbol_safe:
        start, end = (f"{_SYMBOL}{{{n}}}" if n else "" for n in (lead, trail))
        return f"(?<!{WORD})(?=({start}{core}{end})(?!{WORD})){past}"
    before = f"(?<={WORD})" if lead else f"(?<!{WORD})"
    after = f"(?={WORD})" if trail else f"(?!{WORD})"
    if not words:
        return f"(?<={WORD})(?=({_GAP})(?={WORD}))"
    start, end = (_GAP if lead else ""), (_GAP if trail else "")
    return f"{before}(?=({start}{core}{end}){after}){past}"


def _shape(phrase: Column, symbol_safe: bool) -> list[Column]:
    """Words, and symbols before and behind them (1 or 0 where their number plays no part)."""
    words = F.size(F.regexp_extract_all(phrase, F.lit(f"({WORD}+)"), F.lit(1)))
    lead = F.length(F.regexp_extract(phrase, f"^{_SYMBOL}*", 0))
    trail = F.when(words == 0, 0).otherwise(F.length(F.regexp_extract(phrase, f"{_SYMBOL}*$", 0)))
    if not symbol_safe:
        lead, trail = (F.least(n, F.lit(1)) for n in (lead, trail))
    return [words.alias("words"), lead.alias("lead"), trail.alias("trail")]


def word_sequences(text: Column, shapes: list[Shape], symbol_safe: bool = False,
                   heads: Mapping[Shape, list[str]] | None = None) -> Column:
    """The distinct sequences of every shape in a text, as written but case folded; with
    ``heads``, those that start with one of the words given for their shape."""
    found = [F.regexp_extract_all(text, F.lit(_sequence_pattern(
        *shape, symbol_safe, heads and heads[shape])), F.lit(1)) for shape in shapes]
    return F.array_distinct(F.transform(F.concat(*found), fold))


def _heads(entries: DataFrame, symbol_safe: bool) -> dict[Shape, list[str]] | None:
    """First words of the phrases of each shape; None where they are too many for a pattern."""
    word = F.regexp_extract("phrase", f"({WORD}+)", 1).alias("head")
    rows = entries.select(*_shape(F.col("phrase"), symbol_safe), word).distinct().limit(
        PHRASES_PER_PATTERN + 1).collect()
    if len(rows) > PHRASES_PER_PATTERN:
        return None
    found = defaultdict(list)
    for *shape, head in rows:
        found[tuple(shape)].append(head)
    return found


def _known_bits(entries: DataFrame, bits: int) -> DataFrame:
    """One row: which of ``bits`` hash values occur among the phrases, 64 to a number."""
    at = entries.select(F.pmod(F.xxhash64("phrase"), F.lit(bits)).alias("h")).select(
        F.floor(F.col("h") / 64).alias("word"), F.expr("shiftleft(1L, cast(h % 64 as int))").alias("bit"))
    words = at.groupBy("word").agg(F.bit_or("bit").alias("w"))
    every = entries.sparkSession.range(bits // 64).withColumnRenamed("id", "word")
    listed = F.array_sort(F.collect_list(F.struct(
        "word", F.coalesce("w", F.lit(0).cast("long")).alias("w"))))
    return every.join(words, "word", "left").agg(F.transform(listed, lambda s: s["w"]).alias("bits"))


def match_phrases(df: DataFrame, key: str, text: Column | str,
                  vocabulary: DataFrame, symbol_safe: bool = False) -> DataFrame:
    """Unique (key, skill) rows for a vocabulary of (phrase, skill) rows; ``symbol_safe`` as in
    ``extract_skills``.

    Only sequences shaped like some phrase are taken out of the texts, each once per text. While
    the phrases have at most PHRASES_PER_PATTERN first words, only sequences that start with
    one of these are; in any case, only those whose hash some phrase has leave their task: the filter has 16 bits a phrase (at
    most MOST_BITS, past which it lets more through, never less). What is left of a word that
    stands in most texts is split at run time, as in any join of uneven keys.
    """
    entries = checkpoint(vocabulary.select(fold(F.trim("phrase")).alias("phrase"), "skill").filter(
        "phrase <> ''").dropDuplicates())
    # One row per shape: the longest phrase has a handful of words.
    shapes = [tuple(r) for r in entries.select(*_shape(F.col("phrase"), symbol_safe)).distinct().collect()]
    if not shapes:
        return df.select(key, F.lit("").alias("skill")).filter("false")
    bits = 1 << min(MOST_BITS, max(10, (16 * entries.count()).bit_length()))
    place = F.pmod(F.xxhash64("phrase"), F.lit(bits))
    known = F.get(_known_bits(entries, bits).scalar(), F.floor(place / 64).cast("int"))
    runs = df.select(key, F.explode(word_sequences(
        _col(text), sorted(shapes), symbol_safe, _heads(entries, symbol_safe))).alias("phrase"))
    near = runs.filter(F.getbit(known, F.pmod(place, F.lit(64)).cast("int")) == 1)
    return near.join(entries, "phrase").select(key, "skill").dropDuplicates([key, "skill"])

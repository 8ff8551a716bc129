"""Whole-phrase skill matching as one narrow column expression.

All phrases go into one regular expression shaped like a prefix tree, tried at every
position inside a look-ahead, so overlapping phrases are all found and a row needs one
pass whatever the size of the vocabulary. At each position only the longest phrase is
captured; the shorter ones that also match there are prefixes of it, known beforehand.
There is no explode, no join and no shuffle.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from jobloom.functions.text import _col
from jobloom.functions.vocabulary import SKILL_STOPWORDS, default_vocabulary, phrase_rows

WORD = r"[\p{L}\p{N}_]"

# One expression holds at most this many phrases; a larger vocabulary becomes several.
PHRASES_PER_PATTERN = 2000

# Characters outside ASCII that a case-blind match accepts for i, s and k.
_FOLD_FROM, _FOLD_TO = "İıſK", "iisk"


def fold(c: Column) -> Column:
    """Lower case, with the letters a case-blind match treats as i, s and k made plain."""
    return F.lower(F.translate(c, _FOLD_FROM, _FOLD_TO))


def fold_text(s: str) -> str:
    return s.translate(str.maketrans(_FOLD_FROM, _FOLD_TO)).lower()


def _is_word(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


def _edge(ch: str, symbol_safe: bool, behind: bool) -> str:
    """Boundary beside ``ch``: it must differ in kind from its neighbour outside the phrase.

    A phrase edge that is a symbol therefore needs a word character next to it; with
    ``symbol_safe`` it only must not touch one.
    """
    differs = _is_word(ch) or symbol_safe
    kind = ("<" if behind else "") + ("!" if differs else "=")
    return f"(?{kind}{WORD})"


def _tree_pattern(phrases: Iterable[str], symbol_safe: bool) -> str:
    """Alternation of phrases with shared prefixes; a longer phrase is tried first."""

    def build(items: list[str], depth: int) -> str:
        branches: dict[str, list[str]] = defaultdict(list)
        ends = ""
        for p in items:
            if len(p) == depth:
                ends = _edge(p[-1], symbol_safe, behind=False)
            else:
                branches[p[depth]].append(p)
        options = []
        for ch in sorted(branches):
            lit = re.escape(ch) if not _is_word(ch) else ch
            options.append(lit + build(branches[ch], depth + 1))
        if ends:
            options.append(ends)
        return options[0] if len(options) == 1 else "(?:" + "|".join(options) + ")"

    return build(sorted(set(phrases)), 0)


def _pattern(phrases: list[str], symbol_safe: bool) -> str:
    groups: dict[str, list[str]] = defaultdict(list)
    for p in phrases:
        groups[_edge(p[0], symbol_safe, behind=True)].append(p)
    starts = [
        f"{before}(?=({_tree_pattern(ps, symbol_safe)}))" for before, ps in sorted(groups.items())
    ]
    return "(?iu)(?:" + "|".join(starts) + ")"


def _implied(phrase: str, phrases: set[str], symbol_safe: bool) -> list[str]:
    """The phrases that match at the same start whenever ``phrase`` does."""
    found = [phrase]
    for n in range(1, len(phrase)):
        head = phrase[:n]
        if head in phrases:
            differs = _is_word(head[-1]) or symbol_safe
            if differs != _is_word(phrase[n]):
                found.append(head)
    return found


def _matches(text: Column, phrases: list[str], symbol_safe: bool) -> Column:
    """Skill-lookup keys found in ``text``: the longest phrase at every start."""
    groups = {_edge(p[0], symbol_safe, behind=True) for p in phrases}
    pattern = F.lit(_pattern(phrases, symbol_safe))
    found = [F.regexp_extract_all(text, pattern, F.lit(i + 1)) for i in range(len(groups))]
    return F.concat(*found) if len(found) > 1 else found[0]


# Separators inside the one literal that carries the phrase -> skills table; a single
# literal keeps the plan small, and Spark turns it into a map once.
_ENTRY, _KEY, _ITEM = "\u0001", "\u0002", "\u0003"


def _skills_of(table: dict[str, list[str]]):
    text = _ENTRY.join(k + _KEY + _ITEM.join(v) for k, v in table.items())
    lookup = F.str_to_map(F.lit(text), F.lit(_ENTRY), F.lit(_KEY))
    return lambda phrase: F.split(lookup[phrase], _ITEM)


def extract_skills(
    text: Column | str,
    vocabulary: Mapping[str, Iterable[str]] | None = None,
    stopwords: Iterable[str] = SKILL_STOPWORDS,
    symbol_safe: bool = False,
) -> Column:
    """Sorted unique canonical skills found in ``text``; ``[]`` for null or empty text."""
    rows = phrase_rows(vocabulary or default_vocabulary(), stopwords)
    by_phrase: dict[str, set[str]] = defaultdict(set)
    for phrase, skill in rows:
        if phrase:
            by_phrase[fold_text(phrase)].add(skill)
    names = sorted(by_phrase)
    c = F.coalesce(_col(text), F.lit(""))
    parts = []
    for at in range(0, len(names), PHRASES_PER_PATTERN):
        chunk = names[at:at + PHRASES_PER_PATTERN]
        known = set(chunk)
        table = {p: sorted({s for q in _implied(p, known, symbol_safe) for s in by_phrase[q]})
                 for p in chunk}
        hits = F.transform(F.array_distinct(_matches(c, chunk, symbol_safe)), fold)
        hits = F.filter(hits, lambda h: h != "")
        parts.append(F.flatten(F.transform(hits, _skills_of(table))))
    if not parts:
        return F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.concat(*parts)))

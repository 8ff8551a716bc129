"""Text columns: trimming, collapsing, cleanup, joining and structure checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Unicode white space plus the four ASCII separators Python also strips.
_WS = r"[\s\x1c-\x1f]"
_NON_WS = r"[^\s\x1c-\x1f]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind (``trim`` drops spaces only).

    The look-behind tries each inner run of white space once, not from all of its places.
    """
    return F.regexp_replace(_col(c), rf"(?U)^{_WS}+|(?<!{_WS}){_WS}+\z", "")


def collapse(c: Column | str) -> Column:
    """Turn every run of white space into one space."""
    return F.regexp_replace(_col(c), rf"(?U){_WS}+", " ")


def clean_title(c: Column | str) -> Column:
    return F.lower(F.trim(_col(c)))


def clean_description(c: Column | str) -> Column:
    """Lower-case and collapse ASCII white space; the ends are not trimmed."""
    return F.regexp_replace(F.lower(_col(c)), r"\s+", " ")


def normalize_text(c: Column | str) -> Column:
    return F.coalesce(F.lower(collapse(strip(c))), F.lit(""))


def clean_job_description(c: Column | str) -> Column:
    """Blank out tags, then links, then e-mail addresses; collapse, strip, lower.

    Two things keep the scan linear on any text. No tag can start after the last ``>``, so
    that part is set aside. And an address is tried only at the start of a run of
    non-space characters: a run matches from its start or not at all.
    """
    rest = F.substring_index(_col(c), ">", -1)
    tagged = F.left(_col(c), F.length(_col(c)) - F.length(rest))
    out = F.concat(F.regexp_replace(tagged, r"<[^>]+>", " "), rest)
    out = F.regexp_replace(out, rf"(?U)http{_NON_WS}+|www\.{_NON_WS}+", " ")
    out = F.regexp_replace(out, rf"(?U)(?<!{_NON_WS}){_NON_WS}+@{_NON_WS}+", " ")
    return F.coalesce(F.lower(strip(collapse(out))), F.lit(""))


def join_text(title: Column | str, description: Column | str, sep: str) -> Column:
    """``title + sep + description`` with nulls as empty text; the separator always stays."""
    return F.concat(
        F.coalesce(_col(title), F.lit("")), F.lit(sep), F.coalesce(_col(description), F.lit(""))
    )


def skill_text(title="title", description="description") -> Column:
    return join_text(title, description, ". ")


def vector_text(title="title", description="description") -> Column:
    return join_text(title, description, " | ")


def duplicate_key(*cols: Column | str) -> Column:
    """Hash of the business key. Nulls are skipped, so they leave no separator behind."""
    return F.sha2(F.concat_ws("||", *[_col(c) for c in cols]), 256)


def clean_question(c: Column | str) -> Column:
    """Stripped question, or null when nothing usable is left."""
    s = strip(_col(c).cast("string"))
    return F.when((s != "") & (s != "nan"), s)


def is_technical(topic: Column | str) -> Column:
    return F.coalesce(_col(topic).ilike("%tech%"), F.lit(False))


def default_topic(topic: Column | str, default: str = "technical") -> Column:
    return F.coalesce(_col(topic), F.lit(default))


# The two sentences that are embedded for a profile.
JOB_QUERY = "Target role: %s. Current skills: %s"
QUESTION_QUERY = "Technical interview questions for %s. Candidate skills: %s"


def _filled(sentence: str, *parts: Column | str) -> Column:
    """The sentence with its parts; a missing part leaves its place empty."""
    return F.format_string(sentence, *[F.coalesce(_col(p), F.lit("")) for p in parts])


def job_query_text(role: Column | str, skills: Column | str) -> Column:
    return _filled(JOB_QUERY, role, skills)


def question_query_text(role: Column | str, skills: Column | str) -> Column:
    return _filled(QUESTION_QUERY, role, skills)


def word_count(c: Column | str) -> Column:
    """Number of white-space separated words."""
    return F.size(F.filter(F.split(_col(c), rf"(?U){_WS}+"), lambda w: w != ""))


def line_count(c: Column | str) -> Column:
    return F.size(F.split(_col(c), "\n"))


def mentions_any(c: Column | str, phrases: Sequence[str]) -> Column:
    low = F.lower(_col(c))
    out = F.lit(False)
    for phrase in phrases:
        out = out | low.contains(phrase)
    return out


def mentions_all(c: Column | str, phrases: Sequence[str]) -> Column:
    low = F.lower(_col(c))
    out = F.lit(True)
    for phrase in phrases:
        out = out & low.contains(phrase)
    return out

"""Skill lists held as arrays in one row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobloom.functions.text import _col, strip


def split_skills(c: Column | str) -> Column:
    """``"a, b,,"`` to ``["a", "b"]``."""
    parts = F.split(F.coalesce(_col(c), F.lit("")), ",")
    return stripped(parts)


def stripped(items: Column | str) -> Column:
    """Strip each item and drop blank or null ones; order and repeats stay."""
    return F.filter(F.transform(_col(items), strip), lambda s: s != "")


def deduplicate_skills(items: Column | str) -> Column:
    """Lower-cased, stripped, unique, sorted; blanks dropped."""
    low = F.transform(_col(items), lambda s: strip(F.lower(s)))
    return F.array_sort(F.array_distinct(F.filter(low, lambda s: s != "")))


def bind(values: dict[str, Column], use) -> Column:
    """``use`` applied to a struct of ``values`` that are computed once.

    Inside a lambda Spark evaluates an outer expression again for every element; a field
    of a lambda variable is a value already at hand.
    """
    packed = F.struct(*[v.alias(n) for n, v in values.items()])
    return F.transform(F.array(packed), use)[0]


def skill_gap(user: Column | str, target: Column | str) -> Column:
    """Target skills the user lacks, in target order, spelling and repeats kept."""
    def plain(items):
        return F.transform(_col(items), lambda s: F.lower(strip(s)))

    def lacking(z: Column) -> Column:
        both = F.zip_with(z["target"], z["plain"], lambda s, p: F.when(
            (p != "") & ~F.array_contains(z["known"], p), s))
        return F.filter(both, lambda s: s.isNotNull())

    values = {"known": plain(user), "target": _col(target), "plain": plain(target)}
    return bind(values, lacking)


def overlap_counts(truth: Column | str, predicted: Column | str, ignore_case: bool = False):
    """(true positives, false positives, false negatives) of two skill lists as sets."""
    t, p = (F.coalesce(_col(c), F.array().cast("array<string>")) for c in (truth, predicted))
    if ignore_case:
        t, p = F.transform(t, F.lower), F.transform(p, F.lower)
    return (
        F.size(F.array_intersect(t, p)),
        F.size(F.array_except(p, t)),
        F.size(F.array_except(t, p)),
    )

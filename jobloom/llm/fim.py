"""Fill-in-the-middle: texts cut at two units and put together again with sentinels.

The units of a text (white space and the word behind it; white space at the end is a unit of its
own) are the nodes of an indexable skip list. Every link of a lane carries how many units and how
many code points it passes, so the two cut ranks are reached by descending from the widest lane,
adding up both widths; the units in between are never walked one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from jobloom.llm.perfect import mix
from jobloom.llm.words import known

SEED = 42
RATE = 50        # percent of texts that are cut
SPM = 80         # percent of those that begin with their suffix
LANE_BITS = 2    # a node of one lane stands in the next with probability 1 / 2**LANE_BITS

# The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINEL = "<[PSM]>"


def unit_ends(text: str) -> np.ndarray:
    """Code-point position behind each unit."""
    if text.isascii():
        points = np.frombuffer(text.encode(), np.uint8)
    else:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    space = (points == 32) | ((points >= 9) & (points <= 13))
    last = ~space
    last[:-1] &= space[1:]
    last[-1:] = True
    return np.flatnonzero(last) + 1


class SkipList:
    """Units and code points passed by the links of each lane, widest lane last.

    Which nodes stand in the express lanes is drawn by a hash of their rank; ``find`` gives the
    same place whatever is drawn.
    """

    def __init__(self, ends: np.ndarray):
        draw = mix(np.arange(len(ends)), SEED)
        ranks, places = np.arange(1, len(ends) + 1), ends
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        below, bits = np.zeros(0, np.int64), 0
        while len(ranks):
            self.lanes.append((np.diff(ranks, prepend=0), np.diff(places, prepend=0), below))
            bits += LANE_BITS
            below = np.flatnonzero(draw[ranks - 1] & np.uint64((1 << bits) - 1) == 0)
            ranks, places = ranks[below], places[below]

    def find(self, rank: int) -> int:
        """Code points before the unit of this rank; of all units for their number."""
        units = points = 0
        at = -1  # the head of the lane
        for unit_width, point_width, below in reversed(self.lanes):
            while at + 1 < len(unit_width) and units + unit_width[at + 1] <= rank:
                at += 1
                units += int(unit_width[at])
                points += int(point_width[at])
            if len(below) and at >= 0:
                at = int(below[at])
        return points


def draws(seed: int, key: int | str | None) -> list[int]:
    """Four seeded numbers of a key; a null key is written as nothing."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def cut(text: str, key: int | str | None, seed: int = SEED, rate: int = RATE,
        spm: int = SPM) -> tuple[int, str, int | None, int | None, str]:
    """Number of units, form, code points of prefix and middle, and the text put together."""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(seed, key)
    if not text or h3 % 100 >= rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    units = SkipList(ends)
    a, z = (units.find(rank) for rank in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:z], text[z:]
    if h4 % 100 < spm:
        return n, "spm", a, z - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", a, z - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def restored(output: Column, form: Column) -> Column:
    """The text before it was cut, from the output and its form alone."""
    part = F.split(output, SENTINEL)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """Per row: the id, n, form (plain, psm, spm), prefix_chars, middle_chars, output.

    Null counts as empty; empty texts and texts that hold a sentinel stay plain. What is drawn
    depends on seed and id alone: rows that repeat an id are cut by the same draws, and rows
    without an id share those of the empty id. Other columns are not carried. One text is in
    work at a time, whole, with some 50 bytes for each of its code points.
    """
    kind = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                      ("middle_chars", pa.int64()), ("output", pa.string())])

    @F.arrow_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for keys, texts in batches:
            rows = [cut(t.as_py(), k.as_py(), seed, rate, spm) for k, t in zip(keys, texts)]
            yield pa.array([dict(zip(kind.names, row)) for row in rows], kind)

    cells = docs.select(F.col(id_col).alias(id_col), known(F.col(text_col)).alias("_text"))
    return cells.select(id_col, run(F.col(id_col), "_text").alias("_cut")).select(id_col, "_cut.*")


def middle_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of the outputs, and of the texts rebuilt from output and form."""
    made = fill_in_middle(docs, id_col, text_col)
    return made.select(
        id_col, "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t,
           sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), u AS (
    SELECT *, regexp_extract_all(
                  t, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units,
           ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
           ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
    FROM d
), c AS (
    SELECT doc_id, t, len(units) AS n, least(h1 % (n + 1), h2 % (n + 1)) AS a,
           greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                     OR h3 % 100 >= 50 THEN 'plain'
                WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:z], '') AS m,
           array_to_string(units[z + 1:], '') AS s
    FROM u
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""

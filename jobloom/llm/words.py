"""Text columns shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The two word classes and the letters that are lower-cased.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# The same lower-casing for Python strings.
TO_LOWER = str.maketrans(UPPER, LOWER)


def known(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character left alone.

    Plain ASCII texts take the JVM's byte path; ``translate`` walks the others by character.
    """
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def words(text: Column, pattern: str = ALNUM_WORD) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def word_count(text: Column, pattern: str = SPACED_WORD) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def crc32_mod(value: Column, mod: int) -> Column:
    """crc32 of the value written as text, modulo ``mod``; -1 for null."""
    return F.coalesce(F.pmod(F.crc32(F.encode(value.cast("string"), "UTF-8")), F.lit(mod)),
                      F.lit(-1)).cast("int")


def whole_row(df: DataFrame) -> Column:
    """All columns as one, ``_row``: no other column can then clash with the caller's names."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias("_row")


# Facts about keys that hold more than 1 / HOT_SHARE of all rows, fewer than HOT_SHARE of them.
HOT_SHARE = 1000


def attached(rows: DataFrame, facts: DataFrame, key: list[str], n: str, total: int) -> DataFrame:
    """The rows with the facts of their key; ``n`` is how many of the ``total`` rows have it.

    A key that many rows have meets its facts through a broadcast of fewer than HOT_SHARE rows;
    every other one in a join, in which the rows of the former are spread evenly. Keys are
    never null, and every one has facts; ``facts`` are read twice.
    """
    names = [c for c in facts.columns if c not in key]
    is_hot = F.col(n) * HOT_SHARE > total
    hot = facts.filter(is_hot).select(*key, F.struct(*names).alias("_hot"))
    cold = facts.filter(~is_hot).select(*key, F.lit(0).alias("_spread"), F.struct(*names).alias("_cold"))
    spread = F.when(F.col("_hot").isNull(), 0).otherwise(
        1 + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 16))).cast("int")
    met = rows.join(F.broadcast(hot), key, "left").withColumn("_spread", spread).join(
        cold, [*key, "_spread"], "left")
    return met.select(*rows.columns, F.coalesce("_hot", "_cold").alias("_facts")).select(
        *rows.columns, "_facts.*")

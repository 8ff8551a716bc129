"""Exact duplicates, combined in three content-comparing steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobloom.llm.words import ascii_lower, attached, known
from jobloom.session import checkpoint

# Groups of tasks whose winners meet first. They act from two tasks on.
SALTS = 8


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct text: text_sha256, _size (bytes), _more (a second hash), keep_id
    (largest id), group_size.

    Every step groups by the whole normalised text beside its digest, so equality never rests
    on a digest alone:

    1. inside each task, before the shuffle (partial aggregation), copies fold into one row;
    2. the winners of every ``SALTS``-th task meet under (digest, salt, text);
    3. the winners of the salts meet under (digest, text).

    A text that fills a third of the table sends one row per task into step 2 and one row per
    salt into step 3.
    """
    norm = ascii_lower(known(F.col(text_col)))
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    rows = docs.select(F.col(id_col).alias("_id"), norm.alias("_norm")).select(
        "_id", "_norm", F.sha2("_norm", 256).alias("text_sha256"), salt.alias("_salt"))
    salted = rows.groupBy("text_sha256", "_salt", "_norm").agg(
        F.max("_id").alias("_id"), F.count("*").alias("_n"))
    whole = salted.groupBy("text_sha256", "_norm").agg(
        F.max("_id").alias("keep_id"), F.sum("_n").alias("group_size"))
    return whole.select("text_sha256", F.octet_length("_norm").alias("_size"),
                        F.xxhash64("_norm").alias("_more"), "keep_id", "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with
    the largest id stays. Rows that repeat an id and a text are members of the group like any
    other and are all ``kept`` when theirs is the largest id. A null id is never kept unless
    every id of its group is null; then keep_id is null and all of them are kept. An empty
    table gives no rows; other columns are ignored. Rows find their group by two digests and
    the length of their text.
    """
    norm = ascii_lower(known(F.col(text_col)))
    rows = docs.select(F.col(id_col), norm.alias("_norm")).select(
        id_col, F.sha2("_norm", 256).alias("text_sha256"), F.octet_length("_norm").alias("_size"),
        F.xxhash64("_norm").alias("_more"))
    groups = checkpoint(content_groups(docs, id_col, text_col))
    total = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    joined = attached(rows, groups, ["text_sha256", "_size", "_more"], "group_size", total)
    return joined.select(
        id_col, "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without their exact copies, all columns kept.

    The ids of the rows that stay come from ``exact_dedup``. Rows that repeat the surviving id
    and text all match it; give such tables a unique id first.
    """
    stay = exact_dedup(docs, id_col, text_col).filter("kept").select(
        F.col(id_col).alias("_keep"), F.col("text_sha256").alias("_sha")).distinct()
    digest = F.sha2(ascii_lower(known(F.col(text_col))), 256)
    return docs.join(stay, F.col(id_col).eqNullSafe(F.col("_keep")) & (digest == F.col("_sha")),
                     "left_semi")


SQL = """
with n as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') as t from documents
), g as (
  select doc_id, t, max(doc_id) over (partition by t) as keep_id,
         count(*) over (partition by t) as group_size from n
)
select doc_id, keep_id, cast(group_size as bigint) as group_size,
       doc_id is not distinct from keep_id as kept, sha256(t) as text_sha256 from g
"""

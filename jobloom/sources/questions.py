"""Question files: CSV in mixed encodings and headers, numbered and tabbed lists, snapshots."""

from __future__ import annotations

import csv
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from jobloom.functions.text import collapse, default_topic, strip
from jobloom.schemas import QUESTION_SNAPSHOT
from jobloom.session import checkpoint

# Header names of a question column, the first one that occurs wins.
QUESTION_NAMES = ("question", "questions", "interview_question")

# Cell texts that count as missing.
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Where a row stands: file, then split, then line order inside the split.
ROW_ORDER = ("source", "block", "line")


def row_order() -> list[Column]:
    return [F.col(c).asc() for c in ROW_ORDER]


def _survey(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Per file: header line (the first that is not blank), whether all bytes are UTF-8, whether a quoted cell spans lines,
    whether a line may hold more cells than the header, whether some line is white space.

    Files are scanned in splits like any text, so a huge file is not one task.
    """
    lines = spark.read.text(root, pathGlobFilter=pattern).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("source"),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("line")).alias("at"),
        "value",
    )
    shown = F.trim(F.regexp_replace("value", "^\uFEFF", "")) != ""
    at = F.when(shown, F.col("at"))

    def occurs(mark: str) -> Column:
        return F.length("value") - F.length(F.replace(F.col("value"), F.lit(mark), F.lit("")))

    found = lines.groupBy("path", "source").agg(
        F.min_by("value", at).alias("header"),
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.bool_or(occurs('"') % 2 != 0).alias("spans"),
        F.max(occurs(",")).alias("commas"),
        F.min_by(occurs(","), at).alias("header_commas"),
        F.bool_or(~shown & (F.col("value") != "")).alias("padded"),
    ).filter(F.col("header").isNotNull())
    wide = (F.col("commas") > F.col("header_commas")) | F.col("spans")
    return found.select("path", "source", "header", "utf8", "spans", wide.alias("wide"), "padded")


def _header_names(line: str) -> list[str]:
    cells = next(csv.reader([line.lstrip("﻿")]), [])
    return [c.lower().strip() for c in cells]


def pick_question_column(names: Sequence[str],
                         candidates: Sequence[str] = QUESTION_NAMES) -> int | None:
    """Place of the first candidate among normalised header names."""
    for candidate in candidates:
        if candidate in names:
            return list(names).index(candidate)
    return None


def _cell(c: Column) -> Column:
    return F.when(c.isin(*MISSING_CELLS), F.lit(None)).otherwise(c)


def _read_cells(spark: SparkSession, root: str, kind: tuple[bool, bool], cells: int) -> DataFrame:
    """The rows of a folder's CSV files as text columns c0, c1, ..., with one to spare."""
    utf8, spans = kind
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(cells + 1)])
    return (
        spark.read.schema(schema)
        .option("header", True).option("enforceSchema", True)
        .option("quote", '"').option("escape", '"').option("multiLine", spans)
        .option("encoding", "UTF-8" if utf8 else "ISO-8859-1")
        .option("pathGlobFilter", "*.csv").csv(root)
    )


def read_question_csvs(spark: SparkSession, root: str, skip_name: str = "behavioral",
                       candidates: Sequence[str] = QUESTION_NAMES,
                       topic: str = "technical") -> DataFrame:
    """All CSV files of a folder as (question, topic, source) with the row's place.

    A survey gives each file's layout: encoding, whether quoted cells run over line ends, the
    places of question and topic. There are four ways to parse at most; each parses the folder
    once and keeps the files it is meant for by a join with the layouts (a row per file), where
    the cells are picked by place. Files whose quoted cells run over line ends are read as one
    piece, as the format demands; all others are split. A file with a row of more cells than
    its header cannot be read: it is skipped with a warning.
    """
    survey = checkpoint(_survey(spark, root, "*.csv").filter(
        ~F.lower("source").contains(skip_name)))
    layouts = []
    # One row per distinct header, not per file or line.
    for r in survey.groupBy("header").agg(
            F.count("*").alias("files"), F.min("source").alias("first")).collect():
        names = _header_names(r["header"])
        at = pick_question_column(names, candidates)
        if at is None:
            warnings.warn(f"no question column in {r['files']} files such as {r['first']}, skipped")
        else:
            layouts.append((r["header"], at, names.index("topic") if "topic" in names else None,
                            len(names), names))
    if not layouts:
        raise FileNotFoundError(f"no usable question file under {root}")
    most = max(n for *_, n, _ in layouts)
    files = survey.join(spark.createDataFrame(
        layouts, "header string, q int, t int, cells int, names array<string>"), "header").select(
        "path", "utf8", "spans", "wide", "padded", "q", "t", "cells", "names")
    frames = []
    for kind in sorted({(r.utf8, r.spans) for r in files.select("utf8", "spans").distinct().collect()}):
        mine = files.filter((F.col("utf8") == kind[0]) & (F.col("spans") == kind[1])).drop(
            "utf8", "spans")
        cells = F.array(*[F.col(f"c{i}") for i in range(most + 1)])
        raw = _read_cells(spark, root, kind, most).select(
            F.col("_metadata.file_path").alias("path"), cells.alias("c"),
            F.col("_metadata.file_name").alias("source"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line")).join(mine, "path")
        if kind[1]:
            # A file read in one piece takes a line of white space for its header.
            own = F.transform(F.slice("c", F.lit(1), F.col("cells")), lambda x: F.lower(F.trim(x)))
            raw = raw.filter(~(F.col("padded") & F.coalesce(own == F.col("names"), F.lit(False))))
        if not mine.filter("wide").isEmpty():
            over = checkpoint(raw.filter(F.col("wide") & F.get("c", F.col("cells")).isNotNull())
                              .groupBy("path").agg(F.min("source").alias("first")))
            bad = over.agg(F.count("*").alias("files"), F.min("first").alias("first")).first()
            if bad["files"]:
                warnings.warn(f"rows with too many cells in {bad['files']} files such as "
                              f"{bad['first']}, skipped")
            raw = raw.join(over.select("path"), "path", "left_anti")
        frames.append(raw.select(
            _cell(F.get("c", F.col("q"))).alias("question"),
            default_topic(_cell(F.get("c", F.col("t"))), topic).alias("topic"),
            "source", "block", "line"))
    return union_sources(frames)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def numbered_question(line: Column | str) -> Column:
    """The text after ``N.``; null for a line without a number."""
    c = F.col(line) if isinstance(line, str) else line
    return F.when(c.rlike(r"^\s*\d+\."), strip(F.regexp_extract(c, r"^\s*\d+\.\s*(.*)$", 1)))


def read_numbered_text(spark: SparkSession, path: str, topic: str = "technical") -> DataFrame:
    lines = spark.read.text(path)
    return lines.select(
        numbered_question("value").alias("question"), F.lit(topic).alias("topic"),
        F.col("_metadata.file_name").alias("source"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ).filter("question is not null")


def read_tabbed_text(spark: SparkSession, path: str, topic: str = "technical") -> DataFrame:
    """Tab-separated number and question, with a header line."""
    rows = spark.read.csv(path, sep="\t", header=True, schema="number string, question string")
    return rows.select(
        "question", F.lit(topic).alias("topic"),
        F.col("_metadata.file_name").alias("source"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def list_items(html: Column | str) -> Column:
    """The texts of the list items of a page, without tags; blank ones dropped. An item
    ends at its closing tag, or where the next item or the list's end begins."""
    c = F.col(html) if isinstance(html, str) else html
    parts = F.split(c, r"(?i)<li\b[^>]*>")
    inner = F.transform(F.slice(parts, 2, F.size(parts)),
                        lambda p: F.split(p, r"(?i)</?(?:li|ul|ol)\b", 2)[0])
    plain = F.transform(inner, lambda p: strip(collapse(F.regexp_replace(p, r"<[^>]+>", " "))))
    return F.filter(plain, lambda p: p != "")


def read_html_lists(spark: SparkSession, path: str, topic: str = "technical") -> DataFrame:
    """The list items of HTML files, one page per file."""
    pages = spark.read.text(path, wholetext=True)
    return pages.select(
        F.posexplode(list_items("value")).alias("line", "question"), F.lit(topic).alias("topic"),
        F.col("_metadata.file_name").alias("source"), F.lit(0).alias("block"),
    ).select("question", "topic", "source", "block", "line")


def read_snapshots(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All JSON-line snapshots, with the load time from the name of each file (or of the
    folder, when a snapshot was written in several parts)."""
    name = F.regexp_extract("_metadata.file_path", r"([^/]*\d{8}_\d{6}[^/]*)(?:/part-[^/]*)?$", 1)
    stamp = F.regexp_extract(name, r"(\d{8}_\d{6})", 1)
    return spark.read.schema(QUESTION_SNAPSHOT).json(path).select(
        "*", F.try_to_timestamp(stamp, F.lit("yyyyMMdd_HHmmss")).alias("loaded_at"),
        name.alias("snapshot"))


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """The rows of the newest load; the newest time is one value, found by an aggregate."""
    newest = snapshots.agg(F.max("loaded_at")).scalar()
    return snapshots.filter(F.col("loaded_at") == newest)


def read_latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot, of which alone the files are opened.

    The load time is in the file names, so it is found from the listing; the paths fetched
    are those of one snapshot.
    """
    listed = spark.read.format("binaryFile").load(path).select("path")
    named = listed.select("path", F.regexp_extract(
        "path", r"(\d{8}_\d{6})[^/]*(?:/part-[^/]*)?$", 1).alias("stamp"))
    stamp = F.try_to_timestamp("stamp", F.lit("yyyyMMdd_HHmmss"))
    newest = named.filter(stamp.isNotNull()).agg(F.max("stamp")).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no snapshot with a load time in its name under {path}")
    paths = [r["path"] for r in named.filter(F.col("stamp") == newest).select("path").collect()]
    return read_snapshots(spark, paths)


def read_question_lists(spark: SparkSession, root: str, topic: str = "technical",
                        skip_name: str = "behavioral") -> DataFrame:
    """Text files of a folder as (question, topic, source) with the row's place: numbered lines
    (``N. question``) and tabbed ones (``N<tab>question``); other lines are no questions."""
    line = F.col("value")
    tabbed = F.when(line.rlike(r"^\s*\d+\t"), strip(F.regexp_extract(line, r"^\s*\d+\t(.*)$", 1)))
    return spark.read.text(root, pathGlobFilter="*.{txt,tsv}").select(
        F.coalesce(numbered_question(line), tabbed).alias("question"), F.lit(topic).alias("topic"),
        F.col("_metadata.file_name").alias("source"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ).filter((F.col("question") != "") & ~F.lower("source").contains(skip_name))


def read_question_folder(spark: SparkSession, root: str, skip_name: str = "behavioral",
                         candidates: Sequence[str] = QUESTION_NAMES,
                         topic: str = "technical") -> DataFrame:
    """Everything a question folder may hold: CSV, numbered and tabbed text, HTML lists.

    A folder without a usable file of any kind is an error, as for CSV alone.
    """
    pages = spark.read.text(root, wholetext=True, pathGlobFilter="*.{html,htm}").select(
        F.posexplode(list_items("value")).alias("line", "question"), F.lit(topic).alias("topic"),
        F.col("_metadata.file_name").alias("source"), F.lit(0).cast("long").alias("block"),
    ).filter(~F.lower("source").contains(skip_name))
    frames = [read_question_lists(spark, root, topic, skip_name),
              pages.withColumn("line", F.col("line").cast("long"))]
    try:
        frames.append(read_question_csvs(spark, root, skip_name, candidates, topic))
    except FileNotFoundError:
        if union_sources(frames).isEmpty():
            raise
    return union_sources(frames)

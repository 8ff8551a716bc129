"""Bronze postings to the silver jobs table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobloom.functions.text import clean_description, clean_title
from jobloom.functions.values import mid_salary, posted_timestamp, to_double
from jobloom.operators.dedupe import newest_per_job, newest_posting
from jobloom.operators.quantiles import null_outliers
from jobloom.session import checkpoint, scratch_path

_RENAMED = {"id": "job_id", "latitude": "lat", "longitude": "lon",
            "created": "posted_raw", "redirect_url": "url"}
_NUMBERS = ("latitude", "longitude", "salary_min", "salary_max")


def select_raw(bronze: DataFrame) -> DataFrame:
    """The raw columns under their silver names and types."""
    out = []
    for c in ("id", "title", "company", "location", "latitude", "longitude", "description",
              "category", "salary_min", "salary_max", "created", "redirect_url"):
        value = to_double(c) if c in _NUMBERS else F.col(c).cast("string")
        out.append(value.alias(_RENAMED.get(c, c)))
    return bronze.select(*out)


def with_id(raw: DataFrame) -> DataFrame:
    """Postings without an id are dropped, and so are lines that could not be read."""
    return raw.filter(F.trim("job_id") != "")


def clean_fields(raw: DataFrame) -> DataFrame:
    """All cleaned columns but the description."""
    return raw.withColumns({
        "title": clean_title("title"),
        "company": F.trim("company"),
        "location": F.trim("location"),
        "posted_ts": posted_timestamp("posted_raw"),
        "salary_mid": mid_salary("salary_min", "salary_max"),
    }).withColumn("dt", F.to_date("posted_ts"))


def clean_descriptions(rows: DataFrame) -> DataFrame:
    return rows.withColumn("description", clean_description("description"))


# What the two dedupes decide by, beside the row's place and the text's hash.
_DECIDING = ("job_id", "title", "company", "location", "url", "posted_ts", "salary_mid")


def clean_jobs(bronze: DataFrame, relative_error: float = 0.05,
               known: DataFrame | None = None) -> DataFrame:
    """Clean, keep the newest posting per business key, null salary outliers, keep the
    newest row per job. Outliers are judged between the two dedupes.

    Bronze is read once: the cleaned rows go to shared storage with a number each. Both
    dedupes and the quartiles work on the deciding columns alone, and the rows that remain
    are joined to their texts, which are moved this one time and cleaned only then. Where
    bronze is what has come since the last load, ``known`` holds the silver rows so far, whose
    salaries count for the quartiles as well.
    """
    spark = bronze.sparkSession
    path = scratch_path(spark, "cleaned")
    cleaned = clean_fields(with_id(select_raw(bronze)))
    cleaned.withColumns({"_row": F.monotonically_increasing_id(),
                         "_hash": F.xxhash64("description")}).write.parquet(path)
    rows = spark.read.parquet(path)
    deciding = rows.select("_row", "_hash", *_DECIDING)
    distinct = checkpoint(newest_posting(deciding, F.col("_hash")))
    salaries = distinct.select("salary_mid")
    if known is not None:
        salaries = salaries.union(known.select(mid_salary("salary_min", "salary_max")))
    judged = null_outliers(distinct, "salary_mid", relative_error, source=salaries)
    kept = newest_per_job(judged, F.col("_hash"))
    whole = rows.drop("salary_mid", "_hash").join(kept.select("_row", "salary_mid"), "_row")
    return clean_descriptions(whole.select(*cleaned.columns))

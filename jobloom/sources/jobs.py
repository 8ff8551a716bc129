"""Landing job postings: API pages to bronze JSON lines, and bronze back to a frame."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobloom.operators.dedupe import first_seen
from jobloom.schemas import API_PAGE, BRONZE_JOBS


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed API responses, one JSON document per file, with the file as page name."""
    return spark.read.schema(API_PAGE).json(path, multiLine=True).withColumn(
        "page", F.col("_metadata.file_name"))


def flatten_pages(pages: DataFrame, page: str = "page") -> DataFrame:
    """One row per posting; nested names become flat columns, places are kept."""
    r = F.posexplode("results").alias("position", "r")
    rows = pages.select(page, r)
    nested = {"company": "company.display_name", "location": "location.display_name",
              "category": "category.label"}
    return rows.select(
        page, "position",
        *[F.col(f"r.{nested.get(f.name, f.name)}").cast(f.dataType).alias(f.name)
          for f in BRONZE_JOBS.fields],
    )


def land_jobs(pages: DataFrame, page: str = "page") -> DataFrame:
    """Flat postings, first arrival of each id by page and place."""
    order = [F.col(page).asc(), F.col("position").asc()]
    return first_seen(flatten_pages(pages, page), "id", order).select(*BRONZE_JOBS.fieldNames())


def write_bronze(df: DataFrame, root: str, load_date: Column | str) -> None:
    """JSON lines in a folder per load date; a date that is loaded again is replaced."""
    day = F.lit(load_date) if isinstance(load_date, str) else load_date
    (df.withColumn("date", day).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("date")
       .option("ignoreNullFields", "false").json(root))


def read_bronze(spark: SparkSession, root: str, files: list[str] | None = None) -> DataFrame:
    """All JSON-line files under ``date=*`` folders, or the given ones of them; an error when
    there is none."""
    try:
        return (spark.read.schema(BRONZE_JOBS).option("basePath", root)
                .json(files or f"{root.rstrip('/')}/date=*/*.json*"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no bronze job files under {root}") from e
        raise

"""Parquet tables and the warehouse: named tables with keys, kept current by merges.

A merge writes the buckets that its stage touches as part of the next version of the table, then
moves the view that carries the table's name; ``versions`` tells how. Readers see the old or
the new version, never a mixture, and nothing overwrites data that is still being read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobloom.operators.dedupe import dense_ids
from jobloom.operators.merge import (
    coerce_jobs, new_pairs, require_unique, upsert, upsert_vectors,
)
from jobloom.schemas import ROLE_SKILL_COUNTS, TABLES
from jobloom.session import checkpoint, scratch_path
from jobloom.sources.storage import delete, names
from jobloom.sources.versions import BucketTable


def write_silver(df: DataFrame, path: str, partition: str = "dt") -> None:
    """Overwrite a parquet table partitioned by date.

    Rebalancing keeps the files of a date few and even: small dates share a task, and a
    date that holds a large part of the table is split over several.
    """
    df.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(path)


def update_silver(new: DataFrame, path: str, key: str, newest: Callable[[DataFrame], DataFrame],
                  partition: str = "dt") -> DataFrame:
    """Bring new rows into a silver table; only the dates they touch are written anew. Returns
    the rows that these dates now have.

    Touched are the dates of the new rows and those of stored rows of the same keys. In these,
    ``newest`` keeps one row of each key among stored and new rows. All other dates keep their
    files. ``new`` is read several times: give a stored table. The rows are staged first, so
    nothing that is being read is overwritten, and a load that fails in between can be repeated.
    """
    spark = new.sparkSession
    if not names(spark, path):
        write_silver(new, path, partition)
        return read_silver(spark, path)
    kind = new.schema[partition].dataType
    old = read_silver(spark, path).withColumn(partition, F.col(partition).cast(kind))
    same = old.join(new.select(key).distinct(), key, "left_semi")
    dates = {r[0] for r in new.select(partition).union(same.select(partition)).distinct().collect()}
    touched = F.col(partition).isin([d for d in dates if d is not None])
    if None in dates:
        touched = touched | F.col(partition).isNull()
    staged = scratch_path(spark, "silver")
    write_silver(newest(old.filter(touched).unionByName(new)), staged, partition)
    rows = read_silver(spark, staged).withColumn(partition, F.col(partition).cast(kind))
    rows.hint("rebalance", partition).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    # A date that all rows have left has nothing that would overwrite it.
    for name in set(names(spark, path)) - set(names(spark, staged)):
        if any(name == f"{partition}={'__HIVE_DEFAULT_PARTITION__' if d is None else d}" for d in dates):
            delete(spark, f"{path}/{name}")
    return rows


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def run_query(spark: SparkSession, sql: str, params: Mapping | None = None) -> DataFrame:
    """A SQL query with named parameter markers (``:name``)."""
    return spark.sql(sql, args=dict(params or {}))


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table, where its driver is on the class path."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


class Warehouse:
    """The six tables in one Spark database.

    ``location`` is on storage all executors share. A table starts with ``buckets`` buckets and
    doubles their number as it grows, so that a bucket fits a task: a merge reads, shuffles and
    writes the buckets its stage touches, and a session without a lasting catalog finds the
    tables again. A load that needs more buckets makes two versions, of which the first holds
    the rows of before.
    """

    def __init__(self, spark: SparkSession, database: str, location: str,
                 dim: int, buckets: int = 8, keep: int = 2, count_demand: bool = False):
        """``keep``: versions of a table that stay, the current one included; readers of an
        older one must be done by then. With ``count_demand``, loads of jobs and of their
        skills also bring the table behind ``v_role_skill_counts`` up to date."""
        self.spark, self.database, self.dim, self.buckets = spark, database, dim, buckets
        self.location = location.rstrip("/")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.location}'")
        self.stores = {
            name: BucketTable(spark, database, f"{self.location}/{name}", spec, buckets, max(1, keep))
            for name, spec in TABLES.items()}
        self.counts = BucketTable(spark, database, f"{self.location}/{ROLE_SKILL_COUNTS.name}",
                                  ROLE_SKILL_COUNTS, buckets, max(1, keep)) if count_demand else None

    def _full(self, name: str) -> str:
        return f"{self.database}.{name}"

    def ensure_tables(self) -> None:
        for store in self.stores.values():
            store.ensure()
        self.spark.sql(f"""
            CREATE OR REPLACE VIEW {self._full('v_role_skill_demand')} AS
            SELECT lower(title) AS role_title, skill, count(*) AS demand_count
            FROM {self._full('jobs')} JOIN {self._full('job_skills_ner')} USING (job_id)
            GROUP BY lower(title), skill""")
        if self.counts:
            self.counts.ensure()
            self.spark.sql(f"""
                CREATE OR REPLACE VIEW {self._full('v_role_skill_counts')} AS
                SELECT CASE WHEN role_key <> '' THEN substr(role_key, 2) END AS role_title, skill,
                  demand_count FROM {self.counts.name}""")

    @staticmethod
    def _role(title: str) -> Column:
        """Key of a title's role; that of a missing title is empty."""
        return F.coalesce(F.concat(F.lit("="), F.lower(title)), F.lit(""))

    def _count(self, changes: DataFrame) -> None:
        """Add changes (role_key, skill, n) to the counts; roles nobody asks for any more go."""
        key = list(ROLE_SKILL_COUNTS.key)
        delta = checkpoint(changes.groupBy(*key).agg(F.sum("n").alias("n")).filter("n <> 0"))
        touched = self.counts.touched(delta)
        summed = self.counts.rows(touched).withColumnRenamed("demand_count", "n").unionByName(
            delta).groupBy(*key).agg(F.sum("n").alias("demand_count"))
        self.counts.replace_buckets(summed.filter("demand_count > 0"), touched)

    def rebuild_demand(self) -> None:
        """Count all pairs anew, as after a load that failed between a table and its counts."""
        pairs = self.table("jobs").select("job_id", self._role("title").alias("role_key")).join(
            self.table("job_skills_ner"), "job_id")
        self.counts.replace(checkpoint(
            pairs.groupBy("role_key", "skill").agg(F.count("*").alias("demand_count"))))

    def _title_changes(self, touched: list[int], stage: DataFrame) -> DataFrame:
        """What new and changed titles of the stage do to the counts of their jobs' skills."""
        role = self._role("title").alias("role_key")
        old = self.stores["jobs"].rows(touched).join(stage.select("job_id"), "job_id", "left_semi")
        roles = stage.select("job_id", role, F.lit(1).alias("n")).union(
            old.select("job_id", role, F.lit(-1)))
        moved = roles.groupBy("job_id", "role_key").agg(F.sum("n").alias("n")).filter("n <> 0")
        return moved.join(self.table("job_skills_ner"), "job_id").select("role_key", "skill", "n")

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._full(name))

    def _require_key(self, stage: DataFrame, key) -> None:
        """A row may be updated once per merge; only the key columns are read for this."""
        wrong = require_unique(stage, key).limit(5).collect()
        if wrong:
            raise ValueError(f"missing or repeated keys in the stage, such as {wrong}")

    def duplicate_keys(self, name: str) -> DataFrame:
        return require_unique(self.table(name), TABLES[name].key)

    def upsert_jobs(self, jobs: DataFrame) -> None:
        """Insert and update; buckets without a key of the stage keep their files."""
        store = self.stores["jobs"]
        stage = coerce_jobs(jobs).select(
            *[F.col(f.name).cast(f.dataType) for f in store.spec.schema.fields])
        self._require_key(stage, store.spec.key)
        touched = store.touched(stage)
        changes = checkpoint(self._title_changes(touched, stage)) if self.counts else None
        store.replace_buckets(upsert(store.rows(touched), stage, store.spec.key,
                                     store.spec.update_columns), touched)
        if self.counts:
            self._count(changes)

    def add_skills(self, name: str, pairs: DataFrame) -> None:
        """Add unseen pairs as further files; known ones are left alone, and so are their files."""
        store = self.stores[name]
        stage = pairs.select(*[F.col(f.name).cast(f.dataType) for f in store.spec.schema.fields])
        new = new_pairs(store.rows(store.touched(stage)), stage, store.spec.key)
        if not self.counts or name != "job_skills_ner":
            return store.append(new)
        new = checkpoint(new)
        store.append(new)
        self._count(new.join(self.table("jobs"), "job_id").select(
            self._role("title").alias("role_key"), "skill", F.lit(1).alias("n")))

    def replace_skills(self, name: str, pairs: DataFrame) -> None:
        """All pairs anew, for ids that were numbered anew."""
        store = self.stores[name]
        store.replace(pairs.select(*[F.col(f.name).cast(f.dataType) for f in store.spec.schema.fields])
                      .dropDuplicates(list(store.spec.key)))
        if self.counts and name == "job_skills_ner":
            self.rebuild_demand()

    def upsert_embeddings(self, name: str, vectors: DataFrame) -> None:
        """Insert and update whole vectors; buckets without a key of the stage keep their files."""
        store = self.stores[name]
        id_column = store.spec.key[0]
        stage = vectors.withColumn(
            id_column, F.col(id_column).cast(store.spec.schema[id_column].dataType))
        self._require_key(stage, [id_column])
        touched = store.touched(stage)
        store.replace_buckets(
            upsert_vectors(store.rows(touched), stage, id_column, self.dim), touched)

    def reload_questions(self, questions: DataFrame, order) -> DataFrame:
        """Replace all questions; ids restart at 1 and the vectors are emptied."""
        numbered = dense_ids(questions.select("question", "topic", "source", *[
            c for c in questions.columns if c not in ("question", "topic", "source")
        ]), order, "q_id")
        stamped = numbered.withColumn("created_at", F.current_timestamp())
        self.stores["interview_questions"].replace(stamped)
        empty = self.spark.createDataFrame([], TABLES["interview_embeddings"].schema)
        self.stores["interview_embeddings"].replace(empty)
        return self.table("interview_questions")

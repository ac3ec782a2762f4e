"""Tables that are appended to by named jobs, each exactly once.

A job writes its rows to a folder of its own and then one manifest: the job's name, its part files and their number
of rows. Readers go by the manifests, so what a stopped job has written is not seen, and a job that is run
again under its name adds nothing. Spark moves a manifest into place as one file when it is whole. Only Spark's
readers and writers touch the folder, so it may lie in any store that Spark knows.

Two jobs may append at the same time. Two attempts of one job must not: the later one would overwrite the files of the earlier.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "job string, files array<string>, n_rows bigint"


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """(job, files, n_rows) of the jobs that are complete."""
    try:
        return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(f"{folder}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def done(spark: SparkSession, folder: str, job: str) -> bool:
    """Whether a job's rows are there."""
    return manifests(spark, folder).filter(F.col("job") == job).limit(1).count() > 0


def append(rows: DataFrame | Callable[[], DataFrame], folder: str, job: str) -> bool:
    """Add the rows under the job's name, unless they are there; says whether they were added. A function is only called if needed."""
    spark = (SparkSession.active() if callable(rows) else rows.sparkSession)
    if done(spark, folder, job):
        return False
    df = rows() if callable(rows) else rows
    own = f"{folder}/data/job={job}"
    df.write.mode("overwrite").parquet(own)
    written = spark.read.schema(df.schema).parquet(own)
    manifest = spark.createDataFrame([(job, sorted(written.inputFiles()), written.count())], MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").json(f"{folder}/commits/{job}")
    return True


def read(spark: SparkSession, folder: str, jobs: list[str] | None = None) -> DataFrame:
    """The rows of all complete jobs, or of some of them. Of jobs with other columns, missing ones are null.

    The list of part files comes to the driver, as it does for any read of a folder.
    """
    found = manifests(spark, folder)
    found = found if jobs is None else found.filter(F.col("job").isin(jobs))
    by_job = {r["job"]: list(r["files"]) for r in found.collect()}
    if not by_job:
        raise FileNotFoundError(f"no job has been completed in {folder}")
    parts = [spark.read.parquet(*files) for _, files in sorted(by_job.items()) if files]
    if not parts:
        raise FileNotFoundError(f"the jobs completed in {folder} wrote no files")
    if len({p.schema.simpleString() for p in parts}) == 1:
        return spark.read.parquet(*[f for _, files in sorted(by_job.items()) for f in files])
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def forget(spark: SparkSession, folder: str, job: str) -> None:
    """Take back a job's rows: its manifest is replaced by none, and the files are no longer read."""
    spark.createDataFrame([], MANIFEST).write.mode("overwrite").json(f"{folder}/commits/{job}")

"""Tables kept as numbered snapshots, so that a table can be rewritten from itself.

Each commit writes a whole new Parquet folder and then creates the file that names it, `versions/<number>`. Creating
fails if the file exists, so of two writers that started from one version only the first commits. A writer that dies
before leaves the last version as it was; its folder is named by nobody. Old folders stay readable.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.sources.tables import LOOKUP_SCHEMA

_END = "\n"


class ConcurrentCommit(RuntimeError):
    """Somebody else committed the version that this writer was about to."""


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _files(spark, f"{path}/versions")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(name) for name in names if name.isdigit())


def _folder(spark: SparkSession, path: str, version: int) -> str | None:
    """The folder a version names, None if its writer died while naming it."""
    fs, file = _files(spark, f"{path}/versions/{version:010d}")
    stream = fs.open(file)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{path}/data/{text[: -len(_END)]}" if text.endswith(_END) else None


def latest_version(spark: SparkSession, path: str) -> int:
    """The number of the last snapshot, 0 when there is none."""
    return next((v for v in reversed(_versions(spark, path)) if _folder(spark, path, v)), 0)


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The last snapshot or the given one; None when there is none."""
    chosen = latest_version(spark, path) if version is None else version
    return spark.read.parquet(_folder(spark, path, chosen)) if chosen else None


def write_snapshot(df: DataFrame, path: str, base: int | None = None) -> int:
    """Commit `df` as the snapshot after `base` (the last one if not given) and return its number."""
    spark = df.sparkSession
    before = latest_version(spark, path) if base is None else base
    name = uuid.uuid4().hex
    df.write.parquet(f"{path}/data/{name}")
    # A number that a dead writer took is passed over, one with a snapshot is not.
    taken = [v for v in _versions(spark, path) if v > before]
    if any(_folder(spark, path, v) for v in taken):
        raise ConcurrentCommit(f"{path} has a version after {before}")
    version = max([before, *taken]) + 1
    fs, file = _files(spark, f"{path}/versions/{version:010d}")
    try:
        stream = fs.create(file, False)
    except Py4JJavaError as e:
        if not fs.exists(file):
            raise
        raise ConcurrentCommit(f"{path} has a version {version}") from e
    stream.write(bytearray((name + _END).encode()))
    stream.close()
    return version


def extend_lookup(spark: SparkSession, path: str, answers: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """Add a round of answers (id, value) to the saved lookup and return the new snapshot.

    An id of `asked` (id) without an answer is kept with a null value, so it is not asked again. A new answer
    replaces an old one, no answer replaces none. Of several answers to one id the smallest counts; null ids are
    left out. The old snapshot stays as it was, whatever happens here.
    """
    version = latest_version(spark, path)
    old = read_snapshot(spark, path, version) if version else spark.createDataFrame([], LOOKUP_SCHEMA)
    fresh = answers.select(F.col("id").cast("string").alias("id"), F.col("value").cast("string").alias("value"))
    if asked is not None:
        fresh = fresh.unionByName(asked.select(F.col("id").cast("string").alias("id"), F.lit(None).cast("string").alias("value")))
    fresh = fresh.where(F.col("id").isNotNull()).groupBy("id").agg(F.min("value").alias("new"))
    both = old.select("id", "value").join(fresh, "id", "full_outer").select("id", F.coalesce("new", "value").alias("value"))
    return read_snapshot(spark, path, write_snapshot(both, path, version))

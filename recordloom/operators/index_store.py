"""A name index on disk that follows changes of records without being rebuilt.

The index is a list of segments, kept as a snapshot table, so a change is seen whole or not at all. A segment has entries
(id, name, seq), a null name being a tombstone, and the postings of the names that no earlier segment has. The entry with the
greatest `seq` of an id counts. An upsert thus writes the changed ids and the postings of new names only; `merge`
writes what is alive into one segment.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators.search import build_name_index
from recordloom.sinks.snapshots import latest_version, read_snapshot, write_snapshot

_ENTRIES = "id string, name string, seq long"
_POSTINGS = "view string, token string, name string, length int, tf long"


def _segments(spark: SparkSession, path: str, version: int) -> list[tuple[str, int]]:
    """The names of the segments and their numbers; as many as there were changes since the last merge."""
    listed = read_snapshot(spark, path, version) if version else None
    return [] if listed is None else sorted(((r.segment, r.seq) for r in listed.collect()), key=lambda s: s[1])


def _read(spark: SparkSession, path: str, segments: list[tuple[str, int]], part: str, schema: str) -> DataFrame:
    if not segments:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/segments/{name}/{part}" for name, _ in segments])


def _alive(entries: DataFrame) -> DataFrame:
    return entries.groupBy("id").agg(F.max_by("name", "seq").alias("name")).where(F.col("name").isNotNull())


def _postings(names: DataFrame) -> DataFrame:
    # Counted, not a constant, which would be no part of the keys that postings are dealt by.
    index = build_name_index(names.groupBy("name").agg(F.count("*").alias("n")))
    return index.select("view", "token", "name", F.col("length").cast("int").alias("length"), F.col("tf").cast("long").alias("tf"))


def upsert_names(spark: SparkSession, path: str, changes: DataFrame) -> int:
    """Take over (id, name) as the names of these ids; a null name removes the id. Of several names of one id in
    `changes` the smallest counts, before a null. Null ids are left out. Returns the version."""
    version = latest_version(spark, path)
    segments = _segments(spark, path, version)
    seq = max((s for _, s in segments), default=0) + 1
    name = uuid.uuid4().hex
    latest = changes.select(F.col("id").cast("string").alias("id"), F.col("name").cast("string").alias("name")).where(F.col("id").isNotNull())
    latest = latest.groupBy("id").agg(F.min("name").alias("name")).withColumn("seq", F.lit(seq).cast("long"))
    folder = f"{path}/segments/{name}"
    latest.write.parquet(f"{folder}/entries")
    written = spark.read.schema(_ENTRIES).parquet(f"{folder}/entries")
    # Names of tombstones and replaced names keep their postings until a merge.
    known = _read(spark, path, segments, "entries", _ENTRIES).select("name").distinct()
    fresh = written.where(F.col("name").isNotNull()).select("name").distinct().join(known, "name", "left_anti")
    _postings(fresh).write.parquet(f"{folder}/postings")
    return _commit(spark, path, [*segments, (name, seq)], version)


def merge_segments(spark: SparkSession, path: str) -> int:
    """Write what is alive into one segment: no tombstones, no replaced names, no postings of either."""
    version = latest_version(spark, path)
    segments = _segments(spark, path, version)
    name = uuid.uuid4().hex
    folder = f"{path}/segments/{name}"
    seq = max((s for _, s in segments), default=0) + 1
    _alive(_read(spark, path, segments, "entries", _ENTRIES)).withColumn("seq", F.lit(seq).cast("long")).write.parquet(f"{folder}/entries")
    names = spark.read.schema(_ENTRIES).parquet(f"{folder}/entries").select("name").distinct()
    _read(spark, path, segments, "postings", _POSTINGS).join(names, "name", "left_semi").write.parquet(f"{folder}/postings")
    return _commit(spark, path, [(name, seq)], version)


def _commit(spark: SparkSession, path: str, segments: list[tuple[str, int]], version: int) -> int:
    return write_snapshot(spark.createDataFrame(segments, "segment string, seq long").coalesce(1), path, version)


def indexed_records(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(id, name) of the records in the index."""
    segments = _segments(spark, path, latest_version(spark, path) if version is None else version)
    return _alive(_read(spark, path, segments, "entries", _ENTRIES))


def read_name_index(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The postings of `build_name_index` over the records in the index."""
    version = latest_version(spark, path) if version is None else version
    names = indexed_records(spark, path, version).groupBy("name").agg(F.count("*").alias("n"))
    postings = _read(spark, path, _segments(spark, path, version), "postings", _POSTINGS)
    return postings.join(names, "name").select("view", "token", "name", "n", "length", "tf")


def hit_records(hits: DataFrame, records: DataFrame) -> DataFrame:
    """(query_id, rank, score, id, name): the records (id, name) that bear the names found by `search_names`."""
    return hits.select("query_id", "rank", "score", "name").join(records.select("id", "name"), "name").select("query_id", "rank", "score", "id", "name")

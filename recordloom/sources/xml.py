"""Entity records from registry XML, one row per record element.

A file is cut behind the closing tags of records, wherever a split of it begins, so one large file is read by many
tasks. A record that holds elements of its own name spans several pieces; the tags opened and closed up to each
piece tell which belong together. Tags inside comments or CDATA sections count as tags.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordloom.functions.absent import markup_value, strip
from recordloom.schema import ENTITY_COLUMNS, as_entities
from recordloom.scratch import written

RECORD_SCHEMA = """
    `drugbank-id` array<struct<_VALUE string, _primary string>>,
    name string,
    description string,
    `cas-number` string,
    `calculated-properties` struct<property: array<struct<kind: string, value: string>>>,
    `external-identifiers` struct<`external-identifier`: array<struct<resource: string, identifier: string>>>
"""

# Entity column -> resource labels that may fill it, preferred first.
RESOURCES = {
    "pubchem_cid": ["PubChem Compound", "PubChem Substance"],
    "chembl_id": ["ChEMBL"],
    "chebi_id": ["ChEBI"],
    "kegg_id": ["KEGG Drug"],
    "kegg_cid": ["KEGG Compound"],
    "bindingdb_id": ["BindingDB"],
}


def external_id(ids: Column, resource: str) -> Column:
    """Identifier of a resource; blanks do not count and the last of several wins."""
    usable = F.filter(
        ids,
        lambda x: (strip(x["resource"]) == resource) & (F.coalesce(strip(x["identifier"]), F.lit("")) != ""),
    )
    return strip(F.try_element_at(usable, F.lit(-1))["identifier"])


def property_value(properties: Column, kind: str) -> Column:
    """Value of the first property of a kind, whatever its case; blank counts as absent."""
    hits = F.filter(properties, lambda p: F.lower(strip(p["kind"])) == kind.lower())
    return markup_value(F.get(hits, F.lit(0))["value"])


def primary_id(ids: Column) -> Column:
    return markup_value(F.get(F.filter(ids, lambda x: x["_primary"] == "true"), F.lit(0))["_VALUE"])


def record_texts(spark: SparkSession, path: str, row_tag: str = "drug") -> DataFrame:
    """(record): the text of each outermost `row_tag` element. Elements of that name inside one stay in it; a record
    that is not closed at the end of its file is left out."""
    tag = re.escape(row_tag)
    opening = rf"<{tag}(?:\s[^>]*[^/>])?>"
    read = spark.read.option("lineSep", f"</{row_tag}>").text(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    pieces = read.select("value", *place, F.monotonically_increasing_id().alias("at"))
    # Each piece ends with a closing tag, so this is how much deeper it leaves the file.
    pieces = written(pieces.withColumn("net", F.regexp_count("value", F.lit(opening)) - 1), "xml-pieces")

    in_block = W.partitionBy("file", "start").orderBy("at")
    so_far = in_block.rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    # One row per split of a file.
    sums = pieces.groupBy("file", "start").agg(F.sum("net").alias("block_net"))
    offsets = sums.select("file", "start", F.coalesce(F.sum("block_net").over(earlier), F.lit(0)).alias("offset"))
    within = pieces.select("file", "start", "at", "net", F.sum("net").over(so_far).alias("after"))
    depth = within.join(offsets, ["file", "start"])
    depth = depth.withColumn("outside", F.col("offset") + F.col("after") - F.col("net") == 0)
    opened = F.last(F.when(F.col("outside"), F.col("at")), ignorenulls=True)
    begun = written(depth.withColumn("begun", opened.over(so_far)).withColumn("whole", F.col("outside") & (F.col("net") == 0)), "xml-depths")
    last = begun.groupBy("file", "start").agg(F.max(F.when(F.col("outside"), F.col("at"))).alias("own"))
    before = last.select("file", "start", F.last("own", ignorenulls=True).over(earlier).alias("carried"))

    texts = pieces.select("at", "value")
    # Most pieces are records. The pieces of the others meet by the piece that begins them.
    single = begun.where("whole").select("at").join(texts, "at").select("value")
    parts = begun.where("not whole").join(before, ["file", "start"]).join(texts, "at")
    grouped = parts.groupBy("file", F.coalesce("begun", "carried").alias("begun")).agg(
        F.array_sort(F.collect_list(F.struct("start", "at", "value", "net"))).alias("parts")
    )
    closed = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["net"]) == 0
    joined = grouped.where(closed).select(F.array_join("parts.value", f"</{row_tag}>").alias("value"))
    record = F.regexp_extract("value", rf"(?s)({opening}.*)", 1)
    return single.unionByName(joined).select(F.concat(record, F.lit(f"</{row_tag}>")).alias("record"))


def _parsed(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    kept = F.from_xml("record", RECORD_SCHEMA + ", unparsed string", {"columnNameOfCorruptRecord": "unparsed"})
    return record_texts(spark, path, row_tag).select(kept.alias("r")).select("r.*")


def unparsed_records(spark: SparkSession, path: str, row_tag: str = "drug") -> int:
    """How many records are no well-formed XML; `read_entity_xml` leaves them out."""
    return _parsed(spark, path, row_tag).where(F.col("unparsed").isNotNull()).count()


def read_entity_xml(spark: SparkSession, path: str, row_tag: str = "drug", with_text: bool = False) -> DataFrame:
    """Entity rows of an XML dump; `with_text` adds `inchi_key` and `description`.
    Records without a primary id are left out."""
    raw = _parsed(spark, path, row_tag).where(F.col("unparsed").isNull())
    ids = F.col("external-identifiers.external-identifier")
    routed = [
        F.coalesce(*[external_id(ids, label) for label in labels]).alias(column)
        for column, labels in RESOURCES.items()
    ]
    records = raw.select(
        primary_id(F.col("drugbank-id")).alias("drugbank_id"),
        F.coalesce(strip(F.col("name")), F.lit("")).alias("name"),
        markup_value(F.col("cas-number")).alias("cas_num"),
        *routed,
        property_value(F.col("calculated-properties.property"), "InChIKey").alias("inchi_key"),
        markup_value(F.col("description")).alias("description"),
    ).where(F.col("drugbank_id").isNotNull())
    if not with_text:
        return as_entities(records)
    missing = [F.lit(None).cast("string").alias(c) for c in ENTITY_COLUMNS if c not in records.columns and c != "umls_cuis"]
    wide = records.select("*", *missing, F.array().cast("array<string>").alias("umls_cuis"))
    return wide.select(*ENTITY_COLUMNS, "inchi_key", "description")

"""Flat files whose records span several lines. Both readers split files at the record separator,
so one large file is read by many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.functions.absent import flat_file_value, strip

_LINE_END = r"\r\n?|\n"

# Output column -> key of the key/value drug file.
KV_FIELDS = {"ttd_id": "TTDDRUGID", "name": "DRUGNAME", "cas_num": "CASNUMBER", "pubchem_cid": "PUBCHCID"}


def read_kv_blocks(
    spark: SparkSession,
    path: str,
    fields: dict[str, str] = KV_FIELDS,
    required: tuple[str, ...] = ("ttd_id", "name"),
    newline: str = "\n",
) -> DataFrame:
    """Blank-line separated records of KEY<tab>VALUE lines.

    Keys are compared in upper case, the last line of a key wins, lines without a tab are ignored,
    and records lacking a required field are left out. Use `newline="\\r\\n"` for CRLF files.
    """
    # The reader cuts at empty lines; lines of only blanks are cut here.
    chunks = spark.read.option("lineSep", newline * 2).text(path)
    blocks = chunks.select(F.explode(F.split("value", r"(?m)^\s*$")).alias("block"))
    pairs = F.transform(
        F.filter(F.split("block", _LINE_END), lambda line: F.contains(line, F.lit("\t"))),
        lambda line: F.split(line, "\t", 2),
    )

    def last_value(key: str) -> Column:
        hits = F.filter(F.col("pairs"), lambda kv: F.upper(strip(F.get(kv, F.lit(0)))) == key)
        return strip(F.get(F.try_element_at(hits, F.lit(-1)), F.lit(1)))

    values = [
        (last_value(key) if column in required else flat_file_value(last_value(key))).alias(column)
        for column, key in fields.items()
    ]
    rows = blocks.select(pairs.alias("pairs")).select(*values)
    for column in required:
        rows = rows.where(F.col(column) != "")
    return rows


def _first_line(lines: Column, tag: str) -> Column:
    """Rest of the first line starting with `tag`."""
    hit = F.get(F.filter(lines, lambda line: F.startswith(line, F.lit(tag))), F.lit(0))
    return flat_file_value(F.substring(hit, F.lit(len(tag) + 1), F.length(hit)))


def _section(lines: Column, tag: str) -> Column:
    """The line starting with `tag` and the indented lines after it, without the tag."""
    start = F.array_position(F.transform(lines, lambda line: F.startswith(line, F.lit(tag))), F.lit(True))
    rest = F.when(start > 0, F.slice(lines, F.greatest(start, F.lit(1)).cast("int"), F.size(lines)))
    outside = F.transform(rest, lambda line: ~(F.startswith(line, F.lit(tag)) | F.startswith(line, F.lit(" "))))
    stop = F.array_position(outside, F.lit(True)).cast("int")
    kept = F.when(stop > 0, F.slice(rest, F.lit(1), F.greatest(stop - 1, F.lit(0)))).otherwise(rest)
    return F.transform(kept, lambda line: strip(F.replace(line, F.lit(tag), F.lit(""))))


def read_tagged_blocks(spark: SparkSession, path: str, delimiter: str = "///") -> DataFrame:
    """Tagged records ended by a delimiter: entry id, first name and the cross-reference section."""
    blocks = spark.read.option("lineSep", delimiter).text(path)
    lined = blocks.select(F.split("value", _LINE_END).alias("lines"))
    cut = lined.select("lines", _section(F.col("lines"), "DBLINKS").alias("links"))
    lines, links = F.col("lines"), F.col("links")
    return cut.select(
        F.get(F.split(_first_line(lines, "ENTRY"), r"\s+"), F.lit(0)).alias("kegg_id"),
        F.coalesce(F.get(F.split(_first_line(lines, "NAME"), ";"), F.lit(0)), F.lit("")).alias("name"),
        _first_line(links, "CAS:").alias("cas_num"),
        _first_line(links, "ChEBI:").alias("chebi_id"),
        _first_line(links, "PubChem:").alias("pubchem_cid"),
    ).where(F.col("kegg_id") != "")

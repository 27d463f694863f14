"""Known names mentioned in free text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.text import normalize_name
from recordloom.scratch import written


def word_tree(names: list[str]) -> dict:
    """Names, as words between single spaces, by their first word, then by their second, and so on; under None stands
    the name that ends there."""
    root: dict = {}
    for name in names:
        node = root
        for word in name.split(" "):
            node = node.setdefault(word, {})
        node[None] = name
    return root


def places(tree: dict, text: str) -> Iterator[tuple[int, str]]:
    """(position of the first word from 1, name) of every place of a name in a text."""
    words = text.split(" ")
    for i, word in enumerate(words):
        node, j = tree.get(word), i + 1
        while node is not None:
            if (name := node.get(None)) is not None:
                yield i + 1, name
            if j == len(words):
                break
            node, j = node.get(words[j]), j + 1


def mention_rows(texts: DataFrame, names: DataFrame, id_col: str = "doc_id", block_bytes: int = 16 << 20) -> DataFrame:
    """(id, position, name): every place where the words of a known name occur in a text.

    `texts` has (id, text), `names` has (name). Texts stay where they are: each task walks the tree of names from
    every word, and most words end the walk at once. The names are broadcast in blocks of about `block_bytes` of
    text, one pass for each; a block does not depend on how often a first word is shared. Null and empty texts have no
    mentions, and names without words are left out. Rows that share an id are searched one by one.
    """
    plain = texts.select(id_col, normalize_name(F.col("text")).alias("norm"))
    known = written(names.select(normalize_name(F.col("name")).alias("name")).where(F.col("name") != "").distinct(), "known-names")
    size = known.agg(F.sum(F.octet_length("name"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    if blocks > 1:
        plain = written(plain, "normalised-texts")
    schema = T.StructType([texts.schema[id_col], T.StructField("position", T.IntegerType()), T.StructField("name", T.StringType())])
    found = None
    for k in range(blocks):
        # At most about block_bytes of names.
        block = known.where(F.pmod(F.xxhash64("name"), F.lit(blocks)) == k).toArrow()["name"].to_pylist()
        sent = texts.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            tree = word_tree(sent.value)
            for batch in batches:
                rows, positions, hits = [], [], []
                for row, text in enumerate(batch.column(1).to_pylist()):
                    for position, name in places(tree, text):
                        rows.append(row)
                        positions.append(position)
                        hits.append(name)
                ids = batch.column(0).take(pa.array(rows, type=pa.int64()))
                columns = [ids, pa.array(positions, type=pa.int32()), pa.array(hits, type=pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "position", "name"])

        part = plain.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found


def extract_mentions(texts: DataFrame, names: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, mentions): the known names in each text in order of position, empty where there are none."""
    hits = mention_rows(texts, names, id_col)
    # One list per text, so no longer than the text.
    listed = hits.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("position", "name"))).alias("m"))
    mentions = F.coalesce(F.transform("m", lambda x: x["name"]), F.array().cast("array<string>"))
    return texts.select(id_col).join(listed, id_col, "left").select(id_col, mentions.alias("mentions"))

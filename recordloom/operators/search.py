"""Name search: postings of three views of a name, and the best names by BM25 over them, shard by shard."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from recordloom.functions.phonetic import metaphone
from recordloom.functions.text import edge_ngrams
from recordloom.partitioning import spread
from recordloom.scratch import written

# View -> weight in the combined score.
BOOSTS = {"words": 3.0, "phonetic": 2.0, "autocomplete": 1.0}
K1, B = 1.2, 0.75


def words(c: Column) -> Column:
    """Lower-case words: runs of letters, digits and underscores; an inner apostrophe or dot keeps a
    word together."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}\p{M}_]+(?:['’.][\p{L}\p{N}\p{M}_]+)*)"), F.lit(1))


def view_tokens(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """(keys, view, length, token): the tokens of a text in the three views and how many each view has.
    The phonetic view keeps the word beside its code; codes are made once per distinct word."""
    # Names are short and make many tokens, so the number of parts is not left to the size of what is shuffled.
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    worded = df.select(*keys, words(F.col(text)).alias("w")).repartition(n, *keys)
    parts = {"words": F.col("w"), "autocomplete": F.flatten(F.transform("w", lambda t: edge_ngrams(t)))}
    viewed = F.array(*[F.struct(F.lit(v).alias("view"), tokens.alias("tokens")) for v, tokens in parts.items()])
    spelled = worded.select(*keys, F.explode(viewed).alias("v")).select(
        *keys, "v.view", F.size("v.tokens").alias("length"), F.explode("v.tokens").alias("token")
    )
    spoken = worded.select(*keys, F.explode("w").alias("word"))
    codes = spread(spoken.select("word").distinct()).select("word", metaphone(F.col("word")).alias("code"))
    both = F.array_distinct(F.array_compact(F.array("word", "code"))).alias("both")
    # One text per row.
    heard = spoken.join(codes, "word").select(*keys, both).repartition(n, *keys).groupBy(*keys).agg(F.flatten(F.collect_list("both")).alias("tokens"))
    heard = heard.select(*keys, F.lit("phonetic").alias("view"), F.size("tokens").alias("length"), F.explode("tokens").alias("token"))
    return spelled.unionByName(heard)


def distinct_names(df: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """(name, n): the distinct names to index and the number of records that bear each."""
    return df.where(F.col(name_col).isNotNull()).groupBy(F.col(name_col).alias("name")).agg(F.count(id_col).alias("n"))


def build_name_index(names: DataFrame) -> DataFrame:
    """(view, token, name, n, tf, length): postings of the distinct names of `distinct_names`; `length`
    is the number of tokens the name has in the view."""
    tokens = view_tokens(names, "name", "name", "n")
    return tokens.groupBy("view", "token", "name", "n", "length").agg(F.count("*").alias("tf"))


def view_stats(index: DataFrame) -> DataFrame:
    """(view, docs, avg_length) over records, one row per view."""
    per_name = index.groupBy("view", "name", "n", "length").agg(F.sum("tf").alias("_t"))
    return per_name.groupBy("view").agg(
        F.sum("n").cast("double").alias("docs"), (F.sum(F.col("n") * F.col("length")) / F.sum("n")).alias("avg_length")
    )


def allowed_edits(token: Column) -> Column:
    """Edits the fuzzy view forgives: none up to 2 letters, one up to 5, two beyond."""
    n = F.length(token)
    return F.when(n <= 2, 0).when(n <= 5, 1).otherwise(2)


#: Most edits forgiven.
_EDITS = 2


def _piece_key(edits, length: Column, piece: Column, letters: Column) -> Column:
    """64-bit keys keep the shuffle narrow; a chance collision only adds a pair to measure."""
    return F.xxhash64(F.lit(edits), length, piece, letters)


def _bounds(edits: int, length: Column, piece: Column) -> tuple[Column, Column]:
    """Where a piece begins and ends, counted from 0, when a word is cut into `edits` + 1 even pieces."""
    return F.floor(piece * length / (edits + 1)).cast("int"), F.floor((piece + 1) * length / (edits + 1)).cast("int")


def _term_keys(term: Column) -> Column:
    """The pieces of an index word, for each number of edits that can lead to it: six keys for a word of any length."""
    length = F.length(term)
    keys = [F.when(length <= 2, _piece_key(0, length, F.lit(0), term))]
    for edits in range(1, _EDITS + 1):
        for i in range(edits + 1):
            start, end = _bounds(edits, length, F.lit(i))
            keys.append(F.when(length > edits, _piece_key(edits, length, F.lit(i), F.substring(term, start + 1, end - start))))
    return F.array_compact(F.array(*keys))


def _token_keys(token: Column, edits: int) -> Column:
    """Where the pieces of a word within `edits` of `token` may stand in it: a word of another length by as much, cut
    into one piece more than there are edits, has a piece that no edit touches and that is moved by at most as many
    letters. Their number depends on the edits alone."""
    length = F.length(token)
    if edits == 0:
        return F.array(_piece_key(0, length, F.lit(0), token))
    shifts = range(-edits, edits + 1)
    tried = [(d, i, s) for d in shifts for i in range(edits + 1) for s in shifts]
    options = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(i).alias("i"), F.lit(s).alias("s")) for d, i, s in tried])

    def key(o: Column) -> Column:
        other = length + o["d"]
        start, end = _bounds(edits, other, o["i"])
        at = start + o["s"]
        fits = (other > edits) & (at >= 0) & (at + end - start <= length)
        return F.when(fits, _piece_key(edits, other, o["i"], F.substring(token, at + 1, end - start)))

    return F.array_distinct(F.array_compact(F.transform(options, key)))


def fuzzy_terms(query_tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(token, term, weight): vocabulary terms within the allowed edits of each query token. Exact hits
    weigh 1, others 1 - edits / shorter length."""
    q = query_tokens.select("token").distinct().withColumn("edits", allowed_edits(F.col("token")))
    keys = F.when(F.col("edits") == 0, _token_keys(F.col("token"), 0))
    for edits in range(1, _EDITS + 1):
        keys = keys.when(F.col("edits") == edits, _token_keys(F.col("token"), edits))
    left = q.select("token", "edits", F.explode(keys).alias("key"))
    right = spread(vocabulary).select("term", F.explode(_term_keys(F.col("term"))).alias("key"))
    # The bounded distance is -1 beyond the bound.
    near = spread(left.join(right, "key").select("token", "term", "edits")).withColumn("d", F.levenshtein("token", "term", _EDITS)).where(F.col("d").between(0, F.col("edits")))
    weight = 1.0 - F.col("d") / F.least(F.length("token"), F.length("term"))
    return near.select("token", "term", "d").distinct().select("token", "term", weight.alias("weight")).where(F.col("weight") > 0)


def gain(tf: Column, length: Column, average: Column) -> Column:
    """What a token adds to a name's score, per unit of the token's weight; at most 1."""
    return tf / (tf + K1 * (1.0 - B + B * length / average))


#: Postings of a token are layered by gain, into this many steps of equal width.
_LEVELS = 16


def impact_blocks(index: DataFrame, shards: int = 8, size: int = 256) -> DataFrame:
    """(view, token, level, shard, block, top, postings): the postings of each token, layered by gain, dealt by name to
    `shards` and cut into blocks of `size`; `top` is the largest gain of the block.

    However many names hold a token, its list is spread over layers and shards, and a block has a bounded size.
    """
    # One row per view.
    stats = F.broadcast(view_stats(index))
    worth = gain(F.col("tf").cast("double"), F.col("length"), F.col("avg_length"))
    rated = index.join(stats, "view").select("view", "token", "name", "n", worth.alias("gain"))
    shard = F.pmod(F.xxhash64("name"), F.lit(shards)).cast("int")
    layered = rated.withColumns({"level": F.ceil(F.col("gain") * _LEVELS).cast("int"), "shard": shard})
    layer = ["view", "token", "level", "shard"]
    place = F.row_number().over(W.partitionBy(*layer).orderBy(F.desc("gain"), "name"))
    blocked = layered.withColumn("block", F.floor((place - 1) / size).cast("int"))
    return blocked.groupBy(*layer, "block").agg(F.max("gain").alias("top"), F.collect_list(F.struct("name", "n", "gain")).alias("postings"))


def token_weights(index: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, view, token, w): the index tokens that queries (query_id, text) reach in the three views, and what a
    full gain of each is worth: boost * weight of the hit * inverse document frequency."""
    wanted = view_tokens(queries, "text", "query_id").groupBy("query_id", "view", "token").agg(F.count("*").cast("double").alias("qtf"))
    word_terms = wanted.where(F.col("view") == "words")
    vocabulary = index.where(F.col("view") == "words").select(F.col("token").alias("term")).distinct()
    fuzzy = word_terms.join(fuzzy_terms(word_terms, vocabulary), "token")
    fuzzy = fuzzy.select("query_id", "view", F.col("term").alias("token"), (F.col("qtf") * F.col("weight")).alias("qtf"))
    weighted = fuzzy.unionByName(wanted.where(F.col("view") != "words"))
    weighted = weighted.groupBy("query_id", "view", "token").agg(F.sum("qtf").alias("qtf"))
    frequency = index.groupBy("view", "token").agg(F.sum("n").cast("double").alias("df"))
    boost = F.create_map(*[F.lit(x) for pair in BOOSTS.items() for x in pair])
    scored = weighted.join(frequency, ["view", "token"]).join(F.broadcast(view_stats(index)), "view")
    idf = F.log(1.0 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return scored.select("query_id", "view", "token", (F.try_element_at(boost, F.col("view")) * F.col("qtf") * idf).alias("w"))


#: Names of a shard and queries of a part, at most about so many, which bounds what a task holds.
_NAMES, _QUERIES = 4096, 2048
#: Scores are rounded to six places; two that differ by more keep their order.
_ROUNDING = 2e-6


def _best_of_shard(blocks: pa.Table, asked: pa.Table, k: int, schema: pa.Schema) -> pa.Table:
    """The k best names of a shard for each query of a part, by adding up the postings of the query's tokens."""
    if not blocks.num_rows or not asked.num_rows:
        return schema.empty_table()
    lists = blocks["postings"].combine_chunks()
    first = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    held = lists.flatten()
    coded = held.field("name").dictionary_encode()
    # Names are numbered in their order, so that ties are broken by number.
    order = pc.sort_indices(coded.dictionary).to_numpy()
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    code, gains = number[coded.indices.to_numpy()], held.field("gain").to_numpy()
    borne = np.zeros(len(order), dtype=np.int64)
    borne[code] = held.field("n").to_numpy()
    spans: dict[tuple[str, str], list[slice]] = {}
    for i, token in enumerate(zip(blocks["view"].to_pylist(), blocks["token"].to_pylist(), strict=True)):
        spans.setdefault(token, []).append(slice(first[i], first[i + 1]))
    asked = asked.sort_by([("query_id", "ascending"), ("view", "ascending"), ("token", "ascending")])
    ids, rows = asked["query_id"].to_pylist(), zip(asked["view"].to_pylist(), asked["token"].to_pylist(), asked["w"].to_pylist(), strict=True)
    found: dict[str, list] = {"query_id": [], "name": [], "n": [], "score": []}
    for query, tokens in groupby(zip(ids, rows, strict=True), key=lambda x: x[0]):
        hits = [(at, w) for _, (view, token, w) in tokens for at in spans.get((view, token), ())]
        if not hits:
            continue
        names = np.concatenate([code[at] for at, _ in hits])
        total = np.bincount(names, np.concatenate([w * gains[at] for at, w in hits]), len(order))
        some = np.flatnonzero(np.bincount(names, minlength=len(order)))
        if len(some) > k:
            some = some[total[some] >= np.partition(total[some], -k)[-k] - _ROUNDING]
        values, place = np.unique(total[some], return_inverse=True)
        # Rounded as Spark does, from the shortest decimals of a number.
        rounded = np.array([float(Decimal(repr(float(v))).quantize(Decimal("1e-6"), ROUND_HALF_UP)) for v in values])[place]
        best = np.lexsort((some, -rounded))[:k]
        found["query_id"] += [query] * len(best)
        found["name"].append(coded.dictionary.take(pa.array(order[some[best]])))
        found["n"].append(borne[some[best]])
        found["score"].append(rounded[best])
    if not found["query_id"]:
        return schema.empty_table()
    columns = [pa.array(found["query_id"], schema.field("query_id").type), pa.chunked_array(found["name"]).combine_chunks().cast(pa.string()), np.concatenate(found["n"]), np.concatenate(found["score"])]
    return pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=schema)


def search_names(index: DataFrame, queries: DataFrame, k: int = 10, shards: int = 8, block: int = 256) -> DataFrame:
    """(query_id, name, n, score, rank): the k best names of each query (query_id, text).

    The score is the sum over the three views of boost * BM25; a name needs a hit in one view. Document
    counts and lengths are those of records, so a name borne by many records counts as often.

    Names are dealt to shards and queries to parts of bounded size (`shards` is the least number). A task has the postings
    of one shard beside the queries of one part, adds up the scores of the shard's names and keeps the k best of each query,
    so what is shuffled is the postings and the queries' tokens, and k names for each query and shard, and not a row for
    every name that a query hits. The result is that of scoring every name.
    """
    weights = written(token_weights(index, queries).where(F.col("query_id").isNotNull()), "token-weights")
    held = index.agg(F.approx_count_distinct("name").alias("n")).first()["n"]
    shards = max(shards, -(-held // _NAMES))
    parts = max(1, -(-weights.agg(F.approx_count_distinct("query_id").alias("n")).first()["n"] // _QUERIES))
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = lambda count, name: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    blocks = impact_blocks(index, shards, block).select("shard", "view", "token", "postings", every(parts, "part")).repartition(n, "shard", "part")
    asked = weights.select("*", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int").alias("part"))
    asked = asked.select("*", every(shards, "shard")).repartition(n, "shard", "part")
    schema = T.StructType([weights.schema["query_id"], *T.StructType.fromDDL("name string, n long, score double")])
    fields = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        return _best_of_shard(left, right, k, fields)

    scored = blocks.groupBy("shard", "part").cogroup(asked.groupBy("shard", "part")).applyInArrow(best, schema)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "name"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)

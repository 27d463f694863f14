"""Collocations of each language, by best-first branch and bound over prefixes.

A phrase of two or three words is scored by its weakest cut: a^2 / (l r) for its count a and the counts l and r of
the two parts. Counts of words come first, then of pairs whose words are frequent. A pair is a branch: no phrase
that begins with it can score more than a / f(first word), since the rest of the phrase is at least as frequent as
the phrase. The frontier of each language is grown in order of this bound: down to a level taken from the scores
of its best pairs, then to deeper levels, until its first `limit` survivors all lie at or above the level. What lies
at a level is complete, ties included: every branch whose bound reaches it has been counted, as have the longer
phrases on both sides of every pair that reaches it, which may drop the pair.

Counting jobs are given the frontier as bitmaps of fixed size; a bit set by chance adds rows to count, never takes
any away. Counts are of the words themselves, added by Spark. Each task adds up blocks of about `_BYTES` bytes of text
first. Nothing but one flag per level reaches the driver; the bitmaps have `bits` bits at any size of the corpus.

Null and empty texts have no words; null languages count as `und`. Rows that repeat count as often as they occur.
A text of any length is counted whole, in memory of some ten bytes per byte of it. Ties are settled by count and then
by the bytes of the phrase. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordloom.llm.wordids import Numbered, from_bytes, grouped, number, tally
from recordloom.llm.words import LOWER, mix, prefix_hash, span_hash
from recordloom.scratch import written

_BYTES = 3 << 19
_BITS = 1 << 25

_PIECE = np.zeros(256, dtype=bool)
_PIECE[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_KEPT = ~_PIECE
_KEPT[[0x20, 0x09]] = False


def _word_hashes(words: pa.Array) -> np.ndarray:
    """Hashes for the bitmaps. Equal words have equal hashes; unequal ones may."""
    at = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8) if words.buffers()[2] else np.zeros(0, dtype=np.uint8)
    return mix(span_hash(prefix_hash(data), at[:-1], at[1:]), 3)


def _combined(hashes: list[np.ndarray]) -> np.ndarray:
    """One hash of a language and words."""
    out = hashes[0]
    for h in hashes[1:]:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h, 5)
    return out


def _has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slots = (hashes % np.uint64(8 * len(bitmap))).astype(np.int64)
    return (bitmap[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def _bitmap(rows: DataFrame, size: int, *names: str) -> np.ndarray:
    """A bitmap of fixed size with the bits of all rows set, made from partial ones of each task. The rows hold
    hashes, or a language and words."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(size // 64, dtype=np.uint64)
        for batch in batches:
            parts = [c.to_numpy().view(np.uint64) if pa.types.is_int64(c.type) else _word_hashes(c.cast(pa.string())) for c in batch.columns]
            slots = (_combined(parts) % np.uint64(size)).astype(np.int64)
            np.bitwise_or.at(words, slots >> 6, np.uint64(1) << (slots & 63).astype(np.uint64))
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at].view(np.int64))], names=["slot", "bits"])

    # One row per 64 bits: at most size / 64 rows reach the driver.
    found = rows.select(*names).mapInArrow(bits, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size // 64, dtype=np.uint64)
    out[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out.view(np.uint8)


class _Block:
    """The words of a block, numbered by language and word."""

    def __init__(self, batch: pa.RecordBatch):
        w: Numbered = number(batch.column(1), _KEPT, LOWER)
        langs = batch.column(0).dictionary_encode()
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[w.text_of()]
        # A word of one language has one number.
        self.keys, self.ids = np.unique(lang * max(1, len(w.distinct)) + w.ids, return_inverse=True)
        self.lang_of, word_of = np.divmod(self.keys, max(1, len(w.distinct)))
        self.langs, self.words = langs.dictionary, w.distinct.take(pa.array(word_of))
        self.numbered = w

    def follows(self) -> np.ndarray:
        w = self.numbered
        breaks = np.concatenate([[0], np.cumsum(_PIECE[w.data], dtype=np.int32)])
        return (breaks[w.starts[1:]] == breaks[w.ends[:-1]]) & (np.diff(w.text_of()) == 0)

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Those of each word's language and of the word."""
        return _word_hashes(self.langs)[self.lang_of], _word_hashes(self.words)

    def rows(self, columns: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
        words = [self.words.take(pa.array(c)) for c in columns]
        lang = self.langs.take(pa.array(self.lang_of[columns[0]]))
        names = ["lang", *[f"w{i + 1}" for i in range(len(words))], "c"]
        return pa.RecordBatch.from_arrays([lang, *words, pa.array(counts)], names=names)


def _texts(documents: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return documents.select(lang.alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in grouped(batches, "text", _BYTES):
        block = _Block(batch)
        if len(block.ids):
            yield block


def _added(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy("lang", *keys).agg(F.sum("c").alias("f"))


def word_counts(documents: DataFrame, least: int) -> DataFrame:
    """(lang, w1, f) for words with at least `least` places; a row without a word counts all words of its language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            at, counts = tally(block.ids)
            yield block.rows([at], counts)
            langs, counts = tally(block.lang_of[block.ids])
            none = pa.nulls(len(langs), pa.string())
            yield pa.RecordBatch.from_arrays([block.langs.take(pa.array(langs)), none, pa.array(counts)], names=["lang", "w1", "c"])

    found = _added(_texts(documents).mapInArrow(run, "lang string, w1 string, c long"), "w1")
    return found.where(F.col("w1").isNull() | (F.col("f") >= least))


def pair_hashes(documents: DataFrame, frequent: np.ndarray, least: int) -> DataFrame:
    """(h): hashes of pairs which together have at least `least` places, those of all pairs with as many among them.
    `frequent` has the bits of all words with as many. Pairs are many and mostly rare; their hashes are short."""
    sent = documents.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            langs, words = block.hashes()
            often = _has(sent.value, _combined([langs, words]))[block.ids]
            at = np.flatnonzero(block.follows() & often[:-1] & often[1:])
            a, b = block.ids[at], block.ids[at + 1]
            hashes, counts = tally(_combined([langs[a], words[a], words[b]]).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(counts)], names=["h", "c"])

    counted = _texts(documents).mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("f"))
    return counted.where(F.col("f") >= least).select("h")


def pair_counts(documents: DataFrame, possible: np.ndarray, least: int) -> DataFrame:
    """(lang, w1, w2, f) for pairs with at least `least` places; `possible` has the bits of all such pairs."""
    sent = documents.sparkSession.sparkContext.broadcast(possible)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            langs, words = block.hashes()
            at = np.flatnonzero(block.follows())
            a, b = block.ids[at], block.ids[at + 1]
            at = at[_has(sent.value, _combined([langs[a], words[a], words[b]]))]
            keys, counts = tally(block.ids[at] * len(block.keys) + block.ids[at + 1])
            yield block.rows(list(np.divmod(keys, len(block.keys))), counts)

    found = _added(_texts(documents).mapInArrow(run, "lang string, w1 string, w2 string, c long"), "w1", "w2")
    return found.where(F.col("f") >= least)


def triple_counts(documents: DataFrame, frequent: np.ndarray, branches: np.ndarray, wanted: np.ndarray, least: int) -> DataFrame:
    """(lang, w1, w2, w3, f) for triples with at least `least` places that begin with a branch or end with a wanted pair."""
    sent = documents.sparkSession.sparkContext.broadcast((frequent, branches, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, branches, wanted = sent.value
        for block in _blocks(batches):
            if len(block.ids) < 3:
                continue
            size, (langs, words) = len(block.keys), block.hashes()
            pairs, which = np.unique(np.where(block.follows(), block.ids[:-1] * size + block.ids[1:], -1), return_inverse=True)
            a, b = np.divmod(pairs, size)
            hashes = _combined([langs[a], words[a], words[b]])
            often, grown, asked = (_has(m, hashes) & (pairs >= 0) for m in (frequent, branches, wanted))
            left, right = which[:-1], which[1:]
            at = np.flatnonzero(often[left] & often[right] & (grown[left] | asked[right]))
            keys, counts = tally(which[at] * size + block.ids[at + 2])
            pair, third = np.divmod(keys, size)
            yield block.rows([a[pair], b[pair], third], counts)

    found = _added(_texts(documents).mapInArrow(run, "lang string, w1 string, w2 string, w3 string, c long"), "w1", "w2", "w3")
    return found.where(F.col("f") >= least)


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)), exact for counts below 10^15."""
    wide = [f"cast({c} as decimal(15,0))" for c in (a, left, right)]
    return F.expr(f"cast(cast(1000000 as decimal(7,0)) * ({wide[0]} * {wide[0]}) div ({wide[1]} * {wide[2]}) as bigint)")


def _branches(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs with the counts of their words, their score, and the bound of all phrases that begin with them."""
    first = words.select("lang", "w1", F.col("f").alias("l"))
    second = words.select("lang", F.col("w1").alias("w2"), F.col("f").alias("r"))
    counted = pairs.withColumnRenamed("f", "a").join(first, ["lang", "w1"]).join(second, ["lang", "w2"])
    bound = F.expr("cast(1000000 * cast(a as decimal(15,0)) div cast(l as decimal(15,0)) as bigint)")
    return counted.select("lang", "w1", "w2", "a", "l", "r", _score("a", "l", "r").alias("score"), bound.alias("bound"))


def _levels(phrases: DataFrame, depth: int) -> DataFrame:
    """(lang, level): the score of each language's phrase number `depth`; 0, which every branch reaches, if it has fewer.
    A language has at most 1,000,001 scores, however many phrases."""
    scores = phrases.groupBy("lang", "score").agg(F.count("*").alias("c"))
    down_to = F.sum("c").over(W.partitionBy("lang").orderBy(F.desc("score")))
    reached = scores.withColumn("down_to", down_to).where(F.col("down_to") >= depth).groupBy("lang").agg(F.max("score").alias("level"))
    return scores.select("lang").distinct().join(reached, "lang", "left").select("lang", F.coalesce("level", F.lit(0).cast("long")).alias("level"))


def _survivors(pairs: DataFrame, wanted: DataFrame, triples: DataFrame, levels: DataFrame, share: int) -> DataFrame:
    """All phrases of the open languages that reach their level and are not dropped for a longer one."""
    left = pairs.select("lang", "w1", "w2", F.col("a").alias("a12"), F.col("l").alias("f1"))
    right = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("a23"), F.col("r").alias("f3"))
    scored = (
        triples.withColumnRenamed("f", "a")
        .join(left, ["lang", "w1", "w2"])
        .join(right, ["lang", "w2", "w3"])
        .withColumns({"s1": _score("a", "f1", "a23"), "s2": _score("a", "a12", "f3")})
    )
    first = F.col("s1") <= F.col("s2")
    longer = scored.join(levels, "lang").select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        F.when(first, F.col("f1")).otherwise(F.col("a12")).alias("l"),
        F.when(first, F.col("a23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
        "level",
    )
    inside = triples.select("lang", "w1", "w2", "f").union(triples.select("lang", "w2", "w3", "f"))
    most = inside.groupBy("lang", "w1", "w2").agg(F.max("f").alias("most"))
    kept = wanted.join(most, ["lang", "w1", "w2"], "left").where(F.coalesce(100 * F.col("most") < share * F.col("a"), F.lit(True)))
    shorter = kept.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score", "level")
    return longer.where("score >= level").unionByName(shorter)


def collocations(documents: DataFrame, limit: int = 2000, least: int = 10, share: int = 50, bits: int = _BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best `limit` phrases of two or three words with at least
    `least` places. A phrase inside a longer one with at least `share` percent of its places is dropped. `bits` is a
    multiple of 64."""
    words = written(word_counts(documents, least), "phrase-words")
    totals = words.where("w1 is null").select("lang", F.col("f").alias("n"))
    words = words.where("w1 is not null")
    possible = _bitmap(pair_hashes(documents, _bitmap(words, bits, "lang", "w1"), least), bits, "h")
    pairs = pair_counts(documents, possible, least)
    pairs = written(_branches(pairs, words), "phrase-pairs")
    frequent = _bitmap(pairs, bits, "lang", "w1", "w2")
    open_pairs, depth, settled = pairs, 2 * limit, []
    while True:
        levels = written(_levels(open_pairs, depth), "phrase-levels")
        levelled = open_pairs.join(levels, "lang")
        branches, wanted = levelled.where("bound >= level"), levelled.where("score >= level")
        grown = [_bitmap(x, bits, "lang", "w1", "w2") for x in (branches, wanted)]
        triples = written(triple_counts(documents, frequent, *grown, least), "phrase-triples")
        found = written(_survivors(pairs, wanted, triples, levels, share), "phrase-found")
        enough = found.groupBy("lang").agg(F.count("*").alias("found")).where(F.col("found") >= limit).select("lang")
        done = written(enough.union(levels.where("level = 0").select("lang")).distinct(), "phrase-settled")
        settled.append(found.join(done, "lang", "left_semi"))
        open_pairs = open_pairs.join(done, "lang", "left_anti")
        if open_pairs.isEmpty():
            break
        depth *= 8
    every = settled[0]
    for more in settled[1:]:
        every = every.unionByName(more)
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    # Only phrases down to the last place's score are sorted.
    every = every.drop("level").join(_levels(every, limit), "lang").where("score >= level")
    best = every.withColumn("rank", place).where(F.col("rank") <= limit)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

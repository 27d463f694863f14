"""String similarity. All but Jaro are Spark expressions; Jaro runs on Arrow batches with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.text import token_set

# Letters compared at once: bounds the memory of a batch whatever the length of its longest name.
_CELLS = 4_000_000


def _codes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of strings as a zero-padded matrix, and their lengths."""
    fixed = np.asarray(words, dtype=str)
    width = max(fixed.dtype.itemsize // 4, 1)
    matrix = np.ascontiguousarray(fixed.astype(f"<U{width}")).view(np.uint32).reshape(len(fixed), width)
    return matrix, np.char.str_len(fixed)


def _front(matrix: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The marked letters of each row, in order, moved to the front."""
    return np.take_along_axis(matrix, np.argsort(~mask, axis=1, kind="stable"), axis=1)


def jaro_of_batch(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Jaro similarity of non-empty strings, all rows at once and one letter of the left side a time."""
    a, la = _codes(left)
    b, lb = _codes(right)
    reach = np.maximum(la, lb) // 2 - 1
    place = np.arange(b.shape[1])
    in_a, in_b = np.zeros(a.shape, dtype=bool), np.zeros(b.shape, dtype=bool)
    rows = np.arange(len(a))
    for i in range(a.shape[1]):
        free = (b == a[:, i, None]) & ~in_b & (np.abs(place - i) <= reach[:, None]) & (i < la)[:, None]
        first = free.argmax(axis=1)
        hit = free[rows, first]
        in_a[hit, i] = True
        in_b[rows[hit], first[hit]] = True
    m = in_a.sum(axis=1)
    width = min(a.shape[1], b.shape[1])
    moved = (_front(a, in_a)[:, :width] != _front(b, in_b)[:, :width]) & (np.arange(width) < m[:, None])
    some = np.maximum(m, 1)
    score = (m / la + m / lb + (m - moved.sum(axis=1) / 2.0) / some) / 3.0
    return np.where(m == 0, 0.0, score)


def _jaro_of_words(words: pa.Array, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Jaro similarity of pairs of `words` of 1 to 64 letters, by index: the places of a letter in a word are the bits
    of a number, so a letter of the left side costs a few operations a row. The scores are those of `jaro_of_batch`."""
    used_words, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    left, right = at[: len(left)], at[len(left) :]
    texts = words.take(pa.array(used_words))
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(lengths.max())
    points = np.array(texts.to_pylist(), dtype=f"<U{width}").view(np.uint32).reshape(len(texts), width)
    inside = np.arange(width) < lengths[:, None]
    # Letters are numbered; what lies behind the end of a word is a letter that occurs nowhere.
    known = np.zeros(int(points.max()) + 1, dtype=bool)
    known[points[inside]] = True
    n_letters = int(known.sum())
    if len(left) > 1 and len(used_words) * (n_letters + 1) > _CELLS:
        half = len(left) // 2
        used_words = pa.array(used_words)
        return np.concatenate([_jaro_of_words(words.take(used_words), left[part], right[part]) for part in (slice(half), slice(half, None))])
    letters = np.where(inside, (np.cumsum(known) - 1)[points], n_letters)
    one, every = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)
    places = np.zeros((len(texts), n_letters + 1), dtype=np.uint64)
    rows = np.arange(len(texts))
    for j in range(width):
        places[rows, letters[:, j]] |= one << np.uint64(j)
    places[:, n_letters] = 0
    places = places.reshape(-1)
    la, lb = lengths[left], lengths[right]
    reach = np.maximum(la, lb) // 2 - 1
    base = right * (n_letters + 1)
    of_a, of_b = letters[left], letters[right]
    in_a, in_b = np.zeros(len(left), dtype=np.uint64), np.zeros(len(left), dtype=np.uint64)
    for i in range(int(la.max())):
        low, high = np.maximum(i - reach, 0).astype(np.uint64), np.clip(i + reach, 0, 63).astype(np.uint64)
        free = places[base + of_a[:, i]] & ~in_b & (every << low) & (every >> (np.uint64(63) - high))
        first = free & (~free + one)
        in_b |= first
        in_a |= (first != 0).astype(np.uint64) << np.uint64(i)
    # Words of one letter never pair.
    in_a[reach < 0] = 0
    m = np.bitwise_count(in_a).astype(np.int64)
    moved = np.zeros(len(left), dtype=np.int64)
    row_a = np.arange(len(left)) * width
    of_a, of_b = of_a.reshape(-1), of_b.reshape(-1)
    for k in range(int(m.max())):
        a = np.bitwise_count((in_a & (~in_a + one)) - one)
        b = np.bitwise_count((in_b & (~in_b + one)) - one)
        differ = of_a[row_a + np.minimum(a, width - 1)] != of_b[row_a + np.minimum(b, width - 1)]
        moved += differ & (k < m)
        in_a &= in_a - one
        in_b &= in_b - one
    some = np.maximum(m, 1)
    score = (m / la + m / lb + (m - moved / 2.0) / some) / 3.0
    return np.where(m == 0, 0.0, score)


def jaro_array(left: pa.Array, right: pa.Array) -> pa.Array:
    """Jaro similarity of two string arrays; a NULL on either side gives NULL."""
    # Names repeat, so each is taken apart once.
    coded = pa.concat_arrays([left, right]).dictionary_encode()
    words, at = coded.dictionary, coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    a, b = at[: len(left)], at[len(left) :]
    lengths = np.append(pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64), 0)
    la, lb = lengths[a], lengths[b]
    known = (a >= 0) & (b >= 0)
    out = np.full(len(a), np.nan)
    out[known & ((la == 0) != (lb == 0))] = 0.0
    same = known & (a == b)
    out[same] = np.where(la[same] == 1, 0.0, 1.0)
    todo = known & (la > 0) & (lb > 0) & ~same
    longer = np.maximum(la, lb)
    short = np.flatnonzero(todo & (longer <= 64))
    rows = max(1, _CELLS // 64)
    for start in range(0, len(short), rows):
        part = short[start : start + rows]
        out[part] = _jaro_of_words(words, a[part], b[part])
    todo = np.flatnonzero(todo & (longer > 64))
    # Rows of like length go together, in slices of bounded size.
    todo = todo[np.argsort(longer[todo], kind="stable")]
    texts = np.array(words.to_pylist() if len(todo) else [], dtype=object)
    start = 0
    while start < len(todo):
        end = start + max(1, _CELLS // int(longer[todo[start]]))
        longest = int(longer[todo[start:end]].max())
        part = todo[start : start + max(1, _CELLS // longest)]
        out[part] = jaro_of_batch(texts[a[part]], texts[b[part]])
        start += len(part)
    return pa.array(out, mask=~known)


# Declared nondeterministic so that the optimiser evaluates it once where it stands, instead of a
# second time inside every filter on a value derived from it.
_jaro = F.arrow_udf(jaro_array, T.DoubleType()).asNondeterministic()


def levenshtein(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b)


def levenshtein_norm(a: Column, b: Column) -> Column:
    """1 - distance / longer length; two empty strings give 0."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(0.0)).otherwise(1.0 - F.levenshtein(a, b) / longest)


def jaro(a: Column, b: Column) -> Column:
    """Jaro similarity with window max/2 - 1 (so one-letter strings never pair) and halved
    transpositions kept as a fraction. Both empty gives 1, one empty 0."""
    return _jaro(a, b)


def winkler(jaro_score: Column, a: Column, b: Column, p: float = 0.1) -> Column:
    """A Jaro score, raised by the common prefix (up to 4 letters) when it is at least 0.7."""
    shorter = F.least(F.length(a), F.length(b))
    prefix = F.lit(0)
    for k in range(1, 5):
        prefix = prefix + ((shorter >= k) & (F.substring(a, 1, k) == F.substring(b, 1, k))).cast("int")
    return F.when(jaro_score < 0.7, jaro_score).otherwise(jaro_score + prefix * F.lit(p) * (1.0 - jaro_score))


def with_jaro_winkler(df: DataFrame, a: str, b: str, jaro_col: str = "jaro", out: str = "name_jaro_winkler") -> DataFrame:
    """Add the Jaro and Jaro-Winkler similarity of two string columns."""
    scored = df.withColumn(jaro_col, jaro(F.col(a), F.col(b)))
    return scored.withColumn(out, winkler(F.col(jaro_col), F.col(a), F.col(b)))


def set_jaccard(ta: Column, tb: Column) -> Column:
    """Overlap of two arrays of distinct tokens; both empty gives 1, one empty 0."""
    common = F.size(F.array_intersect(ta, tb))
    return (
        F.when((F.size(ta) == 0) & (F.size(tb) == 0), F.lit(1.0))
        .when((F.size(ta) == 0) | (F.size(tb) == 0), F.lit(0.0))
        .otherwise(common.cast("double") / (F.size(ta) + F.size(tb) - common))
    )


def token_jaccard(norm_a: Column, norm_b: Column) -> Column:
    """Overlap of the token sets of two normalised names."""
    return set_jaccard(token_set(norm_a), token_set(norm_b))


def agree(a: Column, b: Column) -> Column:
    """Both present, non-empty and equal; never NULL."""
    return F.coalesce((a == b) & (a != ""), F.lit(False))

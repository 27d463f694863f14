import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordloom.functions import absent, similarity, text
from recordloom.functions.phonetic import metaphone
from recordloom.schema import source_column


def one(spark, value, f, type_="string"):
    return spark.createDataFrame([(value,)], f"c {type_}").select(f(F.col("c")).alias("r")).first()["r"]


def pair(spark, a, b, f):
    return spark.createDataFrame([(a, b)], "a string, b string").select(f(F.col("a"), F.col("b")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "f, value, expected",
    [
        (text.normalize_name, "Tetraphenyl-Borate (TPB)", "tetraphenyl borate tpb"),
        (text.normalize_name, "Thé Maleate", "the maleate"),
        (text.normalize_name, "ﬁx  İt\t", "fix it"),
        (text.normalize_name, None, ""),
        (text.strip_salts, "Brovanil Hydrochloride", "brovanil"),
        (text.strip_salts, "Quentolac Sodium", "quentolac"),
        (text.strip_salts, "Sodium Citrate Dibasic", "dibasic"),
        (text.strip_salts, "Sodium Chloride", "sodium chloride"),
        (text.strip_salts, "", ""),
        (text.blocking_key, "Brovanil Hydrochloride", "brovan"),
        (text.blocking_key, "A B", "ab"),
        (text.inchikey_skeleton, "BSYNRYMUTXBXSQ-UHFFFAOYSA-N", "BSYNRYMUTXBXSQ"),
        (text.inchikey_skeleton, "tooshort", None),
        (text.is_valid_cas, "50-78-2", True),
        (text.is_valid_cas, "50782", True),
        (text.is_valid_cas, "7732-18-5", True),
        (text.is_valid_cas, "50-78-3", False),
        (text.is_valid_cas, "not-a-cas", False),
        (text.is_valid_cas, "1-23", False),
        (text.is_valid_cas, None, False),
        (text.edge_ngrams, "abc", ["ab", "abc"]),
        (text.edge_ngrams, "a", []),
        (absent.registry_value, " null ", None),
        (absent.registry_value, "NULL", "NULL"),
        (absent.registry_value, ".", "."),
        (absent.markup_value, "null", "null"),
        (absent.markup_value, " \t", None),
        (absent.flat_file_value, "Null", None),
        (absent.flat_file_value, " . ", None),
        (absent.flat_file_value, " x ", "x"),
        (source_column, "KEGG", "kegg_id"),
        (source_column, "nope", None),
    ],
)
def test_values(spark, f, value, expected):
    assert one(spark, value, f) == expected


def plain_jaro(a, b):
    """Jaro from its definition, letter by letter."""
    if not a or not b:
        return float(a == b)
    reach = max(len(a), len(b)) // 2 - 1
    taken, left = set(), []
    for i, letter in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if j not in taken and b[j] == letter:
                taken.add(j)
                left.append(letter)
                break
    if not left:
        return 0.0
    moved = sum(x != b[j] for x, j in zip(left, sorted(taken)))
    m = len(left)
    return (m / len(a) + m / len(b) + (m - moved / 2) / m) / 3


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("abcdé ", max_size=14), st.text("abcdé ", max_size=14)), min_size=1, max_size=20))
def test_jaro_batch_equals_definition(pairs):
    got = similarity.jaro_array(pa.array([a for a, _ in pairs]), pa.array([b for _, b in pairs])).to_pylist()
    assert np.allclose(got, [plain_jaro(a, b) for a, b in pairs])


def test_jaro_slices_and_nulls(monkeypatch):
    monkeypatch.setattr(similarity, "_CELLS", 40)
    a = ["martha", None, "x" * 30, "dixon", "", "a"]
    b = ["marhta", "y", "x" * 29 + "y", "dicksonx", "", "a"]
    got = similarity.jaro_array(pa.array(a), pa.array(b)).to_pylist()
    assert got[1] is None and got[5] == 0.0
    assert np.allclose([g for g in got if g is not None], [plain_jaro(x, y) for x, y in zip(a, b) if x is not None])


@pytest.mark.parametrize(
    "a, b, expected",
    [("paracetamol", "paracetamol", 1.0), ("brovanilin", "brovanili", 0.98), ("martha", "marhta", 0.961111), ("a", "a", 0.0)],
)
def test_jaro_winkler(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    row = similarity.with_jaro_winkler(df, "a", "b").first()
    assert row["name_jaro_winkler"] == pytest.approx(expected, abs=1e-6)


def test_other_similarities(spark):
    assert pair(spark, "kitten", "sitting", similarity.levenshtein) == 3
    assert pair(spark, "", "", similarity.levenshtein_norm) == 0.0
    assert pair(spark, "kitten", "sitting", similarity.levenshtein_norm) == pytest.approx(4 / 7)
    assert pair(spark, "acetylsalicylic acid", "acid acetylsalicylic", similarity.token_jaccard) == 1.0
    assert pair(spark, "", "", similarity.token_jaccard) == 1.0
    assert pair(spark, "", "x", similarity.token_jaccard) == 0.0
    assert pair(spark, "", "", similarity.agree) is False
    assert pair(spark, None, "x", similarity.agree) is False


@pytest.mark.parametrize(
    "word, code",
    [("phone", "FN"), ("knot", "NT"), ("church", "XRX"), ("thumb", "0M"), ("aspirin", "ASPR"), ("school", "SKL"), ("42", None)],
)
def test_metaphone(spark, word, code):
    assert one(spark, word, metaphone) == code


def test_jaro_by_bits_is_jaro_by_letters(monkeypatch):
    rng = random.Random(5)
    for letters in ("ab", "abcdefghijklmnopqrstuvwxyz ", "日本語中文𝒳𝒴é"):
        pool = ["".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 9, 40, 63, 64, 65, 90]))) for _ in range(200)]
        left = [rng.choice(pool) for _ in range(3000)]
        right = [rng.choice(pool) if rng.random() < 0.6 else "".join(rng.sample(x, len(x))) for x in left]
        apart = [(a, b) for a, b in zip(left, right) if a != b]
        want = similarity.jaro_of_batch(*[np.array(x, dtype=object) for x in zip(*apart)])
        for cells in (4_000_000, 2000):
            monkeypatch.setattr(similarity, "_CELLS", cells)
            got = similarity.jaro_array(*[pa.array(x) for x in zip(*apart)])
            assert got.to_pylist() == want.tolist()
    assert similarity.jaro_array(pa.array(["", None, "", "a", "ab"]), pa.array(["", "a", "a", "a", "ab"])).to_pylist() == [1.0, None, 0.0, 0.0, 1.0]
    # Names that many pairs share are taken apart once.
    monkeypatch.setattr(similarity, "jaro_of_batch", None)
    assert similarity.jaro_array(pa.array(["martha"] * 5000), pa.array(["marhta"] * 5000)).to_pylist() == pytest.approx([0.9444444] * 5000)

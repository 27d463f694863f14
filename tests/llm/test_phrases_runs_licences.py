"""Collocations, periodic runs and licence spans against brute force, on rows with all the odd cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from recordloom.llm import collocations, licences, periods
from recordloom.llm.queries import op12_periodic_runs
from recordloom.llm.wordids import grouped, number
from recordloom.llm.words import ALPHANUMERIC, LOWER, NOT_SPACE, UNCHANGED

A_TO_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, c long, phrase string, w1 string, runs long, label string"


def rows_of(spark, texts, langs=None):
    """Texts with extra columns whose names clash with those of intermediate tables."""
    langs = langs or [None] * len(texts)
    return spark.createDataFrame([(i, t, lang, "s", 1, "p", "w", 2, "l") for i, (t, lang) in enumerate(zip(texts, langs, strict=True))], SCHEMA)


# ---- words -----------------------------------------------------------------------------------------


def test_words_are_told_apart_by_their_bytes():
    # Hashes of these two, by powers of any odd radix, are equal.
    signs = [bin(i).count("1") % 2 for i in range(1024)]
    one, other = ("".join("ab"[s ^ flip] for s in signs) for flip in (0, 1))
    w = number(pa.array([f"{one} {other}", None, "", f" {other}\x00 x"]), NOT_SPACE, UNCHANGED)
    assert w.ids[0] != w.ids[1] and w.first.tolist() == [0, 2, 2, 2, 4]
    assert w.distinct.take(pa.array(w.ids)).to_pylist() == [one, other, other + "\x00", "x"]


def test_words_of_adjacent_texts_stay_apart():
    w = number(pa.array(["Abc", "def", "é x"]), ALPHANUMERIC, LOWER)
    assert w.distinct.take(pa.array(w.ids)).to_pylist() == ["abc", "def", "é", "x"]
    assert w.first.tolist() == [0, 1, 2, 4]


def test_grouped_batches_hold_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * (i % 50) for i in range(500)] + ["b" * 5000, None, ""]})
    parts = list(grouped(iter([batch.slice(0, 100), batch.slice(100, 0), batch.slice(100)]), "text", 1000))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert len(parts) > 8 and list(grouped(iter([]), "text", 10)) == []


# ---- collocations ----------------------------------------------------------------------------------


def brute_collocations(texts, langs, limit, least, share):
    counts = collections.defaultdict(collections.Counter)
    for text, lang in zip(texts, langs, strict=True):
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(A_TO_Z)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                counts["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * c >= share * a for q, c in candidates.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:limit], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def collocation_rows(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("limit", "least", "share"), [(5, 2, 50), (40, 3, 100), (2000, 2, 30)])
def test_collocations_are_those_of_counting_everything(spark, limit, least, share):
    rng = random.Random(limit)
    words = [f"w{i}" for i in range(12)] + ["Ünd", "é", "日本", "x\x00y", "A", "a"]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", "", ",", "\n", "\t", ". "]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    # Fixed phrases, repeated rows, a long text of one word, odd texts.
    texts += ["strong tea of mine"] * 9 + ["strong tea. of course"] * 4 + ["na " * 5000, None, "", " \t\n", "one", "...", "x" * 3000]
    langs = [rng.choice(["en", "de", None, ""]) for _ in texts]
    got = collocation_rows(collocations.collocations(rows_of(spark, texts, langs), limit, least, share))
    assert got == brute_collocations(texts, langs, limit, least, share)


def test_frontier_grows_until_enough_survive(spark, monkeypatch):
    # The best pairs are dropped for triples of low score, so the first level leaves nothing.
    texts = [t for i in range(40) for t in [f"x a{i} b{i}"] * 6 + [f"a{i} b{i}"] * 4] + [f"u{i % 5} v{i % 3}" for i in range(300)]
    depths = []
    levels = collocations._levels
    monkeypatch.setattr(collocations, "_levels", lambda pairs, depth: depths.append(depth) or levels(pairs, depth))
    got = collocation_rows(collocations.collocations(rows_of(spark, texts, ["en"] * len(texts)), 10, 6, 50))
    assert got == brute_collocations(texts, ["en"] * len(texts), 10, 6, 50)
    assert depths == [20, 160, 10] and len(got) == 10


def test_crowded_bitmaps_only_add_work(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(40)) for _ in range(30)]
    got = collocation_rows(collocations.collocations(rows_of(spark, texts), 10, 2, 50, bits=64))
    assert got == brute_collocations(texts, [None] * 30, 10, 2, 50)


def test_large_counts_stay_exact(spark):
    a, left, right = 900_000_000_001, 900_000_000_003, 900_000_000_007
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert row.select(collocations._score("a", "l", "r")).first()[0] == 1_000_000 * a * a // (left * right)


def test_no_documents_no_collocations(spark):
    assert collocation_rows(collocations.collocations(rows_of(spark, []))) == []
    assert collocation_rows(collocations.collocations(rows_of(spark, [None, ""]))) == []


# ---- periodic runs ---------------------------------------------------------------------------------


def brute_runs(w, least=24, times=3):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - start >= max(least, times * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic(rng, size):
    w = []
    while len(w) < size:
        if rng.random() < 0.5:
            w += [rng.randint(0, rng.choice([1, 2, 40])) for _ in range(rng.randint(1, 15))]
        else:
            unit = [rng.randint(0, rng.choice([1, 3, 9])) for _ in range(rng.randint(1, 12))]
            w += (unit * rng.randint(2, 30))[: rng.randint(1, 90)]
    return w


@pytest.mark.parametrize(("least", "times"), [(24, 3), (6, 2), (10, 3), (12, 4)])
def test_runs_are_those_of_comparing_all_places(least, times):
    rng = random.Random(least)
    for _ in range(80):
        texts = [periodic(rng, rng.randint(0, 120)) for _ in range(rng.randint(1, 5))]
        ids = np.array([x for t in texts for x in t], dtype=np.int64)
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        got = periods.find_runs(ids, first, least, times)
        assert [got.get(i, []) for i in range(len(texts))] == [brute_runs(t, least, times) for t in texts]


def test_long_run_takes_linear_work():
    assert periods.find_runs(np.zeros(60_000, dtype=np.int64), np.array([0, 60_000])) == {0: [(0, 60_000, 1)]}
    line = np.random.default_rng(1).integers(0, 1000, 40)
    broken = np.concatenate([np.append(line, 1000 + i) for i in range(1000)])
    assert periods.find_runs(broken, np.array([0, len(broken)])) == {}


def expected_runs(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join("%d,%d,%d\n" % r for r in runs), " ".join(x for i, x in enumerate(w) if i not in dropped))]
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *sha)


def test_run_query_against_brute_force(spark, tmp_path):
    rng = random.Random(9)
    texts = [" ".join(f"t{x}" for x in periodic(rng, rng.randint(0, 300))) for _ in range(120)]
    texts += [None, "", " \n ", "one", "la " * 23, "la " * 24, "la\tla\n" * 500, "a b c " * 8, "x" * 200_000, "  lead and  trail \x0b", "la " * 24, "\x00 é " * 30]
    rows_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect())
    assert got == [expected_runs(i, t) for i, t in enumerate(texts)]


def test_collapsed_texts(spark):
    kept = periods.collapse(rows_of(spark, ["go " + "ha ho " * 20 + "stop", None, "a  b\n"])).orderBy("doc_id").collect()
    assert [r["collapsed"] for r in kept] == ["go ha ho stop", "", "a b"]
    assert [tuple(x) for x in kept[0]["runs"]] == [(1, 40, 2)]


def test_no_documents_no_runs(spark):
    assert periods.summary(periods.collapse(rows_of(spark, []))).collect() == []


def test_rows_without_an_id_are_judged_as_they_stand(spark):
    rows = spark.createDataFrame([(None, "la " * 30), (None, None)], "doc_id long, text string")
    assert sorted(r["n_runs"] for r in periods.summary(periods.collapse(rows, looped=True, texts=False)).collect()) == [0, 1]


# ---- licences --------------------------------------------------------------------------------------


def test_matching_statistics_and_phrases_are_exact():
    rng = random.Random(4)
    for _ in range(60):
        letters = "abcd"[: rng.randint(1, 4)]
        templates = [(f"t{i}", " ".join(rng.choice(letters) for _ in range(rng.randint(0, 12)))) for i in range(rng.randint(1, 4))]
        phrases = {" ".join(rng.choice(letters) for _ in range(rng.randint(1, 3))): f"p{i}" for i in range(2)}
        a = licences.Automaton(templates, phrases)
        known = [t.split() for _, t in templates] + [p.split() for p in phrases]
        text = [rng.choice(letters + "z") for _ in range(30)]
        matches, places = a.scan([a.vocabulary.get(w, -1) for w in text])
        longest = []
        for i in range(len(text)):
            longest.append(max(n for n in range(i + 2) if n == 0 or any(text[i + 1 - n : i + 1] == k[j : j + n] for k in known for j in range(len(k)))))
        ends = [i + 1 for i in range(len(text)) if longest[i] and (i + 1 == len(text) or longest[i + 1] <= longest[i])]
        assert [(e, n) for e, n, _ in matches if n] == [(e, longest[e - 1]) for e in ends]
        for end, n, state in matches:
            for t, at in a.ends[state] if n else []:
                words = [w for w in [*templates, *[(v, k) for k, v in phrases.items()]] if w[1].split()][t][1].split()
                assert words[at - n : at] == text[end - n : end]
        want = sorted((i, v) for k, v in phrases.items() for i in range(len(text)) if text[i : i + len(k.split())] == k.split())
        assert sorted((i, a.labels[n]) for i, n in places) == want


def naive_places(text, phrases):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_TO_Z))
    return len(w), sorted((i, v) for k, v in phrases.items() for i in range(len(w)) if w[i : i + len(k.split())] == k.split())


MIT = dict(licences.TEMPLATES[:1])["mit"]
LICENSED = [
    None,
    "",
    "Nothing here.",
    MIT,
    "head " + MIT.replace("modify, merge", "modify / adapt, merge") + " tail",
    " ".join(MIT.split()[:30]),
    "All rights reserved. all RIGHTS reserved; all rights " * 40,
    "© é CC-BY cc,by 4.0\x00 General Public\nLicense",
    "filler " * 200_000 + "cc by",
    "Licensed under CC BY-NC 4.0.",
    MIT,
    "Cc by. " * 3 + MIT + " between " + MIT,
]


def test_licence_scan(spark):
    found = licences.summary(licences.scan(rows_of(spark, LICENSED))).orderBy("doc_id").collect()
    for row, text in zip(found, LICENSED, strict=True):
        n, places = naive_places(text, licences.PHRASES)
        starts = [i for i, _ in places]
        labels = ",".join(sorted({v for _, v in places}))
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == (
            n, len(places), min(starts, default=None), max(starts, default=None), labels
        )
        assert 0.0 <= row["score"] <= 1.0 and (not places or row["score"] == 1.0)
    spans = [[(s["label"], s["first_word"], s["last_word"]) for s in r["spans"]] for r in found]
    size = naive_places(MIT, {})[0]
    assert spans[3] == spans[10] == [("mit", 0, size - 1)]
    assert spans[4] == [("mit", 1, size + 1)]  # one word more
    assert spans[5] == [] and spans[9] == [("cc-by-nc-4.0", 0, 6)]
    assert spans[11] == [("mit", 6, size + 5), ("mit", size + 7, 2 * size + 6)]
    assert found[5]["score"] == 0.0 and found[3]["labels"] == "mit" and found[11]["labels"] == "cc-by,mit"


def test_own_templates_and_empty_tables(spark):
    rows = rows_of(spark, ["one alone x one", "alpha beta gamma delta"])
    found = licences.summary(licences.scan(rows, [("greek", "alpha beta gamma delta"), ("none", "")], {"one": "1"}, least=2)).orderBy("doc_id").collect()
    assert [(r["n_base"], r["first_word"], r["last_word"], r["labels"]) for r in found] == [(2, 0, 3, "1"), (0, None, None, "greek")]
    assert licences.scan(rows, [], {}).count() == 2
    assert licences.summary(licences.scan(rows_of(spark, []))).collect() == []

"""The operators of the training-data pipeline against brute force, on rows with all the odd cases."""

import collections
import hashlib
import re
import tracemalloc
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from recordloom.llm import decontaminate, jaccard, language, neighbours, packing, quality, suffixes, surrogates, toxicity, warc
from recordloom.llm.queries import TOKENIZER
from recordloom.llm.words import ALPHANUMERIC, NOT_SPACE, frugal, slices, words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
PASSAGE = " ".join(f"Common{i}" for i in range(60))
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))


def near(seed: int, edits: int) -> str:
    rng = np.random.default_rng(7)
    base = [f"term{rng.integers(10_000)}" for _ in range(150)]
    for i in np.random.default_rng(seed).integers(0, 150, edits):
        base[i] = f"edit{seed}n{i}"
    return " ".join(base)


TEXTS = [
    (1, "Mail anna.B@x.example.com or +1 (499) 555-6503, it’s Ünder 97.51.17.173."),
    (2, None),
    (3, ""),
    (4, " \n\t"),
    (5, "one two"),
    (6, "ONE two"),
    (7, PASSAGE + " tail of seven " + " ".join(f"a{i}" for i in range(40))),
    (8, "head of eight " + PASSAGE),
    (9, LONG),
    (10, LONG),
    (11, "a" * 900),
    (12, near(1, 1)),
    (13, near(2, 1)),
    (14, near(3, 2)),
    (15, near(4, 60)),
    (15, near(5, 1)),
    (None, "one two three four five six"),
    (None, None),
    (16, "дом Господин Иванов, it's don't <|endoftext|> ½ x² \x00"),
    (17, PASSAGE[:300]),
    (18, "Mr John Smith saw Mrs Smith; anna.b@x.example.com 4111 1111 1111 1111 token = \"1eb9c654e721b4f812088970e66a6345cee33dd6\""),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 0, 9, 9) for i, t in TEXTS]
    # Names that the operators use themselves.
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, id int, n int, token int").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def test_words():
    texts = [t for _, t in TEXTS]
    for kept, pattern in ((ALPHANUMERIC, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (NOT_SPACE, rb"[^\x20\x09-\x0D]+")):
        w = words(pa.array(texts), kept)
        for i, t in enumerate(texts):
            spans = zip(w.starts[w.first[i] : w.first[i + 1]], w.ends[w.first[i] : w.first[i + 1]], strict=True)
            assert [w.data[s:e].tobytes() for s, e in spans] == re.findall(pattern, (t or "").translate(LOWER).encode())


def test_suffix_array():
    rng = np.random.default_rng(1)
    for _ in range(100):
        x = rng.integers(97, 97 + int(rng.integers(1, 5)), int(rng.integers(1, 300))).astype(np.uint8)
        raw, depth = x.tobytes(), int(rng.integers(8, 40))
        keys = [raw[i : i + depth] for i in suffixes.suffix_array(x, depth)]
        assert keys == sorted(raw[i : i + depth] for i in range(len(raw)))


@pytest.mark.parametrize("chunk", [4000, 2])
def test_suffix_dedup(docs, chunk):
    texts = [(t or "").encode() for _, t in TEXTS]
    uses = collections.Counter(b[i : i + 200] for b in texts for i in range(len(b) - 199))
    want = []
    for (doc_id, _), b in zip(TEXTS, texts, strict=True):
        hit = bytearray(len(b))
        for i in range(len(b) - 199):
            if uses[b[i : i + 200]] > 1:
                hit[i : i + 200] = b"\1" * 200
        spans = sum(1 for i in range(len(b)) if hit[i] and not (i and hit[i - 1]))
        want.append((doc_id, len(b), sum(hit), spans, hashlib.sha256(bytes(x for x, h in zip(b, hit, strict=True) if not h)).hexdigest()))
    got = [tuple(r) for r in suffixes.digests(suffixes.removed(docs, chunk=chunk, batch_bytes=2000)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_near_duplicates(docs):
    sets = []
    for doc_id, t in TEXTS:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append((doc_id, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())))
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    want = [(i, len(s), None if i is None else root(i)) for i, s in sets]
    got = [tuple(r) for r in jaccard.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = jaccard.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i in {root(i) for i in parent}) + ["None", "None"]


def test_hot_list_of_copies_and_a_chain(spark):
    rows = [(i, near(100 + i, 2)) for i in range(120)] + [(500 + i, " ".join(f"c{j}" for j in range(i * 8, i * 8 + 120))) for i in range(6)]
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(120)} == {0} and {got[500 + i] for i in range(6)} == {500}


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_contamination(spark, docs, block_bytes):
    items = [(1, " ".join(PASSAGE.split()[5:30])), (2, "Three FOUR five"), (2, "it s"), (3, None), (4, ""), (None, "one two"), (20, "tail of seven a0 a1 a2 a3 a4 a5 a6 zz")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    want = []
    for doc_id, t in TEXTS:
        w, hit, found = split(t), set(), set()
        for item, text in items:
            v = split(text)
            k = min(10, len(v))
            for i in range(len(v) - k + 1 if item is not None and v else 0):
                for j in range(len(w) - k + 1):
                    if w[j : j + k] == v[i : i + k]:
                        hit |= set(range(j, j + k))
                        found.add(item)
        ids = ",".join(sorted(map(str, found)))
        want.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    got = decontaminate.summary(decontaminate.contamination(docs, benchmark, block_bytes=block_bytes))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    clean = decontaminate.clean(docs, benchmark, block_bytes=block_bytes)
    assert clean.columns == docs.columns and clean.count() == sum(not x[-1] for x in want)


def test_packing_round_trip(docs):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    pieces = packing.pack(docs, TOKENIZER, block_tokens=5000).collect()
    by_sequence, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        assert p.length * 4 == len(p.ids)
        by_sequence[p.sequence_id].append(p)
        by_doc[p.doc_id].append(p)
    for rows in by_sequence.values():
        rows.sort(key=lambda p: p.offset)
        total = sum(p.length for p in rows)
        assert [p.offset for p in rows] == [sum(q.length for q in rows[:i]) for i in range(len(rows))]
        assert total & (total - 1) == 0 and total <= 4096
    want = collections.defaultdict(list)
    for doc_id, t in TEXTS:
        want[doc_id].append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4").tobytes())
    for doc_id, texts in want.items():
        if len(texts) == 1:
            rows = sorted(by_doc[doc_id], key=lambda p: p.start)
            assert b"".join(p.ids for p in rows) == texts[0] and {p.doc_tokens for p in rows} == {len(texts[0]) // 4}
    for p in packing.digests(packing.pack(docs, TOKENIZER)).where("doc_id = 1").collect():
        assert p.ids_crc32 == zlib.crc32(want[1][0][4 * p.start : 4 * (p.start + p.length)])


def test_surrogates(docs):
    got = collections.defaultdict(list)
    for r in surrogates.replace(docs, "key").collect():
        got[r.doc_id].append(r.text)
    text = got[18][0]
    assert surrogates.replace(docs, "key").columns == docs.columns
    for secret in ("anna", "Smith", "4111 1111", "1eb9c654e721"):
        assert secret not in text and secret not in got[1][0]
    assert re.fullmatch(r"Mr \w+n (\w+ker) saw Mrs \1; \S+@\S+\.com [\d ]{19} token = \"[0-9a-f]{40}\"", text)
    digits = [int(c) for c in re.search(r"\d[\d ]{18}", text)[0] if c != " "]
    assert sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0
    mail = re.search(r"\S+@\S+\.com", text)[0]
    assert mail in got[1][0] and re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[1][0])
    assert got[2] == [None] and got[3] == [""] and got[9] == [LONG] and sorted(map(str, got[None])) == ["None", "one two three four five six"]


def test_surrogates_of_shouted_texts(spark):
    rows = [
        (1, 'TOKEN = "9233A8ECF7C5B09FE59D"!! Api_Key: 9233a8ecf7c5b09fe59d'),
        (2, "token=9233a8ecf7c5b09fe59d PASSWORD = 'aB3dE5gH7jK9'"),
        (3, "MR JOHN SMITH, mr Smith, FRAU Huber, SEÑORA Lopez, ГОСПОДИН Иванов; programs Xavier"),
    ]
    got = {r.doc_id: r.text for r in surrogates.replace(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()}
    shouted, name, plain = re.fullmatch(r'TOKEN = "([0-9A-F]{20})"!! (Api_Key): ([0-9a-f]{20})', got[1]).groups()
    assert shouted == plain.upper() and plain != "9233a8ecf7c5b09fe59d"
    assert re.fullmatch(rf"token={plain} PASSWORD = '[a-z][A-Z]\d[a-z][A-Z]\d[a-z][A-Z]\d[a-z][A-Z]\d'", got[2]) and "aB3dE5gH7jK9" not in got[2]
    assert re.fullmatch(r"MR [A-Z]+N ([A-Z]+KER), mr ([A-Z][a-z]+ker), FRAU [A-Z][a-z]+, SEÑORA [A-Z][a-z]+, ГОСПОДИН [А-Я][а-я]+; programs Xavier", got[3])
    assert len(set(re.findall(r"\w+ker", got[3], re.I))) == 4 and re.search(r"JOHN|SMITH", got[3], re.I) is None
    assert re.search(r"[A-Z]+KER", got[3])[0].lower() == re.search(r"mr (\w+)", got[3])[1].lower()


def test_surrogates_of_many_names_stay_one_to_one(spark):
    syllables = ["bar", "den", "fil", "gor", "kun", "lat", "mer", "nid", "pos", "rum"]
    surnames = ["".join(syllables[int(c)] for c in f"{i:03d}").capitalize() for i in range(1000)]
    rows = [(i, f"Mr {n} met Mr John {n}, Mrs {n} and Mr. {n.upper()}") for i, n in enumerate(surnames)]
    made = {}
    for r in surrogates.replace(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect():
        one, given, *same = re.fullmatch(r"Mr (\w+) met Mr (\w+) (\w+), Mrs (\w+) and Mr. (\w+)", r.text).groups()
        assert same == [one, one, one.upper()]
        made[r.doc_id] = (one, given)
    assert len({n for n, _ in made.values()}) == 1000 and len({g for _, g in made.values()}) == 1
    assert not {n for n, _ in made.values()} & set(surnames)


def test_names_of_few_syllables_grow(spark):
    """Sixteen stems of one syllable for 300 names, one of which is itself a made-up name."""
    parts = spark.range(300).select(F.lit("family").alias("kind"), F.concat(F.lit("x"), "id").alias("value"))
    parts = parts.unionByName(spark.createDataFrame([("family", "baker"), ("given", "x1")], "kind string, value string"))
    got = surrogates.assign_names(parts, "key", syllables=1).collect()
    assert len({(r.kind, r.stem) for r in got}) == len(got) == 302 and "ba" not in {r.stem for r in got}


WHOLE_ENTITIES = [
    ("Mr John Ronald Reuel Tolkien wrote", r"Mr (\w+n) (\w+n) (\w+n) (\w+ker) wrote"),
    ("Frau Anne-Marie Huber ging", r"Frau (\w+na)-(\w+na) (\w+ker) ging"),
    ("Mr O'Brien's dog and Mr O’Brien", r"Mr (\w+ker)'s dog and Mr \1"),
    ("Mr J. R. R. Tolkien, Mr J.R.R. Tolkien", r"Mr ([A-IK-Z])\. ([A-QS-Z])\. \2\. (\w+ker), Mr \1\.\2\.\2\. \3"),
    ("Herr Prof. Dr. Ludwig von Goethe kam.", r"Herr Prof\. Dr\. \w+n von \w+ker kam\."),
    ("Smith first. Dr Smith came. I saw Smith's and SMITH. Then Mr Smith I think.", r"Smith first\. Dr ((\w+)ker) came\. I saw \1's and [A-Z]+KER\. Then Mr \1 I think\."),
    ("Dr Kim Lee, Mrs Kim Lee", r"Dr (\w+na) (\w+ker), Mrs \1 \2"),
    ("Call (415) 555-0132 or 415-555-0133 or 0171 1234567.", r"Call \((?!415)\d{3}\) \d{3}-\d{4} or (?!415-555)\d{3}-\d{3}-\d{4} or 0(?!171 1234567)\d{3} \d{7}\."),
    ("Amex 3782 822463 10005 ok", r"Amex 3(?!782 822463)\d{3} \d{6} \d{5} ok"),
    ('{"access_token": "' + "a1" * 400 + '"}', r'\{"access_token": "(?!(?:..)*a1a1a1a1)[0-9a-f]{800}"\}'),
    ("token=abcdefabcdef.ghijklghijkl.mnopqr end", r"token=(?!abc)[a-z]{12}\.(?!ghi)[a-z]{12}\.(?!mno)[a-z]{6} end"),
    ("on 2024-05-06 at 10 Downing Street, Mr and Mrs", r"on 2024-05-06 at 10 Downing Street, Mr and Mrs"),
]


def test_surrogates_of_whole_entities(spark):
    rows = [(i, text) for i, (text, _) in enumerate(WHOLE_ENTITIES)]
    got = {r.doc_id: r.text for r in surrogates.replace(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()}
    for i, (text, want) in enumerate(WHOLE_ENTITIES):
        assert re.fullmatch(want, got[i]), (text, got[i])


def test_surrogates_stay_distinct(spark):
    """Two letters and a digit before the domain: many clashes at first."""
    values = spark.range(600).select(F.concat(F.lit("a"), F.col("id") % 10, F.lit("@"), F.chr(97 + (F.col("id") / 10).cast("int") % 26), F.chr(97 + (F.col("id") / 260).cast("int")), F.lit(".com")).alias("value")).distinct()
    got = surrogates.assign(values, "key").collect()
    assert len({r.surrogate for r in got}) == len(got) == values.count()
    assert not {r.surrogate for r in got} & {r.value for r in got}


def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a.example/x", "body\r\n"), (2, "http://b.example", None), (3, None, "body\r\n"), (4, "u", "x\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n\r\n"), (None, "u", "body\r\n"), (5, "u", ""), (6, "u", "ünïcode")]
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2), path)
    records = warc.read_archives(spark, path)
    assert records.count() == 3 * len(pages)
    rows = warc.captures(records).collect()
    got = {r.page_id: r for r in rows}
    assert len(rows) == len(pages) and all(r.request is not None and len(r.metadata) == 1 for r in rows)
    for page_id, _, html in pages:
        raw, r = (html or "").encode(), got[page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), warc.digest(raw))
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == raw
    assert {i: (r.record_type, r.refers_to_page) for i, r in got.items() if r.record_type == "revisit"} == {None: ("revisit", 3), 1: ("revisit", 3), 2: ("revisit", 5)}


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    m = rng.standard_normal((1500, 16)).astype("float32")
    m[100:160] = m[100]
    rows = [(i, v.tolist()) for i, v in enumerate(m)] + [(2000, None), (2001, [0.0] * 16), (2100, [float("nan")] * 16), (2200, [1.0, None] * 8), (None, m[0].tolist()), (2300, [1.0])]
    got = collections.defaultdict(list)
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=100).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    hits, exact = 0, m.astype(np.float64)
    assert sorted(got) == list(range(0, 1500, 100))
    for q, found in got.items():
        d = np.sqrt(((exact - exact[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        want = np.lexsort((np.arange(1500), d))[:10].tolist()
        assert [r for r, _, _ in sorted(found)] == list(range(1, 11))
        assert all(abs(s - d[v]) < 1e-9 for _, v, s in found)
        hits += len({v for _, v, _ in found} & set(want))
    assert hits >= 0.9 * 10 * len(got)
    assert [v for _, v, _ in sorted(got[100])] == list(range(101, 111))


def test_classifiers_and_language_on_held_out_rows(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    truth = {r.doc_id: r for r in labels.collect() if held(r.doc_id)}
    found = quality.score(documents, quality.train(documents, labels)[0]).collect()
    right = [(r.score >= 0.3) == (truth[r.doc_id].quality == 1) for r in found if r.doc_id in truth]
    assert np.mean(right) > 0.95
    found = toxicity.score(documents, toxicity.train(documents, labels)).collect()
    right = [(r.score >= 0.5) == (truth[r.doc_id].toxic == 1) for r in found if r.doc_id in truth]
    assert np.mean(right) > 0.95 and all(0 <= r.score <= 1 for r in found)
    langs = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect() if held(r.doc_id)}
    model = language.train(documents)
    found = language.identify(documents, model).collect()
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in found if r.doc_id in langs]) > 0.95


def test_offending_sentence_and_mixed_spans(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    weights = toxicity.train(documents, spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    text = "The reha onon the. You idiot moron thing of. Ea the and."
    row = toxicity.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), weights).first()
    b, e = row.toxic_sentences[:2]
    assert text.encode()[b:e] == b"You idiot moron thing of" and row.score > 0.5
    model = language.train(documents)
    text = "the and of thing that is the with onthe " * 3 + "der die und ist nicht das schen keit " * 3
    row = language.identify(spark.createDataFrame([(1, text), (2, None), (3, "12 ."), (4, "")], "doc_id long, text string"), model).collect()
    assert [s.lang for s in row[0].spans] == ["en", "de"] and [r.lang_pred for r in row[1:]] == ["und"] * 3


def test_letters_by_category(spark):
    texts = ["naïve Straße ªº x²½", "😀👍 ❤\ufe0f ❤\ufe0fab", "٣٤٥ १२३ １２ \ufffd ×÷ 、。", "ⵜⴰⵎⴰⵣⵉⵖⵜ Ⲁⲃⲅ ⰰⰱ", "\u0301a e\u0301t\u0301 हिन्दी", None, "", "\u0301", "Ａｂ 漢字かな"]
    w, _, letters = language.letter_words(pa.array(texts))
    for i, text in enumerate(texts):
        found = re.findall("[L](?:[LM])*", "".join(unicodedata.category(c)[0] for c in text or ""))
        assert letters[w.first[i] : w.first[i + 1]].tolist() == [run.count("L") for run in found], text
    table = spark.createDataFrame([(i, "the and of thing", "en") for i in range(40)] + [(i, "der die und nicht", "de") for i in range(40, 80)], "doc_id long, text string, lang string")
    model = language.train(table)
    rows = spark.createDataFrame([(1, "😀👍❤\ufe0f"), (2, "٣٤٥ १२३"), (3, "１２３ \ufffd"), (4, "ⵜⴰⵎⴰⵣⵉⵖⵜ")], "doc_id long, text string")
    got = {r.doc_id: r for r in language.identify(rows, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and not got[i].spans for i in (1, 2, 3))
    assert got[4].lang_pred in ("en", "de") and len(got[4].spans) == 1


def test_odd_rows_and_empty_tables(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (5, None, None), (None, 1, 1), (7, 0, 1)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for table in (docs, empty):
        n = table.count()
        for known in (labels, none):
            assert toxicity.score(table, toxicity.train(table, known)).count() == n
            weights, prior = quality.train(table, known)
            assert 0 < prior < 1 and quality.score(table, weights).count() == n and quality.keep(table, weights).columns == table.columns
        assert language.identify(table, language.train(table)).count() == n
        assert decontaminate.contamination(table, benchmark).count() == n
    for made in (jaccard.near_duplicates(empty), jaccard.representatives(empty), suffixes.removed(empty), packing.pack(empty, TOKENIZER), surrogates.replace(empty, "k")):
        assert made.count() == 0
    assert neighbours.nearest(vectors, every=100).count() == 0
    from recordloom.scratch import new_path

    path = new_path(spark, "empty-warc")
    warc.write_archives(pages, path)
    assert warc.captures(warc.read_archives(spark, path)).count() == 0


def test_pipeline_keeps_and_drops(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]
    from recordloom.scratch import written

    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf), "stage")
        counts.append(docs.count())
        assert docs.columns == columns
    assert counts == sorted(counts, reverse=True) and counts[3] == counts[4] > 100
    assert not docs.where(F.col("text").rlike(r"password=(?:0198f9bf)")).count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).select("doc_id").distinct().count() == counts[-1]


def test_long_words_with_equal_sums_stay_apart(spark):
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    docs = spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    item = spark.createDataFrame([(7, a)], "item_id long, text string")
    kept = decontaminate.clean(docs, item)
    assert [r.doc_id for r in kept.collect()] == [2]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    for r in packing.digests(packing.pack(docs, TOKENIZER)).collect():
        ids = [*tokenizer.encode(b if r.doc_id == 2 else a, add_special_tokens=False).ids, 2]
        assert zlib.crc32(np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes()) == r.ids_crc32


def test_texts_are_read_in_small_slices():
    """Many megabytes of text in one batch do not make arrays of many times their size, as a reused worker keeps them."""
    rng = np.random.default_rng(0)
    vocabulary = np.array([f"word{i}" for i in range(500)])
    texts = [" ".join(rng.choice(vocabulary, 250)) for _ in range(3000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    weights = np.zeros(quality.BUCKETS + 1, dtype=np.float32)
    assert sum(map(len, quality._kept(iter([batch.slice(0, 9)]), 1, weights, 0.3))) == 9
    tracemalloc.start()
    kept = sum(map(len, quality._kept(iter([batch]), 1, weights, 0.3)))
    of_quality = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    sets = sum(len(jaccard.shingles(part.column(1))[1]) - 1 for part in slices(batch, "text", jaccard._SLICE))
    of_shingles = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert kept == sets == len(texts)
    assert max(of_quality, of_shingles) < 25e6


def test_marked_prefixes_and_what_workers_hand_back():
    marks = np.zeros(jaccard.BITS // 8 + 8192, dtype=np.uint8)
    marks[4096] = 0b101  # the second block begins with value 1
    lists = [[1, 2, 3], [], [4, 3]]
    batch = pa.RecordBatch.from_pydict({"k1": [7, 8, 9], "k2": [1, 1, 1], "n": [3, 0, 2], "tokens": lists})
    parts = list(frugal(lambda batches: (jaccard._marked(b.slice(i, 1), marks) for b in batches for i in range(len(b))))(iter([batch])))
    found = [tuple(r.values()) for part in parts for r in part.to_pylist()]
    assert found == [(7, 1, 3, 0, 1), (7, 1, 3, 2, 3), (9, 1, 2, 1, 3)]

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from recordloom.operators import forest, gbt, index_store, knn, mentions, quality, search, weak
from recordloom.operators.compare import FEATURES
from recordloom.schema import as_entities
from recordloom.scratch import written

VOTES = weak.VOTES


def pairs(spark, rows):
    return spark.createDataFrame(rows, "id int, " + ", ".join(f"{f} double" for f in FEATURES))


def test_votes(spark):
    rows = [
        (1, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0),
        (2, 0.5, 0.2, 0.1, 0.0, 0.0, 0.0, 0.0),
        (3, 0.8, 0.5, 0.5, 0.0, 0.0, 0.0, 0.0),
        (4, 0.95, 0.5, 0.1, 0.0, 0.0, 0.0, 1.0),
    ]
    got = {r["id"]: [r[v] for v in VOTES] for r in weak.weak_votes(pairs(spark, rows)).collect()}
    assert got == {
        1: [1, 1, -1, -1, 1, 1, -1], 2: [-1, -1, -1, -1, -1, 0, 0], 3: [-1] * 7, 4: [-1, -1, -1, 1, -1, 1, -1],
    }
    votes = weak.weak_votes(pairs(spark, rows))
    assert {r["id"]: r["label"] for r in weak.majority_label(votes).collect()} == {1: 1, 2: 0, 4: 1}
    report = {r["lf"]: r for r in weak.lf_report(votes).collect()}
    assert report["lf_high_jaro"]["coverage"] == 0.75 and report["lf_high_jaro"]["polarity"] == "0,1"
    assert report["lf_high_jaro"]["overlaps"] == 0.75 and report["lf_high_jaro"]["conflicts"] == 0.0
    kept = weak.retention(weak.majority_label(votes, keep_abstained=True)).first()
    assert (kept["labelled"], kept["total"], kept["retention"]) == (3, 4, 0.75)


def test_label_model_recovers_planted_truth():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    accuracy = [0.95, 0.9, 0.85, 0.8, 0.9, 0.8, 0.75]
    votes = np.full((4000, 7), -1)
    for j, acc in enumerate(accuracy):
        cast = rng.random(4000) < 0.6
        votes[cast, j] = np.where(rng.random(4000) < acc, truth, ~truth)[cast]
    patterns = pd.DataFrame(votes, columns=VOTES).groupby(VOTES).size().rename("weight").reset_index()
    patterns["p"] = weak.fit_label_model(patterns)
    p = pd.DataFrame(votes, columns=VOTES).merge(patterns, on=VOTES, how="left")["p"].to_numpy()
    assert ((p > 0.5) == truth)[p != 0.5].mean() > 0.93


def labelled(spark, n=400):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        same = i % 2 == 0
        jw = rng.uniform(0.93, 1.0) if same else rng.uniform(0.3, 0.8)
        rows.append((i, jw, jw, jw, float(same and rng.random() < 0.7), 0.0, float(same and rng.random() < 0.5), 0.0))
    return pairs(spark, rows)


def test_weak_labels_train_the_matcher(spark):
    frame = labelled(spark)
    marked = weak.label_model(weak.weak_votes(frame))
    assert marked.where((F.col("id") % 2 == 0) != (F.col("label") == 1)).count() == 0
    model = gbt.train_gbt(marked, max_iter=5)
    scored = gbt.score_gbt(model, frame)
    wrong = scored.where((F.col("id") % 2 == 0) != (F.col("prob_match") > 0.5)).count()
    assert wrong == 0 and scored.count() == 400


def test_quality_features(spark):
    rows = [("A", "Né☃", "50-78-3", "12x"), ("B", "ok", None, ""), ("C", "ok", "50-78-2", "٣")]
    df = as_entities(spark.createDataFrame(rows, "drugbank_id string, name string, cas_num string, pubchem_cid string"))
    got = {r["drugbank_id"]: [r[c] for c in quality.QUALITY] for r in quality.quality_features(df).collect()}
    assert got == {"A": [1.0, 3.0, 2.0, 2.0, 1.0], "B": [0.0, 2.0, 0.0, 1.0, 0.0], "C": [0.0, 2.0, 0.0, 2.0, 0.0]}


def test_forest_ranks_planted_outliers_first(spark):
    rng = np.random.default_rng(5)
    clean = rng.normal(0, 1, (3000, 3))
    odd = rng.normal(0, 0.1, (20, 3)) + 9
    rows = [(f"r{i:05d}", *map(float, p)) for i, p in enumerate(np.vstack([clean, odd]))]
    df = spark.createDataFrame(rows, "id string, x double, y double, z double").repartition(4)
    scored = forest.isolation_forest(df, "id", ["x", "y", "z"], trees=50, contamination=0.01)
    top = [r["id"] for r in forest.top_anomalies(scored, "id", 20).collect()]
    assert sum(t >= "r03000" for t in top) >= 19
    flagged = scored.where("anomaly_flag = 1").count()
    assert 25 <= flagged <= 40
    again = forest.isolation_forest(df.repartition(3), "id", ["x", "y", "z"], trees=50, contamination=0.01)
    assert scored.join(again.withColumnRenamed("outlier_score", "o2"), "id").where("abs(outlier_score - o2) > 1e-12").count() == 0


def test_forest_of_equal_rows(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("id"), F.lit(1.0).alias("x"))
    scored = forest.isolation_forest(df, "id", ["x"], trees=5)
    assert scored.select("outlier_score").distinct().count() == 1


def brute(vectors, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 6)
    return {i: sorted((-sims[i, j], j) for j in range(len(sims)) if j != i)[:k] for i in range(len(sims))}


def embeddings(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")


def recall(found, vectors, ids, k):
    """Share of the true neighbours, for some of the vectors."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    got = found.where(F.col("id").isin([int(i) for i in ids])).toPandas().groupby("id")["neighbour"].apply(set)
    sims = np.round(unit[ids] @ unit.T, 6)
    sims[np.arange(len(ids)), ids] = -np.inf
    every = np.arange(len(vectors))
    return np.mean([len(got[i] & set(np.lexsort((every, -sims[j]))[:k].tolist())) / k for j, i in enumerate(ids)])


def test_knn_lists_copies_first(spark):
    vectors = np.random.default_rng(2).normal(size=(150, 8))
    vectors[50:100] = vectors[7]
    rows = knn.knn_pairs(embeddings(spark, vectors), k=5, trees=4, leaf=40, rounds=4).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["id"], []).append((-r["cosine"], r["neighbour"]))
    expected = brute(vectors, 5)
    copies = [7, *range(50, 100)]
    assert {i: got[i] for i in copies} == {i: expected[i] for i in copies}
    assert all(len(v) == 5 for v in got.values()) and len(got) == 150


def test_knn_leaves_out_what_has_no_direction(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, []), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted((r["id"], r["neighbour"]) for r in knn.knn_pairs(df).collect()) == [(1, 2), (2, 1)]
    assert knn.knn_pairs(df.where("false")).collect() == []


def test_knn_does_not_depend_on_partitions(spark):
    vectors = np.random.default_rng(3).normal(size=(400, 8))
    df = embeddings(spark, vectors)
    one, other = (sorted(map(tuple, knn.knn_pairs(d, k=3, trees=3, leaf=20, rounds=4, refinements=1).collect())) for d in (df, df.repartition(7)))
    assert one == other


def test_knn_recall_over_many_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(400, 32))
    spread = np.repeat(centres, 40, axis=0) + rng.normal(scale=0.2, size=(16_000, 32))
    # Twenty clusters of 250 near copies, which planes through the origin do not part.
    tight = np.repeat(rng.normal(size=(20, 32)), 250, axis=0) + rng.normal(scale=0.01, size=(5_000, 32))
    vectors = np.vstack([spread, tight])
    found = written(knn.knn_pairs(embeddings(spark, vectors).repartition(8)), "knn")
    assert recall(found, vectors, rng.choice(16_000, 150, replace=False), 10) >= 0.9
    assert recall(found, vectors, 16_000 + rng.choice(5_000, 150, replace=False), 10) >= 0.9


def test_mentions(spark):
    texts = spark.createDataFrame([(1, "Take Café citrate, cafe citrate; a b a b a"), (2, ""), (3, "sodium")], "doc_id long, text string")
    names = spark.createDataFrame([("cafe citrate",), ("CAFÉ",), ("a b a",), ("Cafe  Citrate!",), ("--",), ("b a b a b",)], "name string")
    got = {r["doc_id"]: r["mentions"] for r in mentions.extract_mentions(texts, names).collect()}
    assert got == {1: ["cafe", "cafe citrate", "cafe", "cafe citrate", "a b a", "a b a"], 2: [], 3: []}


@pytest.mark.parametrize("block_bytes", [20, 1 << 20])
def test_mentions_in_blocks_of_names(spark, block_bytes):
    rng = random.Random(6)
    words = ["hot", "a", "b", "é", "c"]
    names = sorted({" ".join(["hot", *rng.choices(words, k=rng.randint(0, 3))]) for _ in range(40)} | {"b", "a b"})
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(30)] + ["hot " * 20_000, None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = mentions.mention_rows(rows, spark.createDataFrame([(n,) for n in [*names, names[0]]], "name string"), block_bytes=block_bytes)
    expected = []
    for i, text in enumerate(texts):
        w = (text or "").replace("é", "e").split()
        for name in {n.replace("é", "e") for n in names}:
            n = name.split()
            expected += [(i, p + 1, name) for p in range(len(w) - len(n) + 1) if w[p] == n[0] and w[p : p + len(n)] == n]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_search(spark):
    rows = [("1", "Fluoxetine Hydrochloride"), ("2", "Fluoxetine"), ("3", "Fluorouracil"), ("4", "Aspirin"), ("5", "Aspirin"), ("6", None)]
    df = spark.createDataFrame(rows, "id string, name string")
    index = search.build_name_index(search.distinct_names(df, "id", "name"))
    asked = spark.createDataFrame([("typo", "Fluoxetin"), ("sound", "Asperin"), ("prefix", "fluoro"), ("quote", 'asp"irin')], "query_id string, text string")
    best = {}
    for r in search.search_names(index, asked).collect():
        best.setdefault(r["query_id"], {})[r["rank"]] = (r["name"], r["n"])
    assert best["typo"][1] == ("Fluoxetine", 1)
    assert best["sound"][1] == ("Aspirin", 2)
    assert best["prefix"][1] == ("Fluorouracil", 1)
    # Every name with a hit in one of the views is listed.
    assert set(best["typo"].values()) == {("Fluoxetine", 1), ("Fluoxetine Hydrochloride", 1), ("Fluorouracil", 1)}


@pytest.mark.parametrize("token, edits", [("ab", 0), ("abc", 1), ("abcde", 1), ("abcdef", 2)])
def test_fuzzy_terms_equal_all_distances(spark, token, edits):
    rng = random.Random(9)
    terms = sorted({"".join(rng.choices("abcdef", k=rng.randint(1, 7))) for _ in range(300)} | {token})
    vocabulary = spark.createDataFrame([(t,) for t in terms], "term string")
    got = {r["term"] for r in search.fuzzy_terms(spark.createDataFrame([(token,)], "token string"), vocabulary).collect()}
    distance = vocabulary.withColumn("d", F.levenshtein(F.lit(token), "term"))
    near = distance.where((F.col("d") <= edits) & (F.col("d") < F.least(F.lit(len(token)), F.length("term"))))
    assert got == {r["term"] for r in near.collect()}


def test_fuzzy_keys_of_long_words_stay_few(spark):
    long = "".join(random.Random(2).choices("abcde", k=5000))
    near = [long[:40] + "x" + long[41:], long[1:], long[:-2], long[:100] + "zz" + long[100:], long[:7] + long[9:]]
    far = [long[3:], long + "xyz", long[::-1]]
    row = spark.createDataFrame([(long,)], "token string")
    keys = row.select(F.size(search._term_keys(F.col("token"))), F.size(search._token_keys(F.col("token"), 2))).first()
    assert keys[0] == 5 and keys[1] <= 75
    vocabulary = spark.createDataFrame([(t,) for t in [long, *near, *far]], "term string")
    assert {r["term"] for r in search.fuzzy_terms(row, vocabulary).collect()} == {long, *near}


def exhaustive(index, queries, k):
    """Every hit of every token, added up."""
    weights = search.token_weights(index, queries)
    rated = index.join(search.view_stats(index), "view")
    worth = F.col("w") * search.gain(F.col("tf").cast("double"), F.col("length"), F.col("avg_length"))
    hits = weights.join(rated, ["view", "token"]).groupBy("query_id", "name", "n").agg(F.round(F.sum(worth), 6).alias("score"))
    best = {}
    for r in hits.collect():
        best.setdefault(r["query_id"], []).append((-r["score"], r["name"], r["n"]))
    return {(q, rank, name, n, -score) for q, rows in best.items() for rank, (score, name, n) in enumerate(sorted(rows)[:k], 1)}


@pytest.mark.parametrize("k", [1, 7])
def test_search_equals_scoring_every_name(spark, k):
    rng = random.Random(k)
    words = ["acid", "salt", "oxide", "amine", "ester", "ether", "ketone", "phenol", "nitrate", "citrate"]
    # One word is in every name, and some names are borne by many records.
    names = [f"drug {rng.choice(words)} {rng.choice(words)}{rng.choice(['', 's', ' forte'])} {rng.randint(0, 40)}" for _ in range(1500)]
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(names)], "id string, name string")
    index = search.written(search.build_name_index(search.distinct_names(df, "id", "name")), "postings")
    asked = spark.createDataFrame(
        [("a", "drug acid oxide 7"), ("b", "drug"), ("c", "nitrat ethr"), ("d", "no such"), ("e", "drug phenol forte"), ("f", "")],
        "query_id string, text string",
    )
    found = search.search_names(index, asked, k, shards=3, block=16).collect()
    assert {(r["query_id"], r["rank"], r["name"], r["n"], r["score"]) for r in found} == exhaustive(index, asked, k)
    assert len(found) == len({(r["query_id"], r["rank"]) for r in found})


@pytest.mark.parametrize("queries", [1, 100])
def test_search_in_many_shards_and_parts(spark, monkeypatch, queries):
    monkeypatch.setattr(search, "_NAMES", 20)
    monkeypatch.setattr(search, "_QUERIES", queries)
    # All names score alike for the first query, so ties reach across the shards.
    df = spark.range(300).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("drug "), F.col("id") + 100).alias("name"))
    index = search.written(search.build_name_index(search.distinct_names(df, "id", "name")), "postings")
    asked = spark.createDataFrame([(1, "drug"), (2, "drug 123"), (3, "2"), (None, "drug")], "query_id long, text string")
    found = search.search_names(index, asked, 12)
    got = {(r["query_id"], r["rank"], r["name"], r["n"], r["score"]) for r in found.collect()}
    assert got == exhaustive(index, asked.where("query_id is not null"), 12) and len(got) == 24


def test_postings_of_small_names_are_made_by_many_tasks(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("drug number "), "id").alias("name"))
    index = search.build_name_index(search.distinct_names(df, "id", "name"))
    assert index.select(F.spark_partition_id()).distinct().count() > 1


def test_hot_lists_are_cut(spark):
    df = spark.range(4000).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("drug "), "id").alias("name"))
    index = search.build_name_index(search.distinct_names(df, "id", "name"))
    blocks = search.impact_blocks(index, shards=4, size=100).where("view = 'words' and token = 'drug'")
    sizes = [len(r["postings"]) for r in blocks.collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 100 and blocks.select("shard").distinct().count() == 4


def test_index_follows_changes(spark, tmp_path):
    path = str(tmp_path / "names")
    rows = lambda df: sorted(tuple(r[c] for c in ("view", "token", "name", "n", "length", "tf")) for r in df.collect())
    frame = lambda pairs: spark.createDataFrame(pairs, "id string, name string")
    assert rows(index_store.read_name_index(spark, path)) == []
    state = {}
    steps = [
        [("1", "Velorin"), ("2", "Velorin acid"), ("3", "Tamoxel"), ("4", None)],
        [("2", "Velorin"), ("3", None), ("5", "Quillax oxide"), (None, "nobody")],
        [("1", "Tamoxel"), ("2", "Brenta"), ("5", "Quillax"), ("6", "Velorin acid")],
    ]
    for step in steps:
        state = {k: v for k, v in {**state, **dict(step)}.items() if k and v}
        index_store.upsert_names(spark, path, frame(step))
        rebuilt = search.build_name_index(search.distinct_names(frame(list(state.items())), "id", "name"))
        assert rows(index_store.read_name_index(spark, path)) == rows(rebuilt)
        assert {(r.id, r.name) for r in index_store.indexed_records(spark, path).collect()} == set(state.items())
    before = rows(index_store.read_name_index(spark, path))
    merged = index_store.merge_segments(spark, path)
    assert rows(index_store.read_name_index(spark, path)) == before
    assert rows(index_store.read_name_index(spark, path, merged - 1)) == before
    hits = search.search_names(index_store.read_name_index(spark, path), spark.createDataFrame([("q", "tamoxe")], "query_id string, text string"))
    found = index_store.hit_records(hits, index_store.indexed_records(spark, path)).collect()
    assert [(r.query_id, r.rank, r.id, r.name) for r in found] == [("q", 1, "1", "Tamoxel")]


@pytest.mark.parametrize("numbers", [knn._NUMBERS, 8 * 60])
def test_exact_neighbours_are_those_of_all_vectors(spark, monkeypatch, numbers):
    monkeypatch.setattr(knn, "_NUMBERS", numbers)
    # Without structure, with copies, and with vectors of one direction, whose cosines tie.
    vectors = np.random.default_rng(6).normal(size=(500, 8))
    vectors[50:70], vectors[70:90] = vectors[7], vectors[9] * np.arange(1, 21)[:, None]
    got = {}
    for r in sorted(knn.exact_knn(embeddings(spark, vectors), k=5).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["id"], []).append((-r["cosine"], r["neighbour"]))
    assert got == brute(vectors, 5)
    # Of ten groups of neighbours the last holds one vector only.
    vectors = np.random.default_rng(7).normal(size=(9 * knn._GROUP + 1, 4))
    table = knn._best_of_tile(ids := np.arange(len(vectors)), m := knn._unit(vectors), ids, m, 10, True)
    assert {i: [(-c, o) for o, c in zip(g["other"], g["cosine"])] for i, g in table.groupby("rep")} == brute(vectors, 10)
    none = spark.createDataFrame([(1, [0.0]), (2, None), (3, [1.0])], "vec_id long, embedding array<double>")
    assert knn.exact_knn(none).collect() == []


def test_rows_trained_on_do_not_grow_with_the_pairs(spark, monkeypatch):
    trained = []
    monkeypatch.setattr(gbt, "written", lambda df, label: trained.append(written(df, label)) or trained[-1])
    fixed = [F.lit(0.0).alias(c) for c in FEATURES[1:]]
    pairs = spark.range(20_000).select((F.col("id") / 20_000).alias(FEATURES[0]), *fixed, (F.col("id") >= 10_000).cast("int").alias("label"))
    model = gbt.train_gbt(pairs, max_iter=2)
    assert trained[0].count() <= gbt._STEPS + 2 and trained[0].agg(F.sum("weight")).first()[0] == 20_000
    wrong = gbt.score_gbt(model, pairs.select("label", *FEATURES)).where("prediction != label").count()
    assert wrong < 1000


def test_pairs_between_the_same_cuts_are_scored_once(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(int(a > 0.5) if rng.random() < 0.9 else 0, a, rng.random(), rng.random(), *[float(rng.random() < 0.5) for _ in range(4)]) for a in (rng.random() for _ in range(5000))]
    pairs = written(spark.createDataFrame(rows, ["label", *FEATURES]), "pairs")
    model = gbt.train_gbt(pairs, max_iter=5)
    transformed = []
    one = gbt._scored
    monkeypatch.setattr(gbt, "_scored", lambda m, df: transformed.append(df) or one(m, df))
    got = gbt.score_gbt(model, pairs).select(*FEATURES, "prob_match", "prediction").collect()
    want = one(model, pairs).select(*FEATURES, "prob_match", "prediction").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    twice = pairs.unionByName(pairs)
    gbt.score_gbt(model, twice)
    assert transformed[0].count() == transformed[1].count() < 5000

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from recordloom.operators import blocking
from recordloom.operators.compare import FEATURES, block_features, counted_features, feature_vector, pair_features
from recordloom.operators.entities import _edges, block_classes, entities
from recordloom.operators.explain import explain
from recordloom.operators.resolve import feature_frame, link_totals, resolve, top_links, unfold_links
from recordloom.operators.scoring import FIELD_ORDER, LinkModel, decision, fs_score
from recordloom.operators.similar import similar_names
from recordloom.scratch import written

SCHEMA = "drugbank_id string, name string, cas_num string, pubchem_cid string, chembl_id string, inchi_key string"


def records(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def compared(spark, a, b):
    profs = blocking.profiles(records(spark, [a, b]), unique_ids=True)
    pairs = spark.createDataFrame([(a[0], b[0])], "id_a string, id_b string")
    return pair_features(pairs, profs)


def skewed(n=240, seed=3):
    """A third copies of one record, a third one long block of distinct names, the rest mixed."""
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "sodium", "omega", "kappa"]
    rows = []
    for i in range(n):
        key = f"DB{i:05d}"
        if i % 3 == 0:
            rows.append((key, "Copied Name", "50-78-2", "77", "CHEMBL7", "AAAAAAAAAAAAAA-X"))
            continue
        name = ("prefix " if i % 3 == 1 else "") + " ".join(rng.choices(words, k=rng.randint(1, 4)))
        pick = lambda values: rng.choice([None, "", *values])
        rows.append((key, name, pick("12"), pick("345"), pick("67"), rng.choice([None, "BBBBBBBBBBBBBB-1", "CCCCCCCCCCCCCC-2", "short"])))
    return rows


def test_default_model_bands():
    model = LinkModel()
    bands = {"match": 0, "review": 0, "non-match": 0}
    for size in range(7):
        for combo in itertools.combinations(FIELD_ORDER, size):
            p = model.posterior(frozenset(combo))
            bands["match" if p >= 0.9 else "review" if p >= 0.45 else "non-match"] += 1
    assert bands == {"match": 41, "review": 3, "non-match": 20}
    assert model.prior_bits == pytest.approx(-13.2876, abs=1e-3)


@pytest.mark.parametrize(
    "a, b, bits, post",
    [
        (("DB1", "Acetaminophen", "103-90-2"), ("DB2", "Paracetamol", "103-90-2"), -19.499, 1.35e-6),
        (("DB1", "Aspirin", "50-78-2"), ("DB2", "Metformin", "657-24-9"), -40.357, 0.0),
        (("DB1", "Fluoxetine", None), ("DB2", "Fluoxetin", None), None, 3.1e-10),
    ],
)
def test_scores(spark, a, b, bits, post):
    row = fs_score(compared(spark, (*a, None, None, None), (*b, None, None, None))).first()
    if bits is not None:
        assert row["total_bits"] == pytest.approx(bits, abs=1e-3)
    assert row["posterior"] == pytest.approx(post, rel=0.02, abs=1e-11)
    assert [w["field"] for w in row["contributions"]] == FIELD_ORDER


def test_model_without_a_field(spark):
    model = LinkModel(fields={"shared_cas": (0.95, 0.00001)})
    row = fs_score(compared(spark, ("DB1", "x", "1", None, None, None), ("DB2", "y", "1", None, None, None)), model).first()
    assert [w["field"] for w in row["contributions"]] == ["shared_cas"]
    assert row["total_bits"] == pytest.approx(model.prior_bits + math.log2(0.95 / 0.00001))


def test_explanation(spark):
    same = ("Ibuprofen", "15687-27-1", None, None, "HEFNNWSXXWATRW-UHFFFAOYSA-N")
    rows = resolve(records(spark, [("DB1", *same), ("DB2", *same), ("DB3", "Ibuprofen", "15687-27-1", "1", None, "HEFNNWSXXWATRW-A")]))
    told = explain(rows).orderBy("id_a", "id_b").collect()
    assert [(r["id_a"], r["id_b"], r["n_pairs"]) for r in told] == [("DB1", "DB1", 1), ("DB1", "DB3", 2)]
    reasons = told[0]["reasons"]
    assert reasons[:2] == ["InChIKey skeleton agreement: +19.9 bits", "CAS number agreement: +16.5 bits"]
    assert told[0]["summary"].startswith("DB1 ~ DB1: MATCH (posterior 1.000, total +23.4 bits) — InChIKey skeleton")


def all_links(spark, rows, match=0.9, review=0.45, model=LinkModel()):
    """Every pair of a block compared, record by record."""
    recs = records(spark, rows)
    keyed = blocking.blocking_keys(recs)
    a, b = keyed.select(F.col("id").alias("id_a"), "key"), keyed.select(F.col("id").alias("id_b"), "key")
    pairs = a.join(b, "key").where("id_a < id_b").select("id_a", "id_b").distinct()
    single = blocking.with_block_keys(blocking.comparable(recs, True)).withColumn("n", F.lit(1))
    scored = fs_score(pair_features(pairs, single), model).withColumn("decision", decision(match, review))
    return {(r["id_a"], r["id_b"]): (r["decision"], round(r["posterior"], 9)) for r in scored.where("decision <> 'non-match'").collect()}, pairs


MODELS = [
    LinkModel(),
    LinkModel(prior=0.05),
    LinkModel(fields={"shared_inchikey": (0.6, 0.3), "shared_cas": (0.95, 0.01), "name_jaro_winkler": (0.9, 0.01), "token_jaccard": (0.9, 0.02)}, prior=0.02),
]


@pytest.mark.parametrize("model", MODELS)
def test_resolve_equals_comparing_whole_blocks(spark, model):
    rows = skewed()
    recs = records(spark, rows)
    expected, _ = all_links(spark, rows, model=model)
    profs = written(blocking.profiles(recs), "p")
    unfolded = unfold_links(resolve(recs, model), blocking.profile_members(recs, profs))
    got = {(r["id_a"], r["id_b"]): (r["decision"], round(r["posterior"], 9)) for r in unfolded.collect()}
    assert got == expected and len(got) > 3000


def test_copies_stay_one_row(spark):
    recs = records(spark, skewed(900))
    links = resolve(recs)
    own = links.where("id_a = id_b and id_a = 'DB00000'").first()
    assert own["n_pairs"] == 300 * 299 // 2
    assert links.count() < 20_000


def test_top_links_equal_the_first_of_all(spark):
    rows = skewed(120)
    expected, _ = all_links(spark, rows)
    best = sorted(((-p, a, b) for (a, b), (_, p) in expected.items()))[:25]
    got = [(-round(r["posterior"], 9), r["id_a"], r["id_b"]) for r in top_links(records(spark, rows)).collect()]
    assert got == best


def test_candidate_total_counts_the_blocks(spark):
    rows = skewed()
    _, pairs = all_links(spark, rows)
    assert blocking.candidate_pair_total(records(spark, rows)).first()["n_pairs"] == pairs.count()


def expected_candidates(profs, similar):
    """The rule, pair by pair."""
    rows = profs.collect()
    out = set()
    for a, b in itertools.combinations(sorted(rows, key=lambda r: r["id"]), 2):
        same = [a[c] is not None and a[c] == b[c] for c in ("skeleton", "cas_num", "pubchem_cid", "chembl_id")]
        if same[0] or (a["name_key"] is not None and a["name_key"] == b["name_key"] and (any(same) or jaro_winkler(a["name"], b["name"]) >= similar)):
            out.add((a["id"], b["id"]))
    return out | {(r["id"], r["id"]) for r in rows if r["n"] > 1 and (r["name_key"] or r["skeleton"])}


def jaro_winkler(a, b):
    """Letter by letter."""
    reach, free, moved_a = max(len(a), len(b)) // 2 - 1, [True] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                moved_a.append(c)
                break
    moved_b = [c for c, f in zip(b, free, strict=True) if not f]
    m = len(moved_a)
    if m == 0:
        return 0.0
    t = sum(x != y for x, y in zip(moved_a, moved_b, strict=True)) / 2
    jaro = (m / len(a) + m / len(b) + (m - t) / m) / 3
    prefix = next((k for k in range(4) if k >= min(len(a), len(b)) or a[k] != b[k]), 4)
    return jaro if jaro < 0.7 else jaro + prefix * 0.1 * (1 - jaro)


@pytest.mark.parametrize("similar", [0.8, 0.92, 1.0])
def test_candidates_are_those_of_the_rule(spark, similar):
    profs = written(blocking.profiles(records(spark, skewed())), "p")
    got = [(r["id_a"], r["id_b"]) for r in blocking.candidate_pairs(profs, similar).collect()]
    assert len(got) == len(set(got)) and set(got) == expected_candidates(profs, similar)


def block_of(n, seed):
    """Distinct names of one block: variants of a few stems."""
    rng = random.Random(seed)
    names = set()
    while len(names) < n:
        stem = rng.choice(["prefixaceline", "prefixobutamol", "prefixin", "prefixanthroneé"]) + rng.choice(["", " forte", " 10"])
        name = list(stem + "".join(rng.choices("abcdeé0", k=rng.randint(0, 9))))
        i = rng.randrange(6, len(name))
        names.add("".join(name[:i] + [name[i]] * rng.randint(0, 2) + name[i + 1 :]).strip())
    return sorted(names)


@pytest.mark.parametrize(("n", "chunk"), [(30, 2000), (300, 50)])
def test_threshold_join_finds_every_similar_name(spark, n, chunk):
    names = block_of(n, n)
    rows = spark.createDataFrame([("b", x) for x in names] + [("b", names[0]), ("c", names[0]), ("d", "prefixin a")], "block string, name string")
    got = [tuple(r) for r in similar_names(rows, 0.92, chunk).collect()]
    expected = {(a, b) for a, b in itertools.combinations(names, 2) if jaro_winkler(a, b) >= 0.92}
    assert len(got) == len(set(got)) and set(got) == expected and len(got) > n // 2


def test_large_and_small_blocks_follow_one_rule(spark):
    names = block_of(3000, 5)
    profs = written(blocking.profiles(records(spark, [(f"DB{i:05d}", x, None, None, None, None) for i, x in enumerate(names)]), unique_ids=True), "p")
    assert profs.select("name_key").distinct().count() == 1
    got = {(r["id_a"], r["id_b"]) for r in blocking.candidate_pairs(profs).collect()}
    # Compared directly by an independent filter: same length and one letter apart is always alike here.
    ids = {r["name"]: r["id"] for r in profs.collect()}
    close = {tuple(sorted((ids[a], ids[b]))) for a, b in one_letter_apart(list(ids))}
    assert close <= got and len(close) > 300
    sample = random.Random(1).sample(sorted(ids), 250)
    chosen = {ids[x] for x in sample}
    assert {p for p in got if set(p) <= chosen and p[0] != p[1]} == {
        tuple(sorted((ids[a], ids[b]))) for a, b in itertools.combinations(sample, 2) if jaro_winkler(a, b) >= 0.92
    }


def one_letter_apart(names):
    seen = {}
    for x in names:
        if len(x) >= 15:
            for i in range(6, len(x)):
                seen.setdefault((x[:i], x[i + 1 :], len(x)), []).append(x)
    for group in seen.values():
        yield from itertools.combinations(group, 2)


def test_too_low_a_threshold_is_refused(spark):
    rows = spark.createDataFrame([("b", "x")], "block string, name string")
    with pytest.raises(ValueError):
        similar_names(rows, 0.5)
    assert similar_names(rows.where("false")).collect() == []


def test_hot_keys_are_cut_without_losing_pairs(spark):
    keyed = spark.range(300).select((F.col("id") % 3 == 0).cast("int").alias("key"), F.col("id").cast("string").alias("id"))
    got = {(r["id_a"], r["id_b"]) for r in blocking.pairs_on_key(keyed, chunk=7).collect()}
    groups = [[str(i) for i in range(300) if (i % 3 == 0) == hot] for hot in (True, False)]
    assert got == {tuple(sorted(p)) for g in groups for p in itertools.combinations(g, 2)}


def test_pairs_are_ordered_and_unique(spark):
    frame = feature_frame(records(spark, skewed(90)))
    assert frame.count() == frame.select("id_a", "id_b").distinct().count()
    assert frame.where("id_a > id_b").count() == 0
    assert dict(frame.dtypes)["shared_cas"] == "double"
    assert feature_vector(frame).columns == frame.columns


def test_repeated_ids_are_reduced(spark):
    rows = [("DB1", "x name", "1", "2", None, None), ("DB1", "x name", None, None, None, None), ("DB2", "x name", "1", "2", None, None)]
    profs = blocking.profiles(records(spark, rows)).collect()
    assert sum(r["n"] for r in profs) == 2
    assert [(r["id_a"], r["id_b"]) for r in top_links(records(spark, rows), k=5).collect()] == [("DB1", "DB2")]


def classes_of(links, ids):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("model", [LinkModel(), LinkModel(prior=0.02), LinkModel(prior=0.3)], ids=["default", "likely", "names alone"])
def test_entities_are_the_classes_of_all_links(spark, model):
    recs = written(records(spark, skewed()), "skewed")
    profs = written(blocking.profiles(recs), "profiles")
    links = unfold_links(resolve(recs, model), blocking.profile_members(recs, profs))
    want = classes_of([(r.id_a, r.id_b) for r in links.collect()], [r.drugbank_id for r in recs.collect()])
    got = [(r.id, r.entity_id) for r in entities(recs, model).collect()]
    assert len(got) == len(want) and dict(got) == want


def test_a_group_of_one_structure_gives_edges_in_proportion(spark):
    rows = [(f"DB{i:05d}", f"name {i * 7919 % 10007} of {i}", "1", None, "C1", "AAAAAAAAAAAAAA-X") for i in range(3000)]
    profs = written(blocking.profiles(records(spark, rows)), "profiles")
    assert _edges(profs, LinkModel(), 0.45).where("id_a = 'DB00000'").count() == 2999
    found = entities(records(spark, rows)).groupBy("entity_id").count().collect()
    assert [(r["entity_id"], r["count"]) for r in found] == [("DB00000", 3000)]


def test_every_pair_of_a_block_is_listed_and_compared(spark):
    profs = written(blocking.profiles(records(spark, skewed())), "p")
    rows = profs.collect()
    expected = {(r["id"], r["id"]) for r in rows if r["n"] > 1 and (r["name_key"] or r["skeleton"])}
    for a, b in itertools.combinations(rows, 2):
        if any(a[c] is not None and a[c] == b[c] for c in ("name_key", "skeleton")):
            expected.add(tuple(sorted((a["id"], b["id"]))))
    cut = blocking.unfolded(blocking.met_names(profs, ["id"], held=2, chunk=7)).select("a.id", "b.id")
    got = [tuple(r) for r in cut.unionAll(blocking.copy_pairs(profs)).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    pairs = written(blocking.block_pairs(profs), "pairs")
    assert {tuple(r) for r in pairs.collect()} == expected and pairs.count() == len(expected)
    # The same features as when each pair is compared by itself.
    assert sorted(map(tuple, block_features(profs).collect())) == sorted(map(tuple, pair_features(pairs, profs).collect()))


def test_block_classes_count_every_pair_and_form_none(spark):
    held = records(spark, skewed())
    found = block_classes(held)
    rows = blocking.with_block_keys(blocking.comparable(held)).collect()
    links = {r["id"]: set() for r in rows}
    for a, b in itertools.combinations(rows, 2):
        if any(a[c] is not None and a[c] == b[c] for c in ("name_key", "skeleton")):
            links[a["id"]].add(b["id"])
            links[b["id"]].add(a["id"])
    least = {i: i for i in links}
    while (lower := {i: min([least[i], *(least[j] for j in links[i])]) for i in links}) != least:
        least = lower
    got = {r["id"]: (r["component_id"], r["n_links"]) for r in found.collect()}
    assert got == {i: (least[i], len(links[i])) for i in links} and found.count() == len(links)
    assert len(set(least.values())) > 1 and max(map(len, links.values())) > 1
    # A block of 20,000 records has 200 million pairs.
    big = spark.range(20_000).select(F.concat(F.lit("DB"), "id").alias("drugbank_id"), F.lit("prefix").alias("name"), *[F.lit(None).cast("string").alias(c) for c in ("cas_num", "pubchem_cid", "chembl_id")])
    assert [tuple(r) for r in block_classes(big).select("component_id", "n_links").distinct().collect()] == [("DB0", 19_999)]


def test_the_feature_frame_has_the_pairs_that_do_not_match(spark):
    rows = [("DB1", "prefixabc", "1", None, None, None), ("DB2", "prefix zq yw", "2", None, None, None), ("DB3", "other", "1", None, None, None)]
    frame = feature_frame(records(spark, rows)).collect()
    assert [(r["id_a"], r["id_b"], r["shared_cas"]) for r in frame] == [("DB1", "DB2", 0.0)] and frame[0]["name_jaro_winkler"] < 0.92


def test_rows_meet_once_whatever_keys_they_share(spark):
    rows = spark.range(600).select(F.col("id").cast("string").alias("id"), (F.col("id") * 2).alias("value"))
    keyed = rows.select(F.explode(F.array(*[x.cast("long") for x in (F.lit(1), F.lit(-7), F.col("value") % 3 + 10, F.lit(1))])).alias("key"), "id")
    found = blocking.met_on_keys(rows, keyed, chunk=50)
    got = [(r["id_a"], r["id_b"]) for r in found.collect()]
    assert len(got) == len(set(got)) == 600 * 599 // 2 and all(a < b for a, b in got)
    assert found.where("value_a != 2 * cast(id_a as long) or value_b != 2 * cast(id_b as long)").isEmpty()


def test_links_are_made_without_shuffling_pairs(spark):
    rows = [(f"D{i:04d}", "Velorin acid", None, str(i), None, "ABCDEFGHIJKLMN-UHFFFAOYSA-N") for i in range(300)]
    records = spark.createDataFrame(rows, "drugbank_id string, name string, cas_num string, pubchem_cid string, chembl_id string, inchi_key string")
    links = resolve(records)
    assert links.count() == 300 * 299 // 2
    # Only the copies inside profiles are dealt out as pairs.
    assert links._jdf.queryExecution().optimizedPlan().toString().count("Repartition 8") <= 1


@pytest.mark.parametrize("least", [None, [frozenset({"shared_inchikey"}), frozenset({"shared_cas", "shared_chembl"})]])
def test_counted_pairs_equal_listed_ones(spark, least):
    # An id that stands for two records with different names makes no pair.
    rows = [*skewed(), ("DB00001", "prefix other", "12", None, "67", "BBBBBBBBBBBBBB-1")]
    profs = written(blocking.profiles(records(spark, rows), unique_ids=True), "profiles")
    values = [*FEATURES]
    held = blocking.copy_pairs(profs)
    listed = block_features(profs).join(held, ["id_a", "id_b"], "left_anti").unionByName(pair_features(held, profs))
    if least is not None:
        listed = listed.where(" or ".join("(" + " and ".join(sorted(s)) + ")" for s in least))
    want = {tuple(r)[:-1]: r["n"] for r in listed.groupBy(*values).agg(F.sum("n_pairs").alias("n")).collect()}
    counted = counted_features(profs, least)
    got = {tuple(r)[:-1]: r["n"] for r in counted.groupBy(*values).agg(F.sum("n_pairs").alias("n")).where("n <> 0").collect()}
    assert got == want and want


@pytest.mark.parametrize("model", MODELS)
def test_link_totals_are_counted_without_listing_links(spark, model):
    rows = records(spark, skewed())
    want = {r["decision"]: r["n"] for r in resolve(rows, model).groupBy("decision").agg(F.sum("n_pairs").alias("n")).collect()}
    assert {r["decision"]: r["n_pairs"] for r in link_totals(rows, model).collect()} == want


def test_rows_counted_do_not_grow_with_the_records(spark):
    def made(n):
        rows = [(f"DB{i:05d}", "Same Name", str(i), None, None, "AAAAAAAAAAAAAA-X") for i in range(n)]
        counts = blocking.counted_names(written(blocking.profiles(records(spark, rows), unique_ids=True), "profiles"))
        return counts.count(), counts.where("at_least = 0").first()["n_pairs"]

    assert made(50) == (2, 50 * 49 // 2) and made(400) == (2, 400 * 399 // 2)


def test_decisive_pairs_meet_once_and_names_are_compared_once(spark):
    model = MODELS[1]
    profs = written(blocking.profiles(records(spark, skewed())), "p")
    met = written(blocking.decisive_names(profs, ["id"], model, held=3, chunk=5), "met")
    kept = blocking.in_pairs(met).where(blocking.met_first(met.schema["held_a"].dataType.elementType))
    got = [tuple(r) for r in kept.select(F.least("l.id", "r.id"), F.greatest("l.id", "r.id")).collect()]
    assert len(got) == len(set(got)) > 100
    assert set(got) == {tuple(r) for r in blocking.decisive_pairs(profs, model).collect()}
    # Copies under one name and structure meet some 64 at a time.
    rows = [(f"D{i:04d}", "Velorin acid", None, str(i), None, "ABCDEFGHIJKLMN-UHFFFAOYSA-N") for i in range(400)]
    alike = written(blocking.profiles(records(spark, rows)), "p")
    assert blocking.decisive_names(alike, ["id"], held=64).count() < 400


@pytest.mark.parametrize("model", MODELS[::2])
def test_wording_looked_up_is_that_of_each_link(spark, model):
    links = written(resolve(records(spark, skewed()), model), "links")
    each, known = explain(links), explain(links, model)
    assert each.columns == known.columns
    assert sorted(map(str, each.collect())) == sorted(map(str, known.collect())) and links.count() > 100
    # Formatting is done for the sets of fields that may agree, and not link by link.
    assert "format_string" not in known._jdf.queryExecution().optimizedPlan().toString()


def test_top_links_ask_for_the_highest_posterior_first(spark, monkeypatch):
    from recordloom.operators import resolve as module

    asked = []
    found = module.linked_profiles
    monkeypatch.setattr(module, "linked_profiles", lambda *a: asked.append(a[-1]) or found(*a))
    full = [(f"DB{i:02d}", f"Ibuprofen {i}", "15687-27-1", "1", "C1", "HEFNNWSXXWATRW-UHFFFAOYSA-N") for i in range(10)]
    vague = [(f"DC{i:02d}", "Ibuprofen", "15687-27-1", "1", None, None) for i in range(40)]
    assert [(r["id_a"], r["id_b"]) for r in top_links(records(spark, full + vague), k=5).collect()] == [("DB00", f"DB0{i}") for i in range(1, 6)]
    assert len(asked) == 1
    assert top_links(records(spark, vague), k=5).count() == 5 and asked[-1] == 0.45

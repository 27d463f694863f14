"""Candidate pairs of records, generated so that no task pairs off a whole group of records.

Records that compare alike are collapsed into one *profile* first; a pair of profiles stands for
`n_pairs` pairs of records. A group of copies, however large, is a single row from then on.

Three generators follow. `decisive_pairs` lists the pairs that share a block and agree on enough fields
to reach a decision threshold; which fields suffice is computed from the model, so nothing that could
be accepted is missed. `block_pairs` lists every pair of a block, `candidate_pairs` those that agree on an
identifier or whose names pass a similarity threshold, by equality joins and by a threshold join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.text import drop_salts, inchikey_skeleton, name_prefix, normalize_name, token_set
from recordloom.operators.enrich import one_row_per_id
from recordloom.operators.scoring import AGREES_FROM, LinkModel
from recordloom.operators.similar import similar_names
from recordloom.scratch import written

IDENTIFIERS = {"shared_cas": "cas_num", "shared_pubchem": "pubchem_cid", "shared_chembl": "chembl_id"}
#: The compared fields that agree or do not, and a bit for each.
COMPARED_AS = {**IDENTIFIERS, "shared_inchikey": "skeleton"}
FIELD_BITS = {field: 1 << i for i, field in enumerate(COMPARED_AS)}
COMPARED = ["norm_name", "cas_num", "pubchem_cid", "chembl_id", "skeleton"]


def comparable(records: DataFrame, unique_ids: bool = False) -> DataFrame:
    """(id, compared values) of entity rows; an `inchi_key` column is optional. Repeated ids are
    reduced to their smallest row unless the caller knows there are none."""
    key = inchikey_skeleton(F.col("inchi_key")) if "inchi_key" in records.columns else F.lit(None).cast("string")
    rows = records.select(
        F.col("drugbank_id").alias("id"),
        normalize_name(F.col("name")).alias("norm_name"),
        *[F.nullif(F.col(c), F.lit("")).alias(c) for c in IDENTIFIERS.values()],
        key.alias("skeleton"),
    )
    return rows if unique_ids else one_row_per_id(rows, "id")


def with_block_keys(rows: DataFrame, prefix: int = 6) -> DataFrame:
    """Add the salt-free `name` and `name_key`, NULL when too short to block on."""
    named = rows.withColumn("name", drop_salts(F.col("norm_name")))
    key = name_prefix(F.col("name"), prefix)
    return named.withColumn("name_key", F.when(F.length(key) >= 2, key))


def key_column() -> Column:
    """The blocking keys of a row: name prefix and structure skeleton, where present."""
    return F.array_compact(F.array(F.concat(F.lit("n:"), "name_key"), F.concat(F.lit("i:"), "skeleton")))


def blocking_keys(records: DataFrame, prefix: int = 6) -> DataFrame:
    """(id, key), one row per record and blocking key."""
    return with_block_keys(comparable(records, unique_ids=True), prefix).select("id", F.explode(key_column()).alias("key"))


def block_sizes(records: DataFrame, prefix: int = 6) -> DataFrame:
    """Records and record pairs of every block, counted without forming a pair."""
    n = F.col("n_records")
    counts = blocking_keys(records, prefix).groupBy("key").agg(F.count("*").alias("n_records"))
    return counts.withColumn("n_pairs", F.floor(n * (n - 1) / 2).cast("bigint"))


def candidate_pair_total(records: DataFrame, prefix: int = 6) -> DataFrame:
    """How many distinct record pairs share a block: pairs by name plus pairs by structure, less those
    counted in both."""
    rows = with_block_keys(comparable(records, unique_ids=True), prefix)
    name, skeleton = F.col("name_key"), F.col("skeleton")

    def group(sign: int, a: Column, b: Column) -> Column:
        return F.struct(F.lit(sign).alias("sign"), a.alias("a"), b.alias("b"))

    groups = F.array(group(1, name, F.lit("")), group(1, F.lit(""), skeleton), group(-1, name, skeleton))
    keyed = rows.select(F.explode(groups).alias("g")).where(F.col("g.a").isNotNull() & F.col("g.b").isNotNull())
    n = F.col("n")
    sizes = keyed.groupBy("g").agg(F.count("*").alias("n"))
    return sizes.agg(
        F.coalesce(F.sum(F.col("g.sign") * F.floor(n * (n - 1) / 2)), F.lit(0)).cast("bigint").alias("n_pairs")
    )


def profiles(records: DataFrame, prefix: int = 6, unique_ids: bool = False) -> DataFrame:
    """One row per distinct set of compared values: smallest record id, number of records, keys."""
    grouped = comparable(records, unique_ids).groupBy(*COMPARED).agg(F.min("id").alias("id"), F.count("*").alias("n"))
    return with_block_keys(grouped, prefix)


def profile_members(records: DataFrame, profs: DataFrame, unique_ids: bool = False) -> DataFrame:
    """(profile id, record id): unfolds a profile into its records."""
    rows = comparable(records, unique_ids)
    same = [rows[c].eqNullSafe(profs[c]) for c in COMPARED]
    return rows.join(profs, same).select(profs["id"].alias("profile"), rows["id"].alias("id"))


def _join_rules(model: LinkModel, threshold: float) -> list[tuple[str, tuple[str, ...], bool]]:
    """Sufficient field sets as (block column, identifiers to agree on, tokens to share) of an
    equality join. Name similarity cannot be joined on and is left to the comparison."""
    rules = set()
    for fields in model.sufficient(threshold):
        ids = tuple(sorted(f for f in fields if f in IDENTIFIERS))
        tokens = "token_jaccard" in fields
        # Agreement on the structure is a shared block itself; otherwise either block will do.
        blocks = ["skeleton"] if "shared_inchikey" in fields else ["name_key", "skeleton"]
        rules.update((block, ids, tokens) for block in blocks)

    def covered(rule: tuple[str, tuple[str, ...], bool]) -> bool:
        return any(
            o != rule and o[0] == rule[0] and set(o[1]) <= set(rule[1]) and (rule[2] or not o[2]) for o in rules
        )

    return sorted(r for r in rules if not covered(r))


def token_keys(rows: DataFrame, at_least: float) -> DataFrame:
    """(key, id) from rows (id, context, norm_name), such that any two names of a context whose token
    sets have Jaccard >= `at_least` get a key in common.

    Of each name the rarest tokens of the context are kept, as many as it takes: without one of them in
    common, two names cannot reach the overlap. Words that most of a context shares are left out
    wherever the name has others. Names without tokens share the empty token.
    """
    tokens = token_set(F.col("norm_name"))
    words = F.when(F.size(tokens) == 0, F.array(F.lit(""))).otherwise(tokens)
    spread = rows.select("id", "context", F.explode(words).alias("token"))
    held = spread.groupBy("context", "token").agg(F.count("*").alias("n"))
    # One list per name, no longer than the name.
    ranked = spread.join(held, ["context", "token"]).groupBy("id", "context").agg(
        F.array_sort(F.collect_list(F.struct("n", "token"))).alias("ranked")
    )
    size = F.size("ranked")
    needed = F.ceil(size * F.lit(at_least) - F.lit(1e-9)).cast("int")
    kept = ranked.select("id", "context", F.explode(F.slice("ranked", F.lit(1), size - needed + 1)).alias("r"))
    return kept.where(F.col("r.n") > 1).select(F.xxhash64("context", "r.token").alias("key"), "id")


def pairs_on_key(keyed: DataFrame, chunk: int = 2000) -> DataFrame:
    """Distinct (id_a < id_b) of rows (key, id) with a common key.

    Keys held once are dropped before the join. A key held by more than `chunk` rows is cut into
    chunks: each row keeps one chunk on the left and visits every chunk on the right, so the work of
    a hot key is spread over many tasks and no pair is lost.
    """
    held = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    chunks = held.select("key", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    rows = keyed.join(chunks, "key")
    left = rows.select("key", F.col("id").alias("id_a"), F.pmod(F.hash("id"), F.col("chunks")).alias("chunk"))
    right = rows.select("key", F.col("id").alias("id_b"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    pairs = left.join(right, ["key", "chunk"]).where(F.col("id_a") < F.col("id_b"))
    return pairs.select("id_a", "id_b").distinct()


def met_on_keys(rows: DataFrame, keyed: DataFrame, chunk: int = 256) -> DataFrame:
    """Pairs of `rows` with a common key of `keyed` (key, id), id of a < id of b: the columns of both, as `_a` and `_b`.

    Every key of a row goes along, so a pair is kept at the smallest key in common and need not be made distinct. Keys
    are cut into chunks as in `pairs_on_key`. Pairs are made where they are used, and never shuffled.
    """
    held = keyed.distinct()
    chunks = held.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("key", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    keys = held.join(chunks, "key").groupBy("id").agg(F.collect_list(F.struct("key", "chunks")).alias("met"))
    named = rows.join(keys, "id").select(*rows.columns, F.transform("met", lambda m: m["key"]).alias("keys"), F.explode("met").alias("m"))
    columns = [*rows.columns, "keys"]
    # Few rows make many pairs, so the number of parts is not left to their size.
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.pmod(F.xxhash64("id"), F.col("m.chunks")).cast("int").alias("chunk")
    every = F.explode(F.sequence(F.lit(0), F.col("m.chunks") - 1)).alias("chunk")
    left = named.select(F.col("m.key").alias("key"), own, *[F.col(c).alias(f"{c}_a") for c in columns]).repartition(n, "key", "chunk")
    right = named.select(F.col("m.key").alias("key"), every, *[F.col(c).alias(f"{c}_b") for c in columns]).repartition(n, "key", "chunk")
    first = F.array_min(F.array_intersect("keys_a", "keys_b")) == F.col("key")
    pairs = left.join(right, ["key", "chunk"]).where((F.col("id_a") < F.col("id_b")) & first)
    return pairs.drop("key", "chunk", "keys_a", "keys_b")


def _rule_keys(profs: DataFrame, model: LinkModel, threshold: float) -> tuple[list[Column], list[DataFrame]]:
    """The keys of `decisive_keys`: a column per rule of equality, NULL where a value is absent, and (key, id) of the words
    per rule that needs some in common."""
    keys, words = [], []
    for i, (block, ids, tokens) in enumerate(_join_rules(model, threshold)):
        columns = [F.col(block), *[F.col(IDENTIFIERS[f]) for f in ids]]
        present = columns[0].isNotNull()
        for c in columns[1:]:
            present = present & c.isNotNull()
        # 64-bit keys keep the shuffle narrow; a chance collision only adds a pair to compare.
        context = F.xxhash64(F.lit(i), *columns)
        if tokens:
            rows = profs.where(present).select("id", context.alias("context"), "norm_name")
            words.append(token_keys(rows, AGREES_FROM["token_jaccard"]))
        else:
            keys.append(F.when(present, context))
    return keys, words


def decisive_keys(profs: DataFrame, model: LinkModel = LinkModel(), threshold: float = 0.45) -> DataFrame:
    """(key, id): keys that any two profiles in a common block that can reach `threshold` have in common."""
    keys, words = _rule_keys(profs, model, threshold)
    plain = F.array_compact(F.array(*keys)) if keys else F.array().cast("array<bigint>")
    every = profs.select(F.explode(plain).alias("key"), "id")
    for part in words:
        every = every.unionByName(part)
    return every


def decisive_pairs(profs: DataFrame, model: LinkModel = LinkModel(), threshold: float = 0.45) -> DataFrame:
    """(id_a, id_b) of every pair of profiles in a common block that can reach `threshold`."""
    return pairs_on_key(decisive_keys(profs, model, threshold))


def decisive_names(
    profs: DataFrame, values: list[str], model: LinkModel = LinkModel(), threshold: float = 0.45, held: int = 64, chunk: int = 256
) -> DataFrame:
    """Pairs of names whose profiles have a key of `decisive_keys` in common, in the form of `met_names` with `rule`
    beside. A pair of profiles meets once in each rule that has a key for it, and is to be kept where `met_first` holds.

    The profiles (`values`) of a name are held together as in `met_names`, so names are compared once per pair of names
    and rule, and no pair is shuffled.
    """
    keys, words = _rule_keys(profs, model, threshold)
    rows = profs.where(F.col("id").isNotNull()).withColumns({f"_key{i}": c for i, c in enumerate(keys)})
    for i, part in enumerate(words, len(keys)):
        listed = part.distinct().groupBy("id").agg(F.array_sort(F.collect_list("key")).alias(f"_words{i}"))
        rows = rows.join(listed, "id", "left")
    own = [f"_key{i}" for i in range(len(keys))] + [f"_words{i}" for i in range(len(keys), len(keys) + len(words))]
    none = F.lit(None).cast("array<bigint>")

    def at(rule: int, key: Column, listed: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule"), key.alias("key"), listed.alias("words"))

    met = [F.array_compact(F.array(*[F.when(F.col(own[i]).isNotNull(), at(i, F.col(own[i]), none)) for i in range(len(keys))]))]
    for i in range(len(keys), len(own)):
        met.append(F.coalesce(F.transform(own[i], lambda k: at(i, k, F.col(own[i]))), F.array()))
    # No rule comes after the last one, so what it joins on need not go along.
    profile = F.struct(*values, *own[:-1]).alias("profile")
    keyed = rows.select("id", "name", "norm_name", profile, F.explode(F.concat(*met)).alias("m")).select("m.*", "id", "name", "norm_name", "profile")
    group = ["rule", "key"]
    sizes = keyed.groupBy(*group, "norm_name").agg(F.count("*").alias("size"))
    totals = sizes.groupBy(*group).agg(F.sum("size").alias("total")).where("total > 1")
    sizes = sizes.select(*group, "norm_name", F.ceil(F.col("size") / held).cast("int").alias("parts"))
    cut = totals.select(*group, F.ceil(F.col("total") / chunk).cast("int").alias("chunks"))
    # Words are those of the name, unless an id stands for several names.
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part")
    nodes = keyed.join(cut, group).join(sizes, [*group, "norm_name"]).groupBy(*group, "chunks", "words", "name", "norm_name", part).agg(F.collect_list("profile").alias("held"))
    part = F.struct("part", F.coalesce("words", F.array().cast("array<bigint>")).alias("words")).alias("part")
    nodes = nodes.select(*group, "chunks", "words", "name", "norm_name", part, "held", token_set(F.col("norm_name")).alias("tokens"))
    nodes = written(nodes, "decisive-names")
    columns = ["name", "norm_name", "tokens", "part", "words", "held"]
    one_chunk = F.pmod(F.xxhash64("norm_name", "part"), F.col("chunks")).cast("int").alias("chunk")
    every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    # Few rows make many pairs, so the number of parts is not left to their size.
    n = int(profs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = nodes.select(*group, one_chunk, *[F.col(c).alias(f"{c}_a") for c in columns]).repartition(n, *group, "chunk")
    right = nodes.select(*group, every, *[F.col(c).alias(f"{c}_b") for c in columns]).repartition(n, *group, "chunk")
    one = F.col("norm_name_a") == F.col("norm_name_b")
    once = (F.col("norm_name_a") < F.col("norm_name_b")) | (one & (F.col("part_a") <= F.col("part_b")))
    first = (F.col("rule") < len(keys)) | (F.array_min(F.array_intersect("words_a", "words_b")) == F.col("key"))
    same = (one & (F.col("part_a") == F.col("part_b"))).alias("same")
    sides = [f"{c}_{side}" for side in "ab" for c in ("name", "tokens", "held")]
    return left.join(right, [*group, "chunk"]).where(once & first).select(*sides, same, "rule")


def met_first(profile: T.StructType) -> Column:
    """Whether profiles `l` and `r` of `decisive_names` (`profile` is their type) meet in no rule before `rule`."""
    earlier = F.lit(False)
    for i, name in enumerate(f.name for f in profile if f.name.startswith(("_key", "_words"))):
        l, r = F.col(f"l.{name}"), F.col(f"r.{name}")
        met = l == r if name.startswith("_key") else F.arrays_overlap(l, r)
        earlier = earlier | ((F.col("rule") > i) & F.coalesce(met, F.lit(False)))
    return ~earlier


def copy_pairs(profs: DataFrame) -> DataFrame:
    """(id, id) of profiles that stand for several records of a block."""
    blocked = F.col("name_key").isNotNull() | F.col("skeleton").isNotNull()
    return profs.where((F.col("n") > 1) & blocked).select(F.col("id").alias("id_a"), F.col("id").alias("id_b"))


def id_pairs(profs: DataFrame) -> DataFrame:
    """(id_a, id_b) of profiles that share a block and agree on an identifier; the structure is both."""
    keys = [F.when(F.col("skeleton").isNotNull(), F.xxhash64(F.lit("skeleton"), F.col("skeleton")))]
    for column in IDENTIFIERS.values():
        present = F.col("name_key").isNotNull() & F.col(column).isNotNull()
        keys.append(F.when(present, F.xxhash64(F.lit(column), F.col("name_key"), F.col(column))))
    named = ["id", "name_key", "skeleton", *IDENTIFIERS.values()]
    # 64-bit keys keep the shuffle narrow; what a chance collision adds is taken out afterwards.
    met = pairs_on_key(profs.select(F.explode(F.array_compact(F.array(*keys))).alias("key"), "id"))
    a = profs.select(*[F.col(c).alias(f"{c}_a") for c in named])
    b = profs.select(*[F.col(c).alias(f"{c}_b") for c in named])

    def same(column: str) -> Column:
        return F.coalesce(F.col(f"{column}_a") == F.col(f"{column}_b"), F.lit(False))

    agreed = same("cas_num") | same("pubchem_cid") | same("chembl_id")
    return met.join(a, "id_a").join(b, "id_b").where(same("skeleton") | (same("name_key") & agreed)).select("id_a", "id_b")


def name_pairs(profs: DataFrame, similar: float = AGREES_FROM["name_jaro_winkler"]) -> DataFrame:
    """(id_a, id_b) of profiles of one name block whose names have at least this Jaro-Winkler similarity."""
    named = profs.where(F.col("name_key").isNotNull())
    alike = similar_names(named.select(F.col("name_key").alias("block"), "name"), similar)
    a = named.select(F.col("name").alias("name_a"), F.col("id").alias("l"))
    b = named.select(F.col("name").alias("name_b"), F.col("id").alias("r"))
    unlike_ids = alike.join(a, "name_a").join(b, "name_b").select(F.least("l", "r").alias("id_a"), F.greatest("l", "r").alias("id_b"))
    return unlike_ids.unionByName(pairs_on_key(named.select(F.col("name").alias("key"), "id")))


def candidate_pairs(profs: DataFrame, similar: float = AGREES_FROM["name_jaro_winkler"]) -> DataFrame:
    """Candidate (id_a, id_b) of profiles, id_a < id_b, or id_a = id_b for the copies inside a profile: those that
    share a block and agree on an identifier, or share a name block and have names alike.

    The rule is the same for blocks of any size. The output grows with the pairs that satisfy it.
    """
    listed = id_pairs(profs).unionByName(name_pairs(profs, similar)).distinct()
    return listed.unionByName(copy_pairs(profs))


def met_names(profs: DataFrame, values: list[str], held: int = 128, chunk: int = 1024) -> DataFrame:
    """Pairs of names of a block, each with the profiles that bear it, for `unfolded`: (name_a, tokens_a, held_a, the
    same of b, same). Of every two profiles that share a block, the names meet once, in whichever blocks they share.

    The profiles (`values`) of a name are held together, some `held` at a time, so what depends on names alone is
    computed per pair of names. Each name of a block keeps one chunk on the left and visits every chunk on the right, so a
    task sees some `chunk` profiles of a block beside the others, one after the other.
    """
    keyed = profs.where(F.col("id").isNotNull()).select(
        F.explode(key_column()).alias("key"), "name_key", "name", "norm_name", F.struct(*values).alias("profile")
    )
    sizes = keyed.groupBy("key", "name_key", "norm_name").agg(F.count("*").alias("size"))
    # Profiles of one structure that share the name block as well have met there.
    apart = (F.count("name_key") < F.count("*")) | (F.min("name_key") < F.max("name_key"))
    totals = sizes.groupBy("key").agg(F.sum("size").alias("total"), apart.alias("apart"))
    met = F.col("key").startswith("n:") | F.col("apart")
    chunks = totals.where((F.col("total") > 1) & met).select("key", F.ceil(F.col("total") / chunk).cast("int").alias("chunks"))
    parts = sizes.select("key", "norm_name", F.ceil(F.col("size") / held).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("profile.id"), F.col("parts")).cast("int").alias("part")
    names = ["key", "chunks", "name_key", "name", "norm_name"]
    nodes = keyed.join(chunks, "key").join(parts, ["key", "norm_name"]).groupBy(*names, part).agg(F.collect_list("profile").alias("held"))
    nodes = written(nodes.withColumn("tokens", token_set(F.col("norm_name"))), "block-names")
    columns = ["name_key", "name", "norm_name", "tokens", "part", "held"]
    own = F.pmod(F.xxhash64("norm_name", "part"), F.col("chunks")).cast("int").alias("chunk")
    every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    # Small inputs make many pairs, so the number of parts is not left to their size.
    n = int(profs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = nodes.select("key", own, *[F.col(c).alias(f"{c}_a") for c in columns]).repartition(n, "key", "chunk")
    right = nodes.select("key", every, *[F.col(c).alias(f"{c}_b") for c in columns]).repartition(n, "key", "chunk")
    one = F.col("norm_name_a") == F.col("norm_name_b")
    once = (F.col("norm_name_a") < F.col("norm_name_b")) | (one & (F.col("part_a") <= F.col("part_b")))
    first = F.col("key").startswith("n:") | ~F.coalesce(F.col("name_key_a") == F.col("name_key_b"), F.lit(False))
    same = (one & (F.col("part_a") == F.col("part_b"))).alias("same")
    sides = [f"{c}_{side}" for side in "ab" for c in ("name", "tokens", "held")]
    return left.join(right, ["key", "chunk"]).where(once & first).select(*sides, same)


def in_pairs(met: DataFrame) -> DataFrame:
    """Profiles `l` and `r` of the names of `met_names`, each pair once and either of them first, beside the other columns."""
    kept = [c for c in met.columns if c not in ("held_a", "held_b", "same")]
    rows = met.select(*kept, "same", "held_b", F.explode("held_a").alias("l"))
    rows = rows.select(*kept, "same", "l", F.explode("held_b").alias("r"))
    return rows.where((F.col("l.id") < F.col("r.id")) | (~F.col("same") & (F.col("l.id") > F.col("r.id")))).drop("same")


def unfolded(met: DataFrame) -> DataFrame:
    """`in_pairs` as profiles `a` and `b`, id of a < id of b."""
    rows = in_pairs(met)
    kept = [c for c in rows.columns if c not in ("l", "r")]
    rising = F.col("l.id") < F.col("r.id")
    return rows.select(*kept, F.when(rising, F.col("l")).otherwise(F.col("r")).alias("a"), F.when(rising, F.col("r")).otherwise(F.col("l")).alias("b"))


def block_pairs(profs: DataFrame) -> DataFrame:
    """(id_a, id_b) of every two profiles of a common block, id_a < id_b, or id_a = id_b for the copies inside a profile.

    The output grows with the square of the profiles of a block; no task holds a block.
    """
    pairs = in_pairs(met_names(profs, ["id"])).select(F.least("l.id", "r.id").alias("id_a"), F.greatest("l.id", "r.id").alias("id_b"))
    return pairs.unionByName(copy_pairs(profs))


def _masks(least: list[frozenset[str]] | None) -> list[int]:
    """Sets of agreeing fields, as sums of `FIELD_BITS`, that hold one of the sets `least`; all without it."""
    low = [sum(FIELD_BITS[f] for f in fields) for fields in (least or [frozenset()])]
    return [m for m in range(1 << len(FIELD_BITS)) if any(m & x == x for x in low)]


def counted_names(profs: DataFrame, least: list[frozenset[str]] | None = None, chunk: int = 256) -> DataFrame:
    """Record pairs of blocks, counted and not formed: (name_a, tokens_a, name_b, tokens_b, at_least, n_pairs), for
    names of a block how many pairs agree at least on the fields of `at_least`, a sum of `FIELD_BITS`.

    Records of a name that agree on some fields are one row with their number, and products of these numbers count the
    pairs. The work grows with the pairs of names that agree, and not with the pairs of records; `agreed_alone` leads to
    the pairs that agree on nothing else. With `least`, only pairs that agree on one of these sets of fields are counted.
    """
    counted = _masks(least)
    options = []
    for m in counted:
        agreed = [F.col(COMPARED_AS[f]) for f, bit in FIELD_BITS.items() if m & bit]
        present = F.lit(True)
        for c in agreed:
            present = present & c.isNotNull()
        options.append(F.when(present, F.struct(F.lit(m).alias("at_least"), F.array(*agreed).cast("array<string>").alias("values"))))
    named = profs.where(F.col("id").isNotNull()).select(
        "name_key", "name", "norm_name", "n", F.explode(key_column()).alias("key"), F.array_compact(F.array(*options)).alias("options")
    )
    keyed = named.select("key", "name_key", "name", "norm_name", "n", F.explode("options").alias("o"))
    group = ["key", "at_least", "values"]
    nodes = keyed.groupBy("key", "o.at_least", "o.values", "name_key", "name", "norm_name").agg(F.sum("n").alias("n"))
    nodes = written(nodes.withColumn("tokens", token_set(F.col("norm_name"))), "counted-names")
    # Names of one structure that share the name block as well have met there.
    apart = (F.count("name_key") < F.count("*")) | (F.min("name_key") < F.max("name_key"))
    sizes = nodes.groupBy(*group).agg(F.sum("n").alias("total"), F.count("*").alias("names"), apart.alias("apart"))
    met = sizes.where((F.col("total") > 1) & (F.col("key").startswith("n:") | F.col("apart")))
    nodes = nodes.join(met.select(*group, F.ceil(F.col("names") / chunk).cast("int").alias("chunks")), group)
    columns = ["name_key", "name", "norm_name", "tokens", "n"]
    own = F.pmod(F.xxhash64("norm_name"), F.col("chunks")).cast("int").alias("chunk")
    every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    # Few names make many pairs, so the number of parts is not left to their size.
    parts = int(profs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = nodes.select(*group, own, *[F.col(c).alias(f"{c}_a") for c in columns]).repartition(parts, *group, "chunk")
    right = nodes.select(*group, every, *[F.col(c).alias(f"{c}_b") for c in columns]).repartition(parts, *group, "chunk")
    one = F.col("norm_name_a") == F.col("norm_name_b")
    once = (F.col("norm_name_a") < F.col("norm_name_b")) | (one & (F.col("n_a") > 1))
    first = F.col("key").startswith("n:") | ~F.coalesce(F.col("name_key_a") == F.col("name_key_b"), F.lit(False))
    # n (n - 1) / 2 in whole numbers.
    inside = F.shiftright(F.col("n_a") * (F.col("n_a") - 1), 1)
    n_pairs = F.when(one, inside).otherwise(F.col("n_a") * F.col("n_b")).alias("n_pairs")
    sides = ["name_a", "tokens_a", "name_b", "tokens_b"]
    pairs = left.join(right, [*group, "chunk"]).where(once & first).select(*sides, "at_least", n_pairs)
    return pairs.unionByName(_pairs_of_one_id(profs, counted))


def _pairs_of_one_id(profs: DataFrame, counted: list[int]) -> DataFrame:
    """What to take from the counts of `counted_names` where profiles of a block share an id, as no pair is made of them."""
    repeated = profs.groupBy("id").agg(F.count("*").alias("profiles")).where("profiles > 1 and id is not null").select("id")
    tokens = token_set(F.col("norm_name")).alias("tokens")
    rows = profs.join(repeated, "id").select("id", "name_key", "name", "norm_name", tokens, "n", *COMPARED_AS.values(), F.to_json(F.struct(*COMPARED)).alias("values"))
    a = rows.select("id", *[F.col(c).alias(f"{c}_a") for c in rows.columns if c != "id"])
    b = rows.select("id", *[F.col(c).alias(f"{c}_b") for c in rows.columns if c != "id"])

    def same(column: str) -> Column:
        return F.coalesce(F.col(f"{column}_a") == F.col(f"{column}_b"), F.lit(False))

    rising = F.col("norm_name_a") < F.col("norm_name_b")
    once = rising | ((F.col("norm_name_a") == F.col("norm_name_b")) & (F.col("values_a") < F.col("values_b")))
    met = a.join(b, "id").where(once & (same("name_key") | same("skeleton")))
    agreed = F.lit(0)
    for f, c in COMPARED_AS.items():
        agreed = agreed + F.when(same(c), FIELD_BITS[f]).otherwise(0)
    subsets = F.filter(F.array(*[F.lit(m) for m in counted]), lambda m: m.bitwiseAND(F.col("agreed")) == m)
    less = (-F.col("n_a") * F.col("n_b")).alias("n_pairs")
    met = met.withColumn("agreed", agreed)
    return met.select("name_a", "tokens_a", "name_b", "tokens_b", F.explode(subsets).alias("at_least"), less)


def agreed_alone(counts: DataFrame, least: list[frozenset[str]] | None = None) -> DataFrame:
    """From `n_pairs` that agree at least on the fields `at_least`, rows whose sums are those that agree on no others:
    `agreed` instead of `at_least`, by inclusion and exclusion."""
    masks = _masks(least)
    options = []
    for m in masks:
        inside = [t for t in masks if m & t == t]
        parts = [F.struct(F.lit(t).alias("agreed"), F.lit(-1 if (m ^ t).bit_count() % 2 else 1).alias("sign")) for t in inside]
        options.append((m, F.array(*parts)))
    chosen = F.lit(None)
    for m, parts in options:
        chosen = F.when(F.col("at_least") == m, parts).otherwise(chosen)
    kept = [c for c in counts.columns if c not in ("at_least", "n_pairs")]
    each = counts.select(*kept, "n_pairs", F.explode(chosen).alias("o"))
    return each.select(*kept, F.col("o.agreed").alias("agreed"), (F.col("n_pairs") * F.col("o.sign")).alias("n_pairs"))

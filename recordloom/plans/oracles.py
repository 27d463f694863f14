"""DuckDB SQL that restates the registered queries from their definitions, for checking only."""

from __future__ import annotations

from recordloom.functions.phonetic import LONGEST, RULES, SAME_SOUND
from recordloom.functions.text import SALT_WORDS
from recordloom.operators.compare import FEATURES
from recordloom.operators.explain import WORDING
from recordloom.operators.quality import QUALITY
from recordloom.operators.scoring import AGREES_FROM, FIELD_ORDER, LinkModel
from recordloom.operators.weak import VOTES
from recordloom.plans import fixtures as fx
from recordloom.schema import CONTRACT

ORACLES: dict[str, str] = {}


def _derived(sql: str) -> str:
    return sql.format(registry="registry")


def _norm(x: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(lower(strip_accents(coalesce({x}, ''))),"
        r" '[[:punct:]]', ' ', 'g'), '\s+', ' ', 'g'))"
    )


_SALTS = ", ".join(f"'{w}'" for w in SALT_WORDS)


def _strip(n: str) -> str:
    kept = f"list_filter(string_split({n}, ' '), lambda t: t not in ({_SALTS}))"
    return f"case when len({kept}) = 0 then {n} else array_to_string({kept}, ' ') end"


def _jaccard(a: str, b: str) -> str:
    ta, tb = (f"list_distinct(list_filter(string_split({x}, ' '), lambda t: t <> ''))" for x in (a, b))
    return (
        f"case when len({ta}) = 0 and len({tb}) = 0 then 1.0 when len({ta}) = 0 or len({tb}) = 0 then 0.0 "
        f"else len(list_intersect({ta}, {tb}))::double / len(list_distinct(list_concat({ta}, {tb}))) end"
    )


def _lev(a: str, b: str) -> str:
    # Letters outside ASCII take several bytes, which the built-in distance would count one by one.
    one = [f"translate({x}, 'ßæøœłđð', '!#%&+@^')" for x in (a, b)]
    return f"levenshtein({one[0]}, {one[1]})"


_REG = "registry as (" + fx.REGISTRY.format(documents="documents") + ")"
_NORM = (
    f"norm as (select *, {_norm('name')} as nn from registry), "
    f"named as (select *, {_strip('nn')} as short from norm), "
    "keyed as (select *, case when length(substr(replace(short, ' ', ''), 1, 6)) >= 2"
    " then substr(replace(short, ' ', ''), 1, 6) end as name_key,"
    " case when length(trim(inchi_key)) >= 14 then substr(trim(inchi_key), 1, 14) end as skeleton from named)"
)
_PROF = (
    "prof as (select min(drugbank_id) as id, count(*) as n, nn, any_value(short) as short, cas_num, pubchem_cid,"
    " chembl_id, skeleton, any_value(name_key) as name_key from keyed group by nn, cas_num, pubchem_cid, chembl_id, skeleton)"
)
_PAIRS = (
    "pairs as (select a.id as id_a, b.id as id_b from prof a join prof b on a.name_key = b.name_key and a.id < b.id"
    " union select a.id, b.id from prof a join prof b on a.skeleton = b.skeleton and a.id < b.id"
    " union select id, id from prof where n > 1 and (name_key is not null or skeleton is not null))"
)


def _similar(source: str, keep: str, a: str = "a", b: str = "b") -> str:
    """CTEs ending in `jw`, with `jaro` and `jaro_winkler` of columns a and b beside `keep`."""
    step = (
        "lambda s, e: case when instr(substr(s.rest, greatest(1, e.i - reach)::bigint,"
        " greatest(least(e.i + reach, length(b)) - greatest(1, e.i - reach) + 1, 0)::bigint), substr(a, e.i, 1)) > 0 then "
        "{'i': e.i, 'rest': substr(s.rest, 1, (greatest(1, e.i - reach) + instr(substr(s.rest, greatest(1, e.i - reach)::bigint,"
        " greatest(least(e.i + reach, length(b)) - greatest(1, e.i - reach) + 1, 0)::bigint), substr(a, e.i, 1)) - 2)::bigint) || '~' ||"
        " substr(s.rest, (greatest(1, e.i - reach) + instr(substr(s.rest, greatest(1, e.i - reach)::bigint,"
        " greatest(least(e.i + reach, length(b)) - greatest(1, e.i - reach) + 1, 0)::bigint), substr(a, e.i, 1)))::bigint),"
        " 'hits': s.hits || substr(a, e.i, 1)} else s end"
    )
    return (
        f"pos as (select {keep}, {a} as a, {b} as b, (greatest(length({a}), length({b})) // 2 - 1)::bigint as reach from {source}), "
        "walk as (select *, list_reduce(list_transform(range(1, length(a) + 1), lambda i: {'i': i::bigint, 'rest': '', 'hits': ''}),"
        f" {step}, {{'i': 0::bigint, 'rest': b, 'hits': ''}}) as st from pos), "
        "hit as (select *, st.hits as ha, array_to_string(list_transform(list_filter(range(1, length(b) + 1),"
        " lambda j: substr(st.rest, j, 1) = '~'), lambda j: substr(b, j, 1)), '') as hb from walk), "
        "moved as (select *, length(ha) as m, len(list_filter(range(1, length(ha) + 1),"
        " lambda k: substr(ha, k, 1) <> substr(hb, k, 1))) as t from hit), "
        "jj as (select *, case when a = '' and b = '' then 1.0 when a = '' or b = '' or m = 0 then 0.0"
        " else (m::double / length(a) + m::double / length(b) + (m - t / 2.0)::double / m) / 3.0 end as jaro from moved), "
        "jw as (select *, case when jaro < 0.7 then jaro else jaro + 0.1 * (1.0 - jaro) * "
        "len(list_filter(range(1, 5), lambda k: least(length(a), length(b)) >= k and substr(a, 1, k) = substr(b, 1, k)))"
        " end as jaro_winkler from jj)"
    )


def _same(column: str) -> str:
    return f"coalesce(x.{column} = y.{column}, false)"


_RAW = (
    "raw as (select p.id_a, p.id_b, case when p.id_a = p.id_b then x.n * (x.n - 1) // 2 else x.n * y.n end as n_pairs,"
    f" x.short as sa, y.short as sb, x.nn as na, y.nn as nb, {_same('cas_num')} as shared_cas, {_same('skeleton')} as shared_inchikey,"
    f" {_same('pubchem_cid')} as shared_pubchem, {_same('chembl_id')} as shared_chembl"
    " from pairs p join prof x on x.id = p.id_a join prof y on y.id = p.id_b)"
)
_WHOLE = (
    f"{_RAW}, {_similar('raw', '*', 'sa', 'sb')}, "
    "feat as (select id_a, id_b, n_pairs, jaro_winkler as name_jaro_winkler,"
    f" case when greatest(length(a), length(b)) = 0 then 0.0 else 1.0 - {_lev('a', 'b')}::double / greatest(length(a), length(b)) end"
    f" as name_levenshtein_norm, {_jaccard('na', 'nb')} as token_jaccard, shared_cas, shared_inchikey, shared_pubchem, shared_chembl from jw)"
)
# A link agrees on an identifier or has a similar name.
_FEATURES = (
    _WHOLE[:-1] + " where id_a = id_b or shared_cas or shared_inchikey or shared_pubchem or shared_chembl or jaro_winkler >= 0.92)"
)

_MODEL = LinkModel()


def _agrees(f: str) -> str:
    return f"{f} >= {AGREES_FROM[f]}" if f in AGREES_FROM else f


_BITS = {f: f"case when {_agrees(f)} then {_MODEL.bits(f, True)!r}::double else {_MODEL.bits(f, False)!r}::double end" for f in FIELD_ORDER}
_SCORED = (
    f"bits as (select *, {_MODEL.prior_bits!r}::double + ({' + '.join(_BITS[f] for f in FIELD_ORDER)}) as total_bits from feat), "
    "post as (select *, 1.0 / (1.0 + pow(2.0, -total_bits)) as posterior from bits), "
    "scored as (select *, case when posterior >= 0.90 then 'match' when posterior >= 0.45 then 'review' else 'non-match' end"
    " as decision from post), links as (select * from scored where decision <> 'non-match')"
)
_YES = {f: f"case when shared_{f} then 1 else -1 end" for f in ("inchikey", "cas", "pubchem", "chembl")}
_VOTES = (
    "votes as (select *, " + ", ".join(f"{sql} as lf_shared_{f}" for f, sql in _YES.items()) + ","
    " case when name_jaro_winkler >= 0.999 then 1 else -1 end as lf_exact_name,"
    " case when name_jaro_winkler >= 0.95 then 1 when name_jaro_winkler < 0.70 then 0 else -1 end as lf_high_jaro,"
    " case when not (shared_inchikey or shared_cas or shared_pubchem or shared_chembl) and token_jaccard < 0.2 then 0 else -1 end"
    " as lf_low_token_overlap_no_id from feat),"
    f" tally as (select *, list_filter([{', '.join(VOTES)}], lambda v: v <> -1) as cast_votes from votes),"
    " majority as (select *, case when list_sum(cast_votes) * 2 > len(cast_votes) then 1"
    " when list_sum(cast_votes) * 2 < len(cast_votes) then 0 else -1 end as label from tally)"
)

_PLAIN = f"with {_REG} "
_NAMED = f"with {_REG}, {_NORM} "
_BLOCK = f"with {_REG}, {_NORM}, {_PROF} "
_CAND = f"with {_REG}, {_NORM}, {_PROF}, {_PAIRS} "
_FEAT = f"with {_REG}, {_NORM}, {_PROF}, {_PAIRS}, {_WHOLE} "
_SCORE = f"with {_REG}, {_NORM}, {_PROF}, {_PAIRS}, {_WHOLE}, {_SCORED} "
_LINK = f"with {_REG}, {_NORM}, {_PROF}, {_PAIRS}, {_FEATURES}, {_SCORED} "
_WEAK = f"with {_REG}, {_NORM}, {_PROF}, {_PAIRS}, {_WHOLE}, {_VOTES} "

# ---- functions -------------------------------------------------------------------------------------

ORACLES["normalize_name"] = _NAMED + "select drugbank_id, nn as norm_name from norm"
ORACLES["strip_salts"] = _NAMED + "select drugbank_id, short as stripped from named"
ORACLES["blocking_key"] = _NAMED + "select drugbank_id, substr(replace(short, ' ', ''), 1, 6) as block from named"
ORACLES["inchikey_skeleton"] = _NAMED + "select drugbank_id, skeleton from keyed"
_CAS_OK = (
    "case when length(d) between 5 and 10 then list_sum(list_transform(range(1, length(d)),"
    " lambda i: substr(d, length(d) - i, 1)::int * i)) % 10 = substr(d, length(d), 1)::int else false end"
)
_DIGITS = "digits as (select *, regexp_replace(coalesce(cas_num, ''), '[^0-9]', '', 'g') as d from registry)"
ORACLES["valid_cas"] = f"with {_REG}, {_DIGITS} select drugbank_id, {_CAS_OK} as valid from digits"
ORACLES["string_similarity"] = (
    f"with {_REG}, {_NORM}, two as (select x.doc_id, x.short as a, y.short as b, x.nn as na, y.nn as nb"
    f" from named x join named y on y.doc_id - 1 = x.doc_id), {_similar('two', 'doc_id, na, nb')} "
    f"select doc_id, {_lev('a', 'b')} as lev, round(case when greatest(length(a), length(b)) = 0 then 0.0"
    f" else 1.0 - {_lev('a', 'b')}::double / greatest(length(a), length(b)) end, 6) as lev_norm,"
    f" round(jaro, 6) as jaro, round(jaro_winkler, 6) as jaro_winkler, round({_jaccard('na', 'nb')}, 6) as jaccard from jw"
)
_RAWS = {
    "cas": "' ' || coalesce(cas_num, 'null') || ' '",
    "pub": "coalesce(pubchem_cid, ' . ')",
    "che": "coalesce(chembl_id, 'NULL')",
    "key": "coalesce(inchi_key, '  ')",
}
_RULES = {
    "reg": "case when trim({0}) not in ('', 'null') then trim({0}) end",
    "xml": "nullif(trim({0}), '')",
    "flat": "case when lower(trim({0})) not in ('', 'null', '.') then trim({0}) end",
}
ORACLES["absent_rules"] = (
    _PLAIN + "select drugbank_id, "
    + ", ".join(f"{rule.format(raw)} as {n}_{r}" for n, raw in _RAWS.items() for r, rule in _RULES.items())
    + " from registry"
)
ORACLES["name_edge_ngrams"] = (
    _NAMED + ", words as (select drugbank_id, unnest(string_split(nn, ' ')) as token from norm) select drugbank_id, token,"
    " array_to_string(list_transform(range(2, least(20, length(token)) + 1), lambda i: substr(token, 1, i)), ' ') as grams from words"
)

# ---- entity rows -----------------------------------------------------------------------------------

_IDS = ["pubchem_cid", "cas_num", "chembl_id", "stitch_id", "cuis"]
_FILLED = " + ".join(f"({c} is not null)::int" for c in _IDS)
ORACLES["filled_ids"] = _PLAIN + f"select drugbank_id, {_FILLED} as filled from registry"
_SIGNALS = [
    f"(cas_num is not null and not ({_CAS_OK}))", "length(name)",
    r"length(regexp_replace(name, '[\x00-\x7F]', '', 'g'))", f"({_FILLED})",
    r"(pubchem_cid is not null and not regexp_full_match(pubchem_cid, '\p{Nd}*'))",
]
ORACLES["quality_features"] = (
    f"with {_REG}, {_DIGITS} select drugbank_id, "
    + ", ".join(f"({s})::int::double as {n}" for n, s in zip(QUALITY, _SIGNALS))
    + " from digits"
)


def _line(cells: dict[str, str]) -> str:
    """A registry line from SQL per entity column; others are absent."""
    parts = [cells.get(c, "null") if c in cells else "null::varchar" for c in CONTRACT]
    return " || chr(9) || ".join(f"coalesce(nullif({p}, ''), 'null')" for p in parts)


_CELLS = {c: c for c in ("drugbank_id", "name", "pubchem_cid", "cas_num", "chembl_id", "stitch_id")} | {"umls_cuis": "cuis"}
ORACLES["registry_rows"] = _PLAIN + f"select drugbank_id, {_line(_CELLS)} as line from registry"
ORACLES["source_columns"] = (
    _PLAIN + "select drugbank_id, 'CAS' as source, 'cas_num' as id_column from registry where cas_num is not null"
    " union all select drugbank_id, 'PubChem', 'pubchem_cid' from registry where pubchem_cid is not null"
    " union all select drugbank_id, 'stitch', 'stitch_id' from registry where stitch_id is not null"
    " union all select drugbank_id, 'InChI', null from registry where inchi_key is not null"
)

# ---- sources and sinks -----------------------------------------------------------------------------

_BACK = [
    "null::varchar as " + c if c not in _CELLS else ("coalesce(cuis, '') as umls_cuis" if c == "umls_cuis" else f"trim({c}) as {c}")
    for c in CONTRACT
]
ORACLES["registry_tsv_roundtrip"] = _PLAIN + f"select {', '.join(_BACK)} from registry"
ORACLES["registry_sharded_roundtrip"] = (
    _PLAIN + "select drugbank_id, trim(name) as name, cas_num, stitch_id, coalesce(len(string_split(cuis, ',')), 0) as n_cuis from registry"
)
ORACLES["malformed_lines"] = (
    _PLAIN + "select concat_ws(chr(9), drugbank_id, name, cas_num) as line,"
    " 'expected 13 columns, got ' || case when cas_num is null then '2' else '3' end as error from registry"
)
ORACLES["kv_blocks"] = _PLAIN + f", src as ({_derived(fx.TTD)}) select ttd_id, trim(name) as name, cas_num, pubchem_cid from src where trim(name) <> ''"
ORACLES["tagged_blocks"] = (
    _PLAIN + f", src as ({_derived(fx.KEGG)}) select kegg_id, trim(replace(name, ';', ',')) as name, cas_num, chebi_id, pubchem_cid from src"
)
ORACLES["id_map"] = _PLAIN + "select drugbank_id, stitch_id from registry where stitch_id is not null"
ORACLES["crosscheck"] = (
    _PLAIN + """, q as (select *, trim(regexp_replace(name, '["\\\\]', '', 'g')) as nm from registry)
    select drugbank_id, nm as name, chembl_id, 'DGIdb' as source from q where lower(nm) not in ('', '.', 'null')"""
)
ORACLES["xml_records"] = (
    _PLAIN + "select drugbank_id, trim(name) as name, cas_num, coalesce(pubchem_cid, cas_num) as pubchem_cid,"
    " coalesce(chembl_id, drugbank_id) as chembl_id, stitch_id as kegg_id, null::varchar as chebi_id, inchi_key,"
    " stitch_id as description from registry"
)
ORACLES["lookup_roundtrip"] = _PLAIN + _derived(fx.CHEMBL_LOOKUP)
ORACLES["lookup_refresh"] = (
    f"with {_REG}, a as ({_derived(fx.CHEMBL_LOOKUP)}), b as ({_derived(fx.PUBCHEM_LOOKUP)})"
    " select drugbank_id as id, case when inchi_key is null then a.value else b.value end as value"
    " from registry r left join a on a.id = r.drugbank_id left join b on b.id = r.drugbank_id"
    " where inchi_key is null or chembl_id is null"
)
ORACLES["decode_payloads"] = (
    _PLAIN + "select drugbank_id as id, 'unichem' as kind, chembl_id as value from registry"
    " union all select drugbank_id, 'pubchem', doc_id::varchar from registry"
    " union all select drugbank_id, 'umls', drugbank_id || coalesce(',' || stitch_id, '') from registry"
    " union all select drugbank_id, 'dgidb', 'chembl:' || cas_num from registry"
)
ORACLES["upsert_by_key"] = (
    "with incoming as (select case when s_nationkey > 12 then s_suppkey else -1 - s_suppkey end as k,"
    " case when s_acctbal > 0 then s_name end as c_name, s_acctbal as c_acctbal from supplier)"
    " select coalesce(c.c_custkey, i.k) as c_custkey, coalesce(i.c_name, c.c_name) as c_name,"
    " coalesce(i.c_acctbal, c.c_acctbal) as c_acctbal, c.c_mktsegment"
    " from customer c full join incoming i on c.c_custkey = i.k"
)

# ---- enrichment ------------------------------------------------------------------------------------


def _keyed(name: str, sql: str) -> str:
    return f"{name}_raw as ({_derived(sql)}), {name}_norm as (select *, {_norm('name')} as nn from {name}_raw), {name} as (select *, {_strip('nn')} as short from {name}_norm)"


def _first(name: str, columns: list[str]) -> str:
    """Fullest row per name, then the smallest."""
    absent = " + ".join(f"(nullif({c}, '') is null)::int" for c in columns)
    order = ", ".join([absent, *[f"{c} nulls first" for c in columns]])
    return (
        f"{name}_first as (select * from (select *, row_number() over (partition by short order by {order}) as rn from {name}) where rn = 1)"
    )


ORACLES["merge_by_name"] = (
    f"with {_REG}, {_NORM}, {_keyed('ttd', fx.TTD)} select b.drugbank_id, b.name, s.ttd_id, coalesce(b.cas_num, s.cas_num) as cas_num,"
    " coalesce(b.pubchem_cid, s.pubchem_cid) as pubchem_cid, null::varchar as kegg_id, null::varchar as chebi_id,"
    " null::varchar as kegg_cid from named b left join ttd s on b.short = s.short"
)
ORACLES["merge_by_name_first"] = (
    f"with {_REG}, {_NORM}, {_keyed('kegg', fx.KEGG)}, {_first('kegg', ['kegg_id', 'chebi_id', 'cas_num', 'pubchem_cid'])}"
    " select b.drugbank_id, b.name, null::varchar as ttd_id, coalesce(b.cas_num, s.cas_num) as cas_num,"
    " coalesce(b.pubchem_cid, s.pubchem_cid) as pubchem_cid, s.kegg_id, s.chebi_id, null::varchar as kegg_cid"
    " from named b left join kegg_first s on b.short = s.short"
)
ORACLES["merge_by_id"] = (
    f"with {_REG}, s as ({_derived(fx.STITCH)}) select b.drugbank_id, coalesce(b.stitch_id, s.stitch_id) as stitch_id"
    " from registry b left join s on b.drugbank_id = s.drugbank_id"
)
ORACLES["apply_lookup"] = (
    f"with {_REG}, c as ({_derived(fx.CHEMBL_LOOKUP)}), u as ({_derived(fx.UMLS_LOOKUP)})"
    " select b.drugbank_id, coalesce(b.chembl_id, c.value) as chembl_id, coalesce(replace(u.value, ',', '|'), '') as cuis"
    " from registry b left join c on c.id = b.drugbank_id left join u on u.id = b.drugbank_id"
)
ORACLES["missing_keys"] = (
    f"with {_REG}, c as ({_derived(fx.CHEMBL_LOOKUP)}) select distinct drugbank_id, name from registry b"
    " where chembl_id is null and not exists (select 1 from c where c.id = b.drugbank_id)"
)
ORACLES["corroborate"] = (
    f"with {_REG}, {_NORM}, {_keyed('ev', fx.EVIDENCE)},"
    " e as (select drugbank_id, short, regexp_replace(chembl_id, '^chembl:', '') as v from ev where chembl_id is not null),"
    " i as (select drugbank_id, min(v) as f, list(v) as vs from e where drugbank_id is not null group by drugbank_id),"
    " n as (select short, min(v) as f, list(v) as vs from e group by short),"
    " j as (select b.drugbank_id, b.chembl_id, coalesce(i.f, n.f) as seen,"
    " coalesce(list_contains(case when i.f is not null then i.vs else n.vs end, b.chembl_id), false) as hit"
    " from named b left join i on i.drugbank_id = b.drugbank_id left join n on n.short = b.short)"
    " select drugbank_id, chembl_id, case when hit then chembl_id else seen end as evidence_chembl_id,"
    " case when seen is null then 'unverified' when chembl_id is null then 'missing' when hit then 'agree' else 'conflict' end as status from j"
)
ORACLES["conflict_reasons"] = (
    "select drugbank_id, case when status = 'conflict' then 'chembl_id ' || chembl_id || ' contradicted by ' || evidence_chembl_id else '' end as reasons"
    f" from ({ORACLES['corroborate']})"
)
_BUILD = (
    f"{_REG}, {_NORM}, {_keyed('ttd', fx.TTD)}, {_first('ttd', ['ttd_id', 'cas_num', 'pubchem_cid'])},"
    f" {_keyed('kegg', fx.KEGG)}, {_first('kegg', ['kegg_id', 'chebi_id', 'cas_num', 'pubchem_cid'])},"
    f" st as ({_derived(fx.STITCH)}), ch as ({_derived(fx.CHEMBL_LOOKUP)}), pu as ({_derived(fx.PUBCHEM_LOOKUP)}), um as ({_derived(fx.UMLS_LOOKUP)}),"
    " j as (select b.drugbank_id, b.name, t.ttd_id, b.cas_num as cas0, t.cas_num as cas_t, k.cas_num as cas_k, b.pubchem_cid as pub0,"
    " t.pubchem_cid as pub_t, pu.value as pub_l, k.pubchem_cid as pub_k, b.chembl_id as che0, ch.value as che_l, k.kegg_id, k.chebi_id,"
    " um.value as cuis, st.stitch_id from named b left join ttd_first t on t.short = b.short left join kegg_first k on k.short = b.short"
    " left join st on st.drugbank_id = b.drugbank_id left join ch on ch.id = b.drugbank_id left join pu on pu.id = b.drugbank_id"
    " left join um on um.id = b.drugbank_id)"
)
_BUILT = {
    "drugbank_id": "drugbank_id", "name": "name", "ttd_id": "ttd_id", "pubchem_cid": "coalesce(pub0, pub_t, pub_l, pub_k)",
    "cas_num": "coalesce(cas0, cas_t, cas_k)", "chembl_id": "coalesce(che0, che_l)", "chebi_id": "chebi_id",
    "kegg_id": "kegg_id", "umls_cuis": "cuis", "stitch_id": "stitch_id",
}
ORACLES["build_registry"] = f"with {_BUILD} select drugbank_id, {_line(_BUILT)} as line from j"


def _fill(field: str, source: str, method: str, new: str, *earlier: str) -> str:
    absent = " and ".join(f"{e} is null" for e in earlier) or "true"
    return (
        f"select drugbank_id, '{field}' as field, '{source}' as source, '{method}' as method, 1.0::double as confidence,"
        f" {new} as evidence from j where {new} is not null and {absent}"
    )


_FILLS = " union all ".join(
    [
        _fill("ttd_id", "ttd", "name", "ttd_id"),
        _fill("cas_num", "ttd", "name", "cas_t", "cas0"),
        _fill("pubchem_cid", "ttd", "name", "pub_t", "pub0"),
        _fill("chembl_id", "chembl", "lookup", "che_l", "che0"),
        _fill("pubchem_cid", "pubchem", "lookup", "pub_l", "pub0", "pub_t"),
        _fill("kegg_id", "kegg", "name", "kegg_id"),
        _fill("chebi_id", "kegg", "name", "chebi_id"),
        _fill("cas_num", "kegg", "name", "cas_k", "cas0", "cas_t"),
        _fill("pubchem_cid", "kegg", "name", "pub_k", "pub0", "pub_t", "pub_l"),
    ]
)
ORACLES["provenance"] = (
    f"with {_BUILD}, final as (select drugbank_id, coalesce(cas0, cas_t, cas_k) as cas_num from j),"
    " digits as (select *, regexp_replace(coalesce(cas_num, ''), '[^0-9]', '', 'g') as d from final),"
    f" why as (select drugbank_id, case when cas_num is not null and not ({_CAS_OK}) then 'check digit of ' || cas_num else '' end as reasons from digits),"
    f" fills as ({_FILLS}) select w.drugbank_id, w.reasons, f.field, f.source, f.method, f.confidence, f.evidence"
    " from why w left join fills f on f.drugbank_id = w.drugbank_id"
)
ORACLES["one_row_per_id"] = (
    f"with {_REG}, {_NORM}, {_keyed('ttd', fx.TTD)}, f as (select b.drugbank_id, s.ttd_id, coalesce(b.cas_num, s.cas_num) as cas_num,"
    " coalesce(b.pubchem_cid, s.pubchem_cid) as pubchem_cid from named b left join ttd s on b.short = s.short)"
    " select drugbank_id, ttd_id, cas_num, pubchem_cid from (select *, row_number() over (partition by drugbank_id"
    " order by (ttd_id is null)::int + (cas_num is null)::int + (pubchem_cid is null)::int,"
    " ttd_id nulls first, cas_num nulls first, pubchem_cid nulls first) as rn from f) where rn = 1"
)

# ---- entity resolution -----------------------------------------------------------------------------

_KEYS = (
    "keys as (select drugbank_id as id, 'n:' || name_key as key from keyed where name_key is not null"
    " union all select drugbank_id, 'i:' || skeleton from keyed where skeleton is not null)"
)
ORACLES["blocking_keys"] = _NAMED + f", {_KEYS} select id, key from keys"
ORACLES["block_sizes"] = _NAMED + f", {_KEYS} select key, count(*) as n_records, count(*) * (count(*) - 1) // 2 as n_pairs from keys group by key"
ORACLES["candidate_pair_total"] = (
    _NAMED + f", {_KEYS}, p as (select distinct a.id as x, b.id as y from keys a join keys b on a.key = b.key and a.id < b.id)"
    " select count(*) as n_pairs from p"
)
ORACLES["profiles"] = _BLOCK + "select id, n, short as name, name_key, skeleton from prof"
ORACLES["profile_members"] = (
    _NAMED + "select min(drugbank_id) over (partition by nn, cas_num, pubchem_cid, chembl_id, skeleton) as profile, drugbank_id as id from keyed"
)
ORACLES["candidate_pairs"] = _CAND + "select id_a, id_b from pairs"
_GRADED = ", ".join(f"round({f}, 6) as {f}" for f in FEATURES if not f.startswith("shared"))
_SHARED = [f for f in FEATURES if f.startswith("shared")]
ORACLES["pair_features"] = _FEAT + f"select id_a, id_b, n_pairs, {_GRADED}, {', '.join(_SHARED)} from feat"
ORACLES["feature_frame"] = (
    _FEAT + f"select id_a, id_b, n_pairs, {_GRADED}, {', '.join(f'{f}::int::double as {f}' for f in _SHARED)} from feat"
)
_ROUND = "round(posterior, 6) as posterior, round(total_bits, 6) as total_bits"
ORACLES["fs_score"] = _SCORE + f"select id_a, id_b, {_ROUND}, decision from scored"
_CONTRIB = " || ',' || ".join(f"'{f}=' || ({_agrees(f)})::int" for f in FIELD_ORDER)
ORACLES["resolve_links"] = _LINK + f"select id_a, id_b, n_pairs, {_ROUND}, decision, {_CONTRIB} as contributions from links"
ORACLES["entity_groups"] = (
    _LINK.replace("with ", "with recursive ", 1)
    + ", members as (select min(drugbank_id) over (partition by nn, cas_num, pubchem_cid, chembl_id, skeleton) as profile, drugbank_id as id from keyed),"
    " e as (select id_a as a, id_b as b from links union select id_b, id_a from links),"
    " reach as (select a as id, b as r from e union select reach.id, e.b from reach join e on e.a = reach.r),"
    " least as (select id, least(id, min(r)) as entity from reach group by id)"
    " select m.id, coalesce(l.entity, m.id) as entity_id from members m left join least l on l.id = m.profile"
)
ORACLES["link_totals"] = _LINK + "select decision, sum(n_pairs)::bigint as n_pairs from links group by decision"


def _reason(f: str) -> str:
    def told(agreed: bool) -> str:
        bits = _MODEL.bits(f, agreed)
        text = f"{WORDING[f]} {'agreement' if agreed else 'disagreement'}: {bits:+.1f} bits"
        return f"{{'k': {-abs(bits)!r}, 'i': {FIELD_ORDER.index(f)}, 't': '{text}'}}"

    return f"case when {_agrees(f)} then {told(True)} else {told(False)} end"


_REASONS = f"list_transform(list_sort([{', '.join(_reason(f) for f in FIELD_ORDER)}]), lambda r: r.t)"
ORACLES["explain_links"] = (
    _LINK + f", told as (select *, {_REASONS} as rs from links) select id_a, id_b, array_to_string(rs, '|') as reasons,"
    " id_a || ' ~ ' || id_b || ': ' || upper(decision) || ' (posterior ' || printf('%.3f', posterior) || ', total ' ||"
    " printf('%+.1f', total_bits) || ' bits) — ' || array_to_string(rs, '; ') as summary from told"
)
ORACLES["top_links"] = (
    _LINK + ", members as (select min(drugbank_id) over (partition by nn, cas_num, pubchem_cid, chembl_id, skeleton) as profile,"
    " drugbank_id as id from keyed), every as (select least(x.id, y.id) as a, greatest(x.id, y.id) as b, l.posterior, l.total_bits, l.decision"
    " from links l join members x on x.profile = l.id_a join members y on y.profile = l.id_b where l.id_a <> l.id_b or x.id < y.id)"
    f" select a as id_a, b as id_b, {_ROUND}, decision from every order by every.posterior desc, a, b limit 25"
)

# ---- weak labels -----------------------------------------------------------------------------------

ORACLES["weak_votes"] = _WEAK + f"select id_a, id_b, n_pairs, {', '.join(VOTES)} from votes"
ORACLES["majority_label"] = (
    _WEAK + "select id_a, id_b, label, round(list_sum(cast_votes)::double / len(cast_votes), 6) as prob_match from majority where label <> -1"
)
ORACLES["label_retention"] = (
    _WEAK + "select sum(case when label <> -1 then n_pairs else 0 end)::bigint as labelled, sum(n_pairs)::bigint as total,"
    " round(sum(case when label <> -1 then n_pairs else 0 end)::double / sum(n_pairs), 6) as retention from majority"
)


def _report(i: int, v: str) -> str:
    others = f"list_filter([{', '.join(o for o in VOTES if o != v)}], lambda o: o <> -1)"
    return (
        f"select '{v}' as lf, {i} as position,"
        f" array_to_string(list_sort(list(distinct {v}) filter (where {v} <> -1)), ',') as polarity,"
        f" round(sum(n_pairs) filter (where {v} <> -1)::double / sum(n_pairs), 6) as coverage,"
        f" round(sum(n_pairs) filter (where {v} <> -1 and len({others}) > 0)::double / sum(n_pairs), 6) as \"overlaps\","
        f" round(sum(n_pairs) filter (where {v} <> -1 and len(list_filter({others}, lambda o: o <> {v})) > 0)::double / sum(n_pairs), 6)"
        " as conflicts from votes"
    )


_SHARES = ", ".join(f'coalesce("{c}", 0.0) as "{c}"' for c in ("coverage", "overlaps", "conflicts"))
ORACLES["lf_report"] = (
    _WEAK + f"select lf, position, coalesce(polarity, '') as polarity, {_SHARES} from ("
    + " union all ".join(_report(i, v) for i, v in enumerate(VOTES)) + ")"
)

# ---- mentions, neighbours, search ------------------------------------------------------------------

_MENTIONS = (
    f"phrases as (select distinct trim({_norm('p')}) as phrase from (select unnest(regexp_split_to_array(text, '[.,\\n]')) as p from benchmark)),"
    " known as (select phrase, string_split(phrase, ' ') as w from phrases where phrase <> ''),"
    f" docs as (select doc_id, string_split({_norm('text')}, ' ') as toks from documents),"
    " spots as (select doc_id, unnest(range(1, len(toks) + 1)) as position, unnest(toks) as t1, unnest(list_append(toks[2:], null)) as t2 from docs),"
    " near as (select s.doc_id, s.position, k.phrase, len(k.w) as n from spots s join known k on len(k.w) = 1 and s.t1 = k.w[1]"
    " union all select s.doc_id, s.position, k.phrase, len(k.w) from spots s join known k on s.t1 = k.w[1] and s.t2 = k.w[2]),"
    " hits as (select d.doc_id, c.position::int as position, c.phrase as name from near c join docs d on d.doc_id = c.doc_id"
    " where array_to_string(d.toks[c.position:c.position + c.n - 1], ' ') = c.phrase)"
)
ORACLES["mention_rows"] = f"with {_MENTIONS} select doc_id, position, name from hits"
ORACLES["extract_mentions"] = (
    f"with {_MENTIONS}, agg as (select doc_id, count(*) as n, string_agg(name, '|' order by position, name) as mentions from hits group by doc_id)"
    " select d.doc_id, coalesce(a.n, 0)::int as n, coalesce(a.mentions, '') as mentions from documents d left join agg a on a.doc_id = d.doc_id"
)


ORACLES["knn_pairs"] = (
    "with v as (select vec_id, embedding::double[] as e from embeddings), s as (select a.vec_id as id, b.vec_id as neighbour,"
    " round(list_cosine_similarity(a.e, b.e), 6) as cosine from v a join v b on a.vec_id <> b.vec_id),"
    " r as (select *, row_number() over (partition by id order by cosine desc, neighbour) as rank from s)"
    " select id, neighbour, cosine, rank::int as rank from r where rank <= 10"
)
_WORDS = r"regexp_extract_all(lower({0}), '([\p{{L}}\p{{N}}\p{{M}}_]+(?:[''’.][\p{{L}}\p{{N}}\p{{M}}_]+)*)', 1)"


def _metaphone(x: str) -> str:
    code = f"regexp_replace(upper(replace({x}, 'ß', 'ss')), '[^A-Z]', '', 'g')"
    for letter in "ABDEFGHIJKLMNOPQRSTUVWXYZ":
        code = f"regexp_replace({code}, '{letter}+', '{letter}', 'g')"
    for pattern, replacement in RULES:
        code = f"regexp_replace({code}, '{pattern}', '{replacement.replace('$', chr(92))}', 'g')"
    return code


_CODES = (
    f"codes as (select token, {_metaphone('token')} as c from (select distinct unnest({_WORDS.format('name')}) as token from registry)),"
    " sounds as (select token, nullif(substr(upper(translate(substr(c, 1, 1) || regexp_replace(substr(c, 2), '[AEIOU]', '', 'g'),"
    f" '{SAME_SOUND[0]}', '{SAME_SOUND[1]}')), 1, {LONGEST}), '') as code from codes)"
)
ORACLES["sound_codes"] = f"with {_REG}, {_CODES} select token, code from sounds"


def _index(prefix: str, rows: str, keep: str) -> str:
    """CTE {prefix}toks of (keep, view, length, token) for rows with the words in w; needs `sounds`."""
    heard = (
        f"{prefix}heard as (select {keep}, unnest(list_distinct([t, code])) as token from"
        f" (select {keep}, unnest(w) as t from {rows}) join sounds on token = t)"
    )
    return (
        f"{heard}, {prefix}toks as (select {keep}, 'words' as view, len(w) as length, unnest(w) as token from {rows} union all"
        f" select {keep}, 'autocomplete', len(g), unnest(g) from (select {keep}, flatten(list_transform(w, lambda t:"
        f" list_transform(range(2, least(20, length(t)) + 1), lambda i: substr(t, 1, i)))) as g from {rows}) union all"
        f" select {keep}, 'phonetic', (count(*) over (partition by {keep}))::bigint, token from {prefix}heard where token is not null)"
    )


_POSTINGS = (
    f"named0 as (select name, count(*) as n, {_WORDS.format('name')} as w from registry group by name), {_index('x', 'named0', 'name, n')},"
    " postings as (select view, token, name, n, length, count(*) as tf from xtoks group by view, token, name, n, length)"
)
_TEXTS = (
    "texts as (select distinct trim(p) as t from (select unnest(regexp_split_to_array(text, '[.,\\n]')) as p from benchmark) where trim(p) <> '')"
)
ORACLES["name_index"] = f"with {_REG}, {_CODES}, {_POSTINGS} select view, token, name, n, length::int as length, tf from postings"
ORACLES["index_upkeep"] = ORACLES["name_index"]
_ASCII = "translate({0}, 'àâäáãçèéêëìíîïñòóôöõùúûüýßæøœ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ!#$')"
_FUZZY = (
    "terms as (select distinct token as term from postings where view = 'words'), "
    f"{_TEXTS}, q as (select distinct token, case when length(token) <= 2 then 0 when length(token) <= 5 then 1 else 2 end as edits"
    f" from (select unnest({_WORDS.format('t')}) as token from texts)),"
    f" d as (select token, term, edits, levenshtein({_ASCII.format('token')}, {_ASCII.format('term')}) as d from q join terms"
    " on abs(length(token) - length(term)) <= edits), fuzzy as (select token, term, 1.0 - d::double / least(length(token), length(term))"
    " as weight from d where d <= edits and d < least(length(token), length(term)))"
)
ORACLES["fuzzy_terms"] = f"with {_REG}, {_CODES}, {_POSTINGS}, {_FUZZY} select token, term, round(weight, 6) as weight from fuzzy"
_QCODES = _CODES.replace("from registry)", f"from registry union select distinct unnest({_WORDS.format('t')}) from texts)")
ORACLES["search_names"] = (
    f"with {_REG}, {_TEXTS}, {_QCODES}, {_POSTINGS}, {_FUZZY.replace(_TEXTS + ', ', '')},"
    f" asked as (select md5(t) as query_id, {_WORDS.format('t')} as w from texts), {_index('q', 'asked', 'query_id')},"
    " wanted as (select query_id, view, token, count(*)::double as qtf from qtoks group by query_id, view, token),"
    " weighted as (select query_id, view, term as token, sum(qtf * weight) as qtf from wanted join fuzzy using (token) where view = 'words'"
    " group by query_id, view, term union all select * from wanted where view <> 'words'),"
    " freq as (select view, token, sum(n)::double as df from postings group by view, token),"
    " stats as (select view, sum(n)::double as docs, sum(n * length)::double / sum(n) as avg_length from"
    " (select distinct view, name, n, length from postings) group by view),"
    " priced as (select query_id, w.view, w.token, avg_length, qtf * ln(1.0 + (docs - df + 0.5) / (df + 0.5)) * case w.view"
    " when 'words' then 3.0 when 'phonetic' then 2.0 else 1.0 end as w from weighted w join freq f on f.view = w.view and f.token = w.token"
    " join stats s on s.view = w.view), scores as (select query_id, name, n, round(sum(w * tf / (tf + 1.2 * (0.25 + 0.75 * length / avg_length))), 6)"
    " as score from priced p join postings x on x.view = p.view and x.token = p.token group by query_id, name, n)"
    " select * from (select query_id, name, n, score, row_number() over (partition by query_id order by score desc, name)::int as rank from scores)"
    " where rank <= 10"
)
# Invariants: the rule says what must hold, the query finds out whether it does.
ORACLES["anomaly_checks"] = (
    "select unnest(['each row scored once', 'scores in range', 'equal rows, equal scores', 'flags follow scores',"
    " 'share flagged, at least', 'share flagged, at most', 'planted rows flagged']) as \"check\", true as holds"
)

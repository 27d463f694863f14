"""The registry build: an ordered list of named passes, each a function from table to table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame

from recordloom.operators.enrich import (
    KEGG_FILLS,
    STITCH_FILLS,
    TTD_FILLS,
    Audit,
    apply_lookup,
    merge_by_id,
    merge_by_name,
)

log = logging.getLogger(__name__)

Pass = Callable[[DataFrame], DataFrame]

# The passes of a full build. Earlier ones win, since a filled value stays.
DEFAULT_ORDER = [
    "drugbank-base", "ttd-merge", "chembl-unichem", "pubchem-pugrest", "kegg-file", "umls-cuis", "stitch-sider", "dgidb",
]


def standard_passes(sources: Mapping[str, DataFrame], on_duplicate: str = "all", audited: bool = False) -> dict[str, Pass]:
    """The named passes over the given tables: base, ttd, kegg, stitch, and the (id, value) lookups
    chembl, pubchem, umls. A pass whose table is not given leaves the rows as they are."""

    def audit(source: str, method: str) -> Audit | None:
        return Audit(source, method) if audited else None

    def using(source: str, step: Callable[[DataFrame, DataFrame], DataFrame]) -> Pass:
        return (lambda df: step(df, sources[source])) if source in sources else (lambda df: df)

    def lookup(source: str, column: str) -> Pass:
        return using(source, lambda df, s: apply_lookup(df, s, column, audit(source, "lookup")))

    return {
        "drugbank-base": using("base", lambda df, s: s),
        "ttd-merge": using("ttd", lambda df, s: merge_by_name(df, s, TTD_FILLS, on_duplicate, audit("ttd", "name"))),
        "chembl-unichem": lookup("chembl", "chembl_id"),
        "pubchem-pugrest": lookup("pubchem", "pubchem_cid"),
        "kegg-file": using("kegg", lambda df, s: merge_by_name(df, s, KEGG_FILLS, on_duplicate, audit("kegg", "name"))),
        "umls-cuis": lookup("umls", "umls_cuis"),
        "stitch-sider": using("stitch", lambda df, s: merge_by_id(df, s, STITCH_FILLS, audit=audit("stitch", "id"))),
        # Evidence only; see `corroborate`.
        "dgidb": lambda df: df,
    }


def run_passes(seed: DataFrame, order: Iterable[str], passes: Mapping[str, Pass]) -> DataFrame:
    """Apply the named passes in order; unknown names are skipped with a warning."""

    def step(df: DataFrame, name: str) -> DataFrame:
        if name not in passes:
            log.warning("unknown pass %r skipped", name)
            return df
        return df.transform(passes[name])

    return reduce(step, order, seed)

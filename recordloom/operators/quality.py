"""Data-quality signals of entity rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.functions.text import is_valid_cas
from recordloom.schema import filled_id_count

QUALITY = ["cas_invalid", "name_len", "non_ascii", "filled_ids", "pubchem_malformed"]


def quality_features(entities: DataFrame) -> DataFrame:
    """Per row: wrong CAS check digit, name length, non-ASCII letters, ids present, PubChem id with a
    non-digit. An absent id is neither invalid nor malformed."""
    cas, pubchem = F.col("cas_num"), F.col("pubchem_cid")
    signals = [
        cas.isNotNull() & ~is_valid_cas(cas),
        F.length("name"),
        F.length(F.regexp_replace("name", r"[\x00-\x7F]", "")),
        filled_id_count(),
        F.coalesce(~F.rlike(pubchem, F.lit(r"^\p{Nd}*$")), F.lit(False)),
    ]
    return entities.select("drugbank_id", *[s.cast("double").alias(n) for n, s in zip(QUALITY, signals)])

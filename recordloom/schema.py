"""Column layout of the cross-reference table and of the partial source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Internal column -> column name of the exchanged file, in file order.
CONTRACT = {
    "drugbank_id": "drugbankId",
    "name": "name",
    "ttd_id": "ttd_id",
    "pubchem_cid": "pubchem_cid",
    "cas_num": "cas_num",
    "chembl_id": "chembl_id",
    "zinc_id": "zinc_id",
    "chebi_id": "chebi_id",
    "kegg_cid": "kegg_cid",
    "kegg_id": "kegg_id",
    "bindingdb_id": "bindingDB_id",
    "umls_cuis": "UMLS_cuis",
    "stitch_id": "stitch_id",
}
NULL_TOKEN = "null"

ENTITY_COLUMNS = list(CONTRACT)
REQUIRED = ["drugbank_id", "name"]
SCALAR_IDS = [c for c in ENTITY_COLUMNS if c not in REQUIRED and c != "umls_cuis"]

ENTITY_SCHEMA = T.StructType(
    [
        T.StructField(
            c,
            T.ArrayType(T.StringType(), False) if c == "umls_cuis" else T.StringType(),
            c not in REQUIRED and c != "umls_cuis",
        )
        for c in ENTITY_COLUMNS
    ]
)

LOOKUP_SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("value", T.StringType())])

# Source key -> contract column the source fills.
SOURCES = {
    "drugbank": "drugbankId",
    "ttd": "ttd_id",
    "pubchem": "pubchem_cid",
    "chembl": "chembl_id",
    "zinc": "zinc_id",
    "chebi": "chebi_id",
    "kegg": "kegg_id",
    "bindingdb": "bindingDB_id",
    "umls": "UMLS_cuis",
    "stitch": "stitch_id",
    "cas": "cas_num",
}


def source_column(key: Column) -> Column:
    """Contract column a source key fills (case does not matter); NULL for an unknown key."""
    table = F.create_map(*[F.lit(x) for pair in SOURCES.items() for x in pair])
    return F.try_element_at(table, F.lower(key))


def as_entities(df: DataFrame) -> DataFrame:
    """Give `df` every entity column in order; ones it lacks become NULL (or an empty CUI list)."""

    def column(name: str) -> Column:
        if name == "umls_cuis":
            empty = F.array().cast("array<string>")
            return (F.coalesce(F.col(name), empty) if name in df.columns else empty).alias(name)
        return (F.col(name) if name in df.columns else F.lit(None).cast("string")).alias(name)

    return df.select(*[column(c) for c in ENTITY_COLUMNS])


def empty_entities(spark: SparkSession) -> DataFrame:
    """The empty table a run of passes starts from."""
    return spark.createDataFrame([], ENTITY_SCHEMA)


def filled_id_count(prefix: str = "") -> Column:
    """How many of the ten scalar ids and the CUI list are present (0 to 11)."""
    scalars = [F.col(prefix + c).isNotNull().cast("int") for c in SCALAR_IDS]
    total = (F.size(prefix + "umls_cuis") > 0).cast("int")
    for s in scalars:
        total = total + s
    return total

"""Registry-shaped tables derived from the given tables, stated once in SQL that Spark and DuckDB
both run. `{documents}` and `{registry}` stand for the table each engine reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.schema import as_entities

# One record per document. Exact copies share a ChEMBL id, equal openings the structure, equal lengths
# the CAS and PubChem ids; some ids are absent and some CAS check digits wrong.
REGISTRY = """
with b as (
  select doc_id, text, n_chars, lang, source, cast(100000 + n_chars % 900000 as string) body,
         case when doc_id % 7 = 0 then ' Sodium'
              when doc_id % 7 = 1 then ' Hydrochloride' else '' end salt
  from {documents}),
c as (
  select *, (cast(substr(body,6,1) as int)*1 + cast(substr(body,5,1) as int)*2
           + cast(substr(body,4,1) as int)*3 + cast(substr(body,3,1) as int)*4
           + cast(substr(body,2,1) as int)*5 + cast(substr(body,1,1) as int)*6) chk
  from b)
select doc_id, 'DB' || lpad(cast(doc_id as string), 8, '0') as drugbank_id,
       trim(replace(replace(substr(text,1,40), chr(10), ' '), chr(9), ' ')) || salt as name,
       case when doc_id % 4 = 0 then null
            else substr(body,1,4) || '-' || substr(body,5,2) || '-' ||
                 cast((chk + case when doc_id % 29 = 0 then 1 else 0 end) % 10 as string) end as cas_num,
       case when doc_id % 5 = 0 then null
            when doc_id % 37 = 0 then 'x' || cast(n_chars*7 as string)
            else cast(n_chars*7 as string) end as pubchem_cid,
       case when doc_id % 3 = 0 then null else 'CHEMBL' || substr(md5(text),1,8) end as chembl_id,
       case when doc_id % 2 = 0 then null
            else upper(substr(md5(substr(text,1,64)),1,14)) || '-UHFFFAOYSA-N' end as inchi_key,
       case when lang = 'en' then null else 'H' || cast(n_chars as string) end as stitch_id,
       case when lang = 'fr' then null else 'C' || cast(n_chars as string) || ',C' || source end as cuis
from c
"""

# Other sources, told apart from the registry by their own ids. Several raw names fall on one salt-free
# name, so merges by name meet duplicates.
TTD = """
select 'T' || min(drugbank_id) as ttd_id, name, max(cas_num) as cas_num, min(pubchem_cid) as pubchem_cid
from {registry} group by name
"""
KEGG = """
select 'D' || max(drugbank_id) as kegg_id, lower(name) as name, min(cas_num) as cas_num,
       min(pubchem_cid) as pubchem_cid, 'CHEBI' || min(chembl_id) as chebi_id
from {registry} group by lower(name)
"""
STITCH = "select drugbank_id, 'S' || substr(drugbank_id, 3) as stitch_id from {registry}"
CHEMBL_LOOKUP = "select drugbank_id as id, 'CHEMBL' || substr(md5(name), 1, 6) as value from {registry} where cas_num is not null"
PUBCHEM_LOOKUP = "select drugbank_id as id, substr(cas_num, 1, 4) as value from {registry} where cas_num is not null"
UMLS_LOOKUP = "select drugbank_id as id, cuis as value from {registry} where cuis is not null"
EVIDENCE = """
select case when stitch_id is null then null else drugbank_id end as drugbank_id, name,
       case when cas_num is null then chembl_id else 'chembl:CHEMBL' || substr(md5(name), 1, 8) end as chembl_id
from {registry}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REGISTRY, documents=table(spark, sf_dir, "documents"))


def derived(reg: DataFrame, sql: str) -> DataFrame:
    return reg.sparkSession.sql(sql, registry=reg)


def entities(reg: DataFrame) -> DataFrame:
    """The registry in the full entity layout, with its codes as a list."""
    return as_entities(reg.withColumn("umls_cuis", F.split("cuis", ",")))


def bare(reg: DataFrame) -> DataFrame:
    """Entities as a first source delivers them: ids of the registry file, no codes, no STITCH id."""
    return as_entities(reg.drop("stitch_id"))

import pytest
from pyspark.sql import functions as F

from recordloom.schema import CONTRACT, as_entities
from recordloom.sinks.registry import registry_row, write_registry_sharded, write_registry_tsv
from recordloom.sinks.snapshots import ConcurrentCommit, extend_lookup, latest_version, read_snapshot, write_snapshot
from recordloom.sinks.tables import upsert_by_key, write_lookup
from recordloom.sources.blocks import read_kv_blocks, read_tagged_blocks
from recordloom.sources.payloads import decode_payloads
from recordloom.sources.tables import (
    lookup_from_rows,
    malformed_registry_lines,
    read_crosscheck,
    read_id_map,
    read_lookup,
    read_registry_tsv,
)
from recordloom.sources.xml import read_entity_xml, unparsed_records

XML = """<registry>
  <drug type="small molecule">
    <drugbank-id primary="true">DB70412</drugbank-id>
    <drugbank-id>OLD-3</drugbank-id>
    <name>  Morvexane </name>
    <cas-number></cas-number>
    <external-identifiers>
      <external-identifier><resource>BindingDB</resource><identifier>81</identifier></external-identifier>
      <external-identifier><resource> KEGG Compound </resource><identifier> K-19 </identifier></external-identifier>
      <external-identifier><resource>PubChem Substance</resource><identifier>3301</identifier></external-identifier>
      <external-identifier><resource>Unknown Catalogue</resource><identifier>u</identifier></external-identifier>
    </external-identifiers>
  </drug>
  <drug><name>Nameless in the index</name><cas-number>11-22-3</cas-number></drug>
  <drug type="biotech">
    <drugbank-id>SPARE</drugbank-id>
    <drugbank-id primary="true">DB70001</drugbank-id>
    <description>Invented peptide; binds &lt;nothing&gt; &amp; stays stable.</description>
    <name>Tralu &amp; Quell</name>
    <mixtures><mixture><drug><drugbank-id primary="true">INNER</drugbank-id></drug></mixture></mixtures>
    <calculated-properties>
      <property><kind>INCHIKEY</kind><value>QQQQWWWWEEEERR-TTTTYYYYUU-Z</value></property>
      <property><kind>InChIKey</kind><value>second</value></property>
    </calculated-properties>
    <external-identifiers>
      <external-identifier><resource>ChEMBL</resource><identifier>M-1</identifier></external-identifier>
      <external-identifier><resource>ChEMBL</resource><identifier/></external-identifier>
      <external-identifier><resource>PubChem Compound</resource><identifier>640</identifier></external-identifier>
      <external-identifier><resource>PubChem Substance</resource><identifier>999</identifier></external-identifier>
      <external-identifier><resource>PubChem Compound</resource><identifier>641</identifier></external-identifier>
    </external-identifiers>
    <cas-number> 900-12-7 </cas-number>
  </drug>
</registry>
"""


def test_xml(spark, tmp_path):
    path = tmp_path / "dump.xml"
    path.write_text(XML)
    rows = {r["drugbank_id"]: r for r in read_entity_xml(spark, str(path), with_text=True).collect()}
    assert set(rows) == {"DB70412", "DB70001"}
    plain, peptide = rows["DB70412"], rows["DB70001"]
    assert (plain["name"], plain["cas_num"], plain["description"], plain["inchi_key"]) == ("Morvexane", None, None, None)
    assert (plain["pubchem_cid"], plain["kegg_cid"], plain["bindingdb_id"], plain["kegg_id"]) == ("3301", "K-19", "81", None)
    assert (peptide["name"], peptide["cas_num"], peptide["pubchem_cid"]) == ("Tralu & Quell", "900-12-7", "641")
    assert (peptide["chembl_id"], peptide["inchi_key"]) == ("M-1", "QQQQWWWWEEEERR-TTTTYYYYUU-Z")
    assert "<nothing> & stays" in peptide["description"] and peptide["umls_cuis"] == []
    assert read_entity_xml(spark, str(path)).columns == list(CONTRACT)


def test_tagged_blocks(spark, tmp_path):
    path = tmp_path / "drug"
    path.write_text(
        "NAME        Adrift\n///\n"
        "ENTRY       T-5 Mixture\nDBLINKS     ChEBI: .\n            CAS: 7-7-7\n///\n"
        "ENTRY       T-40                        Drug\n"
        "NAME        Sorbelline (made up);\n            Sorb (short)\n"
        "REMARK      PubChem: 1\n"
        "DBLINKS     PubChem: 508\n            CAS: 31-41-5\n            ChEBI: 62\n///\n"
    )
    rows = {r["kegg_id"]: r.asDict() for r in read_tagged_blocks(spark, str(path)).collect()}
    assert rows["T-40"] == {
        "kegg_id": "T-40", "name": "Sorbelline (made up)", "cas_num": "31-41-5", "chebi_id": "62", "pubchem_cid": "508",
    }
    assert rows["T-5"] == {"kegg_id": "T-5", "name": "", "cas_num": "7-7-7", "chebi_id": None, "pubchem_cid": None}
    assert len(rows) == 2


def test_kv_blocks(spark, tmp_path):
    path = tmp_path / "kv"
    path.write_text(
        "header without tab\n\n\n"
        "ttddrugid \tD1\nDRUGNAME\told\nDRUGNAME\tFennolac\nCASNUMBER\t64-1-8\nPUBCHCID\t.\n  \t \n"
        "TTDDRUGID\tD2\nDRUGNAME\tTab\tinside\n\nTTDDRUGID\tD3\n"
    )
    rows = {r["ttd_id"]: r for r in read_kv_blocks(spark, str(path)).collect()}
    assert set(rows) == {"D1", "D2"}
    assert (rows["D1"]["name"], rows["D1"]["cas_num"], rows["D1"]["pubchem_cid"]) == ("Fennolac", "64-1-8", None)
    assert rows["D2"]["name"] == "Tab\tinside"
    crlf = tmp_path / "crlf"
    crlf.write_bytes(b"TTDDRUGID\tD1\r\nDRUGNAME\ta\r\n\r\nTTDDRUGID\tD2\r\nDRUGNAME\tb\r\n")
    assert {r["ttd_id"] for r in read_kv_blocks(spark, str(crlf), newline="\r\n").collect()} == {"D1", "D2"}


def test_tsv_maps(spark, tmp_path):
    ids = tmp_path / "ids.tsv"
    ids.write_text("a\tb\textra\n DB1 \t CID1 \tx\nDB2\t \tx\n")
    assert [tuple(r) for r in read_id_map(spark, str(ids)).collect()] == [("DB1", "CID1")]
    cross = tmp_path / "cross.tsv"
    cross.write_text("name\tconcept_id\tsource\nFennolac\tC1\t\n.\tC2\tX\n")
    assert [tuple(r) for r in read_crosscheck(spark, str(cross)).collect()] == [("C1", "Fennolac", None, "DGIdb")]


def entities(spark):
    rows = [("DB2", "b", "2", None), ("DB1", "a", None, ["C1", "C2"]), ("DB3", "c", "", [])]
    return as_entities(spark.createDataFrame(rows, "drugbank_id string, name string, pubchem_cid string, umls_cuis array<string>"))


def joined(path):
    return "".join(p.read_text() for p in sorted(path.glob("part-*")))


def test_registry_file(spark, tmp_path):
    write_registry_tsv(entities(spark), str(tmp_path / "out"))
    lines = joined(tmp_path / "out").split("\n")
    nulls = ["null"] * 9
    assert lines[0] == "\t".join(CONTRACT.values()) and lines[-1] == ""
    assert [x.split("\t")[0] for x in lines[1:-1]] == ["DB1", "DB2", "DB3"]
    assert lines[1].split("\t") == ["DB1", "a", *nulls, "C1,C2", "null"]
    back = read_registry_tsv(spark, str(tmp_path / "out"))
    assert [(r["drugbank_id"], r["pubchem_cid"], r["umls_cuis"]) for r in back.orderBy("drugbank_id").collect()] == [
        ("DB1", None, ["C1", "C2"]), ("DB2", "2", []), ("DB3", None, []),
    ]
    write_registry_sharded(entities(spark), str(tmp_path / "shards"))
    assert read_registry_tsv(spark, str(tmp_path / "shards")).count() == 3
    assert entities(spark).select(registry_row().alias("x")).first()["x"].split("\t")[2] == "null"


def test_malformed_lines(spark, tmp_path):
    path = tmp_path / "bad.tsv"
    path.write_text("DB1\ta\n" + "\t".join(["DB2", "b"] + [""] * 11) + "\n")
    assert [r["error"] for r in malformed_registry_lines(spark, str(path)).collect()] == ["expected 13 columns, got 2"]
    assert [r["drugbank_id"] for r in read_registry_tsv(spark, str(path)).collect()] == ["DB2"]


def test_lookup(spark, tmp_path):
    path = str(tmp_path / "lookup")
    assert read_lookup(spark, path) is None
    write_lookup(lookup_from_rows(spark, [("a", "1")]), path)
    assert [tuple(r) for r in read_lookup(spark, path).collect()] == [("a", "1")]


def test_payloads(spark):
    rows = [
        ("1", "pubchem", 200, '{"IdentifierList":{"CID":[71,8,9]}}'),
        ("2", "dgidb", 200, '{"matchedTerms":[{"conceptId":"made:up-3","drugName":"Sorbelline"},{"conceptId":"made:up-4"}],"extra":1}'),
        ("3", "unichem", 200, '[{"src_compound_id":"M-6","weight":2}]'),
        ("4", "umls", 200, '{"result":{"results":[{"ui":"K2"},{"ui":"NONE"},{"name":"Fennolac","ui":"K1"},{"ui":"K2"}]}}'),
        ("5", "unichem", 404, '{"error":"none"}'),
        ("6", "pubchem", 200, "<html>"),
        ("7", "unichem", 200, "[]"),
        ("8", "umls", 200, '{"result":{"results":[{"ui":"NONE","name":"x"}]}}'),
    ]
    df = spark.createDataFrame(rows, "id string, kind string, status int, body string")
    got = {r["id"]: r["value"] for r in decode_payloads(df).collect()}
    assert got == {"1": "71", "2": "made:up-3", "3": "M-6", "4": "K2,K1", "5": None, "6": None, "7": None, "8": None}


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, p string, q string")
    new = spark.createDataFrame([(2, None, "z"), (3, "c", None), (3, "b", "w")], "k int, p string, q string")
    got = {r["k"]: (r["p"], r["q"]) for r in upsert_by_key(old, new, "k").collect()}
    assert got == {1: ("a", "x"), 2: ("b", "z"), 3: ("c", "w")}
    assert upsert_by_key(old, new, "k").where(F.col("k") == 1).count() == 1
    timed = spark.createDataFrame([(2, "new", None, 9), (2, "old", "z", 4), (2, None, "y", 3)], "k int, p string, q string, at int")
    got = {r["k"]: (r["p"], r["q"]) for r in upsert_by_key(old, timed, "k", order_by="at").collect()}
    assert got == {1: ("a", "x"), 2: ("new", "z")}


def dump_of(n):
    """Records of several lines, every fifth with records inside, and one that is not well formed."""
    parts = ['<?xml version="1.0" encoding="UTF-8"?>\n<drugs xmlns="urn:x">']
    for i in range(n):
        inner = "<others>\n" + "".join(f'<drug kind="x"><name>inner {i}.{j}</name></drug>' for j in range(i % 3 + 1)) + "<drug/></others>" if i % 5 == 0 else ""
        parts.append(
            f'<drug type="small">\n  <drugbank-id>old{i}</drugbank-id><drugbank-id primary="true">DB{i:05d}</drugbank-id>\n'
            f"  {inner}<name>Name {i} é &amp; more</name>\n  <description>{'text ' * (i % 40)}</description>\n</drug>"
        )
    parts.append("<drug><name>broken</nam></drug>")
    return "\n".join(parts) + "\n</drugs>\n"


@pytest.mark.parametrize("split", [700, 5_000, 10_000_000])
def test_one_xml_file_is_read_in_parts(spark, tmp_path, split):
    (tmp_path / "a.xml").write_text(dump_of(200), encoding="utf-8")
    (tmp_path / "b.xml").write_text('<drugs><drug><drugbank-id primary="true">DB9</drugbank-id></drug></drugs>')
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        rows = {r["drugbank_id"]: r["name"] for r in read_entity_xml(spark, str(tmp_path / "*.xml")).collect()}
        assert rows == {**{f"DB{i:05d}": f"Name {i} é & more" for i in range(200)}, "DB9": ""}
        assert unparsed_records(spark, str(tmp_path)) == 1
        parts = spark.read.option("lineSep", "</drug>").text(str(tmp_path / "a.xml")).rdd.getNumPartitions()
        assert parts > 1 or split == 10_000_000
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_xml_without_records(spark, tmp_path):
    (tmp_path / "none.xml").write_text("<drugs></drugs>")
    assert read_entity_xml(spark, str(tmp_path)).collect() == []


def test_lookup_rounds_and_snapshots(spark, tmp_path):
    path = str(tmp_path / "rounds")
    assert read_snapshot(spark, path) is None and latest_version(spark, path) == 0
    pairs = lambda df: sorted((r.id, r.value) for r in df.collect())
    answers = lookup_from_rows(spark, [("a", "2"), ("a", "1"), ("c", "9")])
    asked = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    assert pairs(extend_lookup(spark, path, answers, asked)) == [("a", "1"), ("b", None), ("c", "9")]
    # The table is read and rewritten; an answer replaces none or an older one, no answer replaces nothing.
    again = spark.createDataFrame([("a",), ("c",)], "id string")
    later = extend_lookup(spark, path, lookup_from_rows(spark, [("b", "7"), ("c", "8")]), again)
    assert pairs(later) == [("a", "1"), ("b", "7"), ("c", "8")]
    assert pairs(read_snapshot(spark, path, 1)) == [("a", "1"), ("b", None), ("c", "9")]
    # Whoever started from an older version does not commit, and a failed write leaves the last snapshot.
    with pytest.raises(ConcurrentCommit):
        write_snapshot(answers, path, base=1)
    with pytest.raises(Exception):
        extend_lookup(spark, path, answers.select("id", F.raise_error(F.lit("no")).cast("string").alias("value")))
    # A writer that died while naming its folder.
    (tmp_path / "rounds" / "versions" / "0000000003").write_text("half")
    assert latest_version(spark, path) == 2 and pairs(read_snapshot(spark, path)) == pairs(later)
    assert pairs(extend_lookup(spark, path, lookup_from_rows(spark, []))) == pairs(later) and latest_version(spark, path) == 4

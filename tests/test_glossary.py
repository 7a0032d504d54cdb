from evigraph import schema
from evigraph.functions import kernel as K

TERMS = [("CSG", "Coast Signal Group"), ("MUN", "Mutual CSG Network"), ("HX-7", "Ship Seven"), ("SSN", "Ship (hull number)"), ("", "x"), ("A", None)]


def test_acronyms_are_spelled_out_once():
    cases = {
        "CSG report": "Coast Signal Group (CSG) report", "CSG and CSG": "Coast Signal Group (CSG) and CSG", "report (CSG)": "report (CSG)", "note (by CSG) of CSG": "note (by CSG) of Coast Signal Group (CSG)", "CSG-11 crew": "CSG-11 crew", "CSGs": "CSGs",
        "Mutual CSG Network (MUN)": "Mutual CSG Network (MUN)", "MUN memo": "Mutual CSG Network (MUN) memo", "HX-7 and SSN": "HX-7 and SSN", "": "", "the Ship (a (b) CSG": "the Ship (a (b) CSG",
    }
    assert {n: K.apply_glossary(n, TERMS) for n in cases} == cases


def test_codenames():
    names = ["FASTGULL 01", "Poison", " tic tac ", "ab", None, ""]
    assert K.codename_roots(names) == {"FASTGULL 01", "FASTGULL", "Poison", "tic tac", "ab"}
    assert K.codename_in("FASTGULL flight", names) == "FASTGULL" and K.codename_in("Poisonous", names) is None and K.codename_in("a tic tac shape", names) == "tic tac"


def test_names_by_their_documents_glossary(spark):
    rows = [("CSG memo", "document", [("CSG", "Coast Signal Group")], ["FASTGULL 01"]), ("CSG Ann", "person", [("CSG", "Coast Signal Group")], []), ("FASTGULL CSG", "event", [("CSG", "Coast Signal Group")], ["FASTGULL 01"]), (None, "event", None, None), ("CSG", "event", None, None)]
    df = spark.createDataFrame(rows, "n string, k string, a array<struct<acronym:string,expansion:string>>, c array<string>")
    got = [tuple(r.g) for r in df.select(K.glossed_udf("n", "k", "a", "c").alias("g")).collect()]
    assert got == [("Coast Signal Group (CSG) memo", None), ("CSG Ann", None), ("FASTGULL CSG", "FASTGULL"), (None, None), ("CSG", None)]


def test_older_tables_are_read_with_what_they_lack(spark):
    r = schema.upgraded(spark.createDataFrame([("r1", "T")], "id string, title string"), "records").first()
    assert (r.work_id, r.metadata) == ("r1", None)
    c = schema.upgraded(spark.createDataFrame([("c1", None, "x"), ("c2", 0.5, "y")], "id string, confidence double, claim_hash string"), "claims").orderBy("id").collect()
    assert [(x.confidence, x.claim_hash, x.relay) for x in c] == [(1.0, "x", None), (0.5, "y", None)]

import pytest

from evigraph.functions import orders as O
from evigraph.sources import rewrite as R

PEOPLE = [("Captain Ada M. Brenner Jr", "Brenner Jr, Ada M."), ("Lieutenant Commander Moya", "Moya"), ("Lt. Tom Vale", "Vale, Tom"), ("Vale", "Vale"), ("Vale, Tom", "Vale, Tom"), ("Ada (pilot)", "Ada (pilot)"), ("Agent 7 Vale", "Agent 7 Vale"), ("Dr Vale III", "Vale III"), ("Moya Major", "Major, Moya"), ("", ""), (None, None)]
PLACES = [("Roswell New Mexico", "USA, New Mexico, Roswell"), ("New South Wales", "Australia, New South Wales"), ("Perth Western Australia", "Australia, Western Australia, Perth"), ("Mexico", "Mexico"), ("Reno, Nevada", "Reno, Nevada"), ("Old Washington DC", "USA, Washington DC, Old"), ("Arkansas", "USA, Arkansas"), ("", ""), (None, None)]


def test_orders(spark):
    df = spark.createDataFrame(PEOPLE, "n string, w string").select("w", O.surname_order("n").alias("g"))
    assert [r.g for r in df.collect()] == [w for _, w in PEOPLE]
    df = spark.createDataFrame(PLACES, "n string, w string").select("w", O.place_order("n").alias("g"))
    assert [r.g for r in df.collect()] == [w for _, w in PLACES]
    back = spark.createDataFrame([("Brenner Jr, Ada M.", "USA, New Mexico, Roswell"), ("Vale", "USA, Nevada"), ("Vale,", "Lima"), (None, None)], "p string, l string").select(O.natural_person("p"), O.natural_place("l")).collect()
    assert [tuple(r) for r in back] == [("Ada M. Brenner Jr", "Roswell New Mexico"), (None, "Nevada"), (None, None), (None, None)]
    assert O.COUNTRY_OF["Tasmania"] == "Australia" and len(O.COUNTRY_OF) == 97


ID = "0" * 8 + "-0000-0000-0000-" + "0" * 12
FILE = f"""# Digest
### {ID} person: Captain Ada Brenner
### {ID} place: Roswell New Mexico
### {ID} object: Coast Letter 1947
### {ID} object: Grey Disc
### {ID} [testimony] speaker:Captain Ada Brenner
refs: Roswell New Mexico, Captain Ada Brenner, Grey Disc
text: refs: Captain Ada Brenner
### {ID} [hearsay]
refs: Captain Ada Brenner; Nobody
"""


@pytest.fixture()
def lines(spark, tmp_path):
    (tmp_path / "a.extract.md").write_text(FILE)
    (tmp_path / "b.extract.md").write_text("refs: Captain Ada Brenner")
    (tmp_path / "c.md").write_text("### other")
    return R.digest_lines(spark, str(tmp_path))


def value(lines, name="a."):
    return next(r.value for r in R.texts(lines).collect() if f"/{name}" in r.path)


def test_files_stay_as_they_are(lines):
    assert value(lines) == FILE and R.texts(lines).count() == 2


def test_documents_and_renames(lines):
    x = R.with_documents(lines)
    assert value(x) == FILE.replace("object: Coast Letter", "document: Coast Letter")
    new = R.renamed(lines, R.renames(lines))
    want = FILE.replace("person: Captain Ada Brenner", "person: Brenner, Ada").replace("place: Roswell New Mexico", "place: USA, New Mexico, Roswell").replace("speaker:Captain Ada Brenner", "speaker:Brenner, Ada")
    want = want.replace("refs: Roswell New Mexico, Captain Ada Brenner, Grey", "refs: USA, New Mexico, Roswell, Brenner, Ada, Grey").replace("refs: Captain Ada Brenner; Nobody", "refs: Brenner, Ada; Nobody")
    assert value(new) == want and value(new, "b.") == "refs: Captain Ada Brenner"
    # the lists with commas are told apart by the known names
    names = R.nodes_of(new).select("name")
    assert value(R.with_semicolons(new, names)) == want.replace("refs: USA, New Mexico, Roswell, Brenner, Ada, Grey Disc", "refs: USA, New Mexico, Roswell; Brenner, Ada; Grey Disc")


def test_references_follow_renamed_nodes(lines):
    half = R.renamed(lines, R.renames(lines).where("false"))
    assert value(half) == FILE
    nodes_only = lines.withColumn("line", lines.line)
    text = FILE.replace("person: Captain Ada Brenner", "person: Brenner, Ada").replace("Captain Ada Brenner", "Ada Brenner")
    x = lines.sparkSession.createDataFrame([("f", i, t) for i, t in enumerate(text.split("\n"))], "path string, at int, line string")
    got = next(r.value for r in R.texts(R.renamed(x, R.former_names(x), nodes=False)).collect())
    assert got == text.replace("speaker:Ada Brenner", "speaker:Brenner, Ada").replace("refs: Roswell New Mexico, Ada Brenner", "refs: Roswell New Mexico, Brenner, Ada").replace("refs: Ada Brenner;", "refs: Brenner, Ada;").replace("text: refs: Brenner, Ada", "text: refs: Ada Brenner")
    assert nodes_only.count() == lines.count()


def test_backfilled_records(spark):
    rows = [("a", {"zeta": "1", "title": "T", "publisher": " ", "id": "x"}, {"publisher": "P", "source_type": "video", "duration": ""}), ("b", {"publisher": "Q"}, {"publisher": "P"}), ("c", {"id": "x"}, None), ("d", None, {"publisher": "P"})]
    out = {r.key: r for r in R.backfilled(spark.createDataFrame(rows, "key string, record map<string,string>, front map<string,string>")).selectExpr("*", "map_keys(record) AS keys", "map_values(record) AS values").collect()}
    assert list(zip(out["a"]["keys"], out["a"]["values"], strict=True)) == [("id", "x"), ("title", "T"), ("publisher", "P"), ("medium", "video"), ("zeta", "1")] and out["a"].added == ["publisher", "medium"]
    assert out["b"].record == {"publisher": "Q"} and out["b"].added == [] and out["c"].record == {"id": "x"}


def test_live_records(spark, rows):
    store = spark.createDataFrame([("h1", "p1"), ("h2", "p2")], "content_hash string, path string")
    names = spark.createDataFrame([("a", "h1"), ("b", "h9"), ("c", None)], "name string, content_hash string")
    live, gap = R.live_records(store, names)
    assert rows(live) == [("h1", "p1")] and rows(gap) == [("h2", "p2")]
    live, gap = R.live_records(store, None)
    assert live.count() == 2 and gap.count() == 0

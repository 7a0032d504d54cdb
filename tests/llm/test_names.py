import pytest

from evigraph.llm import names as N

SCHEMA = "id string, node_type string, name string, metadata string, created_at string, retired_at string, seq bigint"

SAME = [
    ["Rebecca Veproummesk", 'Rebecca "Becky" Veproumesk', "Rebecca A. Veproummesk", "VEPROUMMESK, REBECCA A.", "R. Veproummesk", "Dr. Rebecca  Veproummésk", "Becky Veproummesk", "Renecca A. Veproummesk"],
    ["Susan Mubramcuth", "Ssan Mubramcuth", "susan mubramcuth", "Mubramcuth Susan"],
    ["Gregory van Tramgever", "Greg van Tramgever", "van Tramgever, Gregory"],
    ["Kamjeszos International Laboratory of Remote Sensing", "International Laboratory of Remote Sensing, Kamjeszos", "Kamjeszos ILRS Ltd", "Kamjeszos Int'l Lab of Remote Sensing", "The Kamjeszos International Laboratory of Remote Sensing (KILRS)"],
    ["Dethmoskwou Observation Wing 13", "Dethmoskwou Obs. Wing 13", "Obs. Wing 13, Dethmoskwou", "DETHMOAKWOU OBSERVATION WING 13"],
    ["Dethmoskwou Observation Wing 12"],
    ["Kamjeszos International Laboratory of Signal Analysis"],
    ["Karim Mubramcuth"],
    ["Susanna Vordemkeas", "Vordemkeas, Susanna"],
]


def frame(spark, rows):
    return spark.createDataFrame([(i, k, n, None, "", r, s) for s, (i, k, n, r) in enumerate(rows)], SCHEMA)


def nodes(groups, kind=lambda n: "organisation" if any(w in n.lower() for w in ("lab", "wing", "ilrs")) else "person"):
    return [(f"g{g}-{i}", kind(n), n, None) for g, names in enumerate(groups) for i, n in enumerate(names)]


def pairs(spark, rows):
    return {(r.node_a, r.node_b) for r in N.same_entity_pairs(N.name_groups(frame(spark, rows))).collect()}


def test_variants_are_linked_and_relatives_are_not(spark):
    rows = nodes(SAME)
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[0].split("-")[0] == b[0].split("-")[0]}
    assert pairs(spark, rows) == want


def test_rows_that_take_no_part(spark):
    rows = [("a", "Person", "Ann Lindqvist", None), ("a", "Person", "Ann Lindqvist", None), (" B", "person", "ann lindqvist", None), ("c", "person", "Ann Lindqvist", "2024"), ("d", "place", "Ann Lindqvist", None), ("e", "person", None, None), ("f", "person", "  ", None), (None, "person", "Ann Lindqvist", None), ("g", "organization", "Ann Lindqvist", None), ("h", None, "Ann Lindqvist", None), ("i", "person", "...", None)]
    assert pairs(spark, rows) == {("a", "b")}
    assert pairs(spark, []) == set()


def test_an_unclear_initial_stays_alone(spark):
    rows = [("a", "person", "Susan Karlmand", None), ("b", "person", "Stephen Karlmand", None), ("c", "person", "S. Karlmand", None), ("d", "person", "Vera Holtrun", None), ("e", "person", "V. Holtrun", None)]
    assert pairs(spark, rows) == {("d", "e")}


def test_one_name_for_many_nodes(spark):
    rows = [(f"n{i:03}", "person", "Vera Holtrun" if i % 2 else "HOLTRUN, Vera", None) for i in range(60)]
    assert len(pairs(spark, rows)) == 60 * 59 // 2


@pytest.mark.parametrize(("a", "b", "n"), [("abc", "abc", 0), ("abcd", "acbd", 1), ("abcd", "abd", 1), ("kitten", "sitting", 3), ("abc", "xyz", 3)])
def test_edits(a, b, n):
    assert N.edits(a, b, 3) == N.edits(b, a, 3) == n


@pytest.mark.parametrize(
    ("name", "given", "middle", "surname"),
    [("Nendgispath, Prof. Gerald H.", "gerald", "h", "nendgispath"), ('Jonathan "Jon" Vampourjes', "jonathan", "", "vampourjes"), ("Nothgromtus M.", "m", "", "nothgromtus"), ("van Sesdospris Deborah", "deborah", "", "sesdospris"), ("Mr. U Kesbimjath", "u", "", "kesbimjath"), ("Prerrormeask Andrew J.", "andrew", "j", "prerrormeask"), ("Abigail (Abby) van Morgruses", "abigail", "", "morgruses"), ("Madonna", "", "", "madonna")],
)
def test_people(name, given, middle, surname):
    p = N.parse_person(name, frozenset({"deborah", "andrew"}))
    assert (p["given"], p["middle"], N.ocr(p["surname"])) == (given, middle, N.ocr(surname))


def links(spark, counts):
    rows = [(f"{n}-{i}", "organisation" if "Wing" in n else "person", n, None) for n, c in counts.items() for i in range(c)]
    classes, _, established = N.spellings(frame(spark, rows))
    return {(r.key, r.to) for r in N.attributions(classes, established).collect()}


@pytest.mark.parametrize("times", [1, 50])
def test_links_do_not_depend_on_table_size(spark, times):
    counts = {"Rebecca Veproummesk": 6, "Rebecca Veproumesk": 1, "Vera Holtrunsta": 1, "Vera Holtrumstq": 1, "Dethmoskwou Observation Wing 13": 4, "Dethmoakwou Observation Wing 13": 1}
    got = {frozenset(x) for x in links(spark, {n: c * times for n, c in counts.items()})}
    assert got == {frozenset(x) for x in [("rebecca||veproummesk|", "rebecca||veproumesk|"), ("vera||holtrunsta|", "vera||holtrumstq|"), ("dethmoskwou observation wing 13", "dethmoakwou observation wing 13")]}


def test_a_misspelling_stays_one_however_often_it_occurs(spark):
    surnames = [f"{a}{b}mond" for a in ("Kar", "Deth", "Nimp", "Wolg", "Tuss", "Pezz", "Mubr", "Hyld") for b in ("lan", "tru", "vesk", "dopi")]
    counts = {f"{g} {s}": 1 for g in ("Katherine", "Xavier", "Karim", "Karin") for s in surnames}
    got = links(spark, counts | {f"{g} {s}": 1 for g in ("Katherlne", "Xavyer") for s in surnames[:4]})
    pair = lambda a, b, s: frozenset((f"{a}||{s.lower()}|", f"{b}||{s.lower()}|"))
    assert {frozenset(x) for x in got} == {pair(a, b, s) for a, b in (("katherine", "katherlne"), ("xavier", "xavyer")) for s in surnames[:4]}
    assert N.own_words({"observation": 90, "obseruation": 9, "station": 40, "nation": 6, "stations": 30}, "organisation") == {"observation", "station", "nation", "stations"}


def test_two_edits_in_one_word_are_found(spark):
    counts = {"Harold Deandfotra": 2, "Harold Deandphotra": 2, "Vera Holtrunsta": 3, "Vera Hxltrunsba": 1, "Christopher Lindqvist": 3, "Xyristopher Lindqvist": 1, "Dethmoskwou Observation Wing 13": 3, "Dexhmoskwuu Observation Wing 13": 1}
    want = [("harold||deandfotra|", "harold||deandphotra|"), ("vera||holtrunsta|", "vera||hxltrunsba|"), ("christopher||lindqvist|", "xyristopher||lindqvist|"), ("dethmoskwou observation wing 13", "dexhmoskwuu observation wing 13")]
    assert {frozenset(x) for x in links(spark, counts)} == {frozenset(x) for x in want}

import json

import pytest

from evigraph.sources import files, sinks, yamlish

DIGEST = """\
frontmatter:
  record_id: r1
  record_title: "Report: one"  # a note
  content_hash: 'sha256:ab'
nodes:
  - id: n1
    name: Ann Lee
    node_type: person
    metadata: 
      aliases: [A. Lee, "Lee, Ann"]
  - id: n2
    name: Kent
    type: place
domain_claims:
- id: c1
  content: >-
    A folded
    text.
  claim_type: observation
  confidence: 0.9
  node_references:
    - Ann Lee
    - Kent
  provenance_chain:
    origin_kind: named
    origin: DIA
    relay: []
infrastructure_claims: []
terminology:
  codenames: []
"""


def test_yaml_reads_and_writes():
    d = yamlish.load(DIGEST)
    assert d["frontmatter"]["record_title"] == "Report: one" and d["nodes"][0]["metadata"]["aliases"] == ["A. Lee", "Lee, Ann"] and d["domain_claims"][0]["content"] == "A folded text."
    v = {"a": [1, 2.5, None, True, "x: y", "", " z", "1", "line\nbreak", "é"], "b": {"c": {}, "d": [], "e": [{"f": 1, "g": ["h"]}, {"i": None}]}, "true": "no"}
    assert yamlish.load(yamlish.dump(v)) == v
    assert [x["op"] for x in yamlish.load_all("op: a\n---\nop: b\n---\n")] == ["a", "b"] and yamlish.load("") is None
    assert yamlish.load("t: |\n  one\n   two\n\nk: 1") == {"t": "one\n two\n", "k": 1}
    with pytest.raises(yamlish.YamlError):
        yamlish.load("a: &x 1")


def test_digests(spark, tmp_path):
    for p, t in {"a/one.yaml": DIGEST, "a/variants/two.yaml": DIGEST, "a/.hidden/x.yaml": DIGEST, "a/trial.yaml": "run_kind: trial\n" + DIGEST, "a/bad.yaml": "a: &x 1", "a/other.md": "x"}.items():
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text(t)
    out = {r.path.rsplit("/", 1)[1]: r for r in files.digests(spark, str(tmp_path)).collect()}
    assert set(out) == {"one.yaml", "bad.yaml"} and out["bad.yaml"].error and out["one.yaml"].header["record_id"] == "r1"
    c = out["one.yaml"].domain_claims[0]
    assert c.node_references == ["Ann Lee", "Kent"] and c.origin == "DIA" and c.relay == [] and out["one.yaml"].nodes[1].node_type == "place"
    heads = {r.path.rsplit("/", 1)[1]: r.header for r in files.digest_headers(spark, str(tmp_path)).collect()}
    assert heads["one.yaml"]["content_hash"] == "sha256:ab"


def test_records_and_sidecars(spark, tmp_path):
    h = ["a" * 64, "b" * 64]
    (tmp_path / f"{h[0]}.md").write_text("---\ntitle: Old\n---\nold")
    (tmp_path / f"{h[0]}.v2.md").write_text("---\ntitle: New\n---\nnew {{note}} text")
    (tmp_path / f"{h[1]}.md").write_text("---\nsuperseded_by: x\n---\ngone")
    (tmp_path / "readme.md").write_text("x")
    (tmp_path / f"{h[0]}.review.json").write_text(json.dumps({"ok": True}))
    r = files.front_matter(files.store_records(spark, str(tmp_path)).withColumnRenamed("front", "f").selectExpr("*", "concat('---\\n', f, '\\n---') AS value")).collect()
    assert [(x.content_hash, x.body, x.fields["title"]) for x in r] == [(h[0], "new   text", "New")]
    assert files.sidecars(spark, str(tmp_path), "review").select("ok").first()[0] is True


def test_memo_and_ledger(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"a": "x", "b": "y", "s": 1}\nbroken\n{"a": "x", "b": "y", "s": 2}\n')
    assert [tuple(r) for r in files.memo(spark, str(tmp_path / "m.jsonl"), "a string, b string, s double", ["a", "b"]).collect()] == [("x", "y", 2.0)]
    (tmp_path / "l.yaml").write_text("op: merge\nby: null\n---\nop: undo\nnames: ['O''Neil', \"a: b\"]\n")
    assert [json.loads(r.event) for r in files.ledger(spark, str(tmp_path / "l.yaml")).orderBy("seq").collect()] == [{"op": "merge", "by": None}, {"op": "undo", "names": ["O'Neil", "a: b"]}]


def test_briefs_and_bindings(spark, tmp_path):
    b = spark.createDataFrame([("people", "ann", "Ann\nLee", [("c1", "r1"), ("c2", None)])], "section string, slug string, name string, claims array<struct<claim_id:string,record_id:string>>")
    t = sinks.brief_texts(b, "section", "slug")
    sinks.write_texts(t, str(tmp_path / "briefs"), ["section", "slug"])
    text = next((tmp_path / "briefs").rglob("*.txt")).read_text()
    assert yamlish.load(text)["claims"][0] == {"claim_id": "c1", "record_id": "r1"} and "\nLee" not in text
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "b.yaml").write_text(text)
    assert [(r.claim_id, r.record_id) for r in files.claim_bindings(spark, str(tmp_path / "x")).where("record_id <> 'null'").collect()] == [("c1", "r1")]
    assert "claims:" not in files.brief_headers(spark, str(tmp_path / "x")).first()["head"]


def test_cache_queue_manifest(spark, tmp_path):
    calls = []

    def embed(texts):
        calls.extend(texts)
        return [[float(len(t))] for t in texts]

    texts = spark.createDataFrame([("aa",), ("aa",), ("b",), (None,)], "text string")
    first = sinks.fill_cache(texts, None, "m", embed)
    assert sorted(r.embedding[0] for r in first.collect()) == [1.0, 2.0]
    assert sinks.fill_cache(texts, first, "m", embed).count() == 0 and sinks.fill_cache(texts, first, "n", embed).count() == 2
    sinks.write_queue(texts, str(tmp_path / "q"))
    assert spark.read.json(str(tmp_path / "q")).count() == 4
    m = sinks.manifest({"t": texts}, "2025-01-01T00:00:00Z")
    assert m.first()["n"] == 4 and sinks.fresh(m, "at", "2025-01-01T05:00:00Z").count() == 1 and sinks.fresh(m, "at", "2025-01-01T07:00:00Z").count() == 0
    notes = sinks.vault_notes(spark.createDataFrame([("person", "a/b: c", "- x")], "node_type string, name string, body string"))
    assert tuple(notes.first()) == ("person", "a-b- c.md", "# a/b: c\n\n- x")


def test_ledgers_are_appended_once(spark, tmp_path, rows):
    from evigraph.sources import files, sinks

    path, schema = str(tmp_path / "ledger"), "id string, at string, note string"
    put = lambda data: sinks.append_events(spark.createDataFrame(data, schema), path)
    assert put([("b", "2", "x: y\nz"), ("a", "1", None), ("a", "1", None), (None, "3", "lost")]).collect() == []
    assert rows(put([("a", "1", None), ("b", "2", "other"), ("c", "3", "yes"), ("d", "4", "p"), ("d", "4", "q")])) == [("b", "2", "other"), ("d", "4", "p"), ("d", "4", "q")]
    import json

    events = [json.loads(r.event) for r in files.ledger(spark, path).collect()]
    assert sorted((e["id"], e["note"]) for e in events) == [("a", None), ("b", "x: y\nz"), ("c", "yes")]


def test_old_manifests_are_refused(spark):
    import pytest

    from evigraph.sources import sinks

    m = spark.createDataFrame([("2025-01-01T00:00:00Z",)], "at string")
    assert sinks.require_fresh(m, "2025-01-01T05:59:00Z").count() == 1
    with pytest.raises(sinks.Stale):
        sinks.require_fresh(m, "2025-01-01T06:01:00Z")

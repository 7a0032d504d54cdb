import hashlib
import json

from evigraph.operators import dispositions as D

NODE = {"name": "Zoé / \"x\"", "node_type": "person", "prior_names": ["b", "a", "b"]}
AT = "2025-01-01T00:00:00Z"
SCHEMA = "name string, keys array<string>, schema string, op string, event_id string, at string, by string, new_name string, node struct<name:string,node_type:string,prior_names:array<string>>, proposal_id string, reason string, reverses array<string>"


def content_id(prefix, payload):
    return prefix + hashlib.sha256(json.dumps(payload, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def rename(name="ok", proposal=None, at=AT, by="me", new="New", keys=D.KEYS["rename"], wrong=False):
    payload = {"schema": "s/2", "op": "rename", "at": at, "by": by, "new_name": new, "node": {**NODE, "prior_names": ["a", "b"]}, "proposal_id": proposal}
    ident = content_id(D.OPERATION_PREFIX, payload)
    return (name, list(keys), "s/2", "rename", "x" if wrong else ident, at, by, new, (NODE["name"], "person", NODE["prior_names"]), proposal, None, None)


def compensate(name, reverses, reason="why"):
    payload = {"schema": "s/2", "op": "compensate", "at": AT, "by": "me", "reason": reason, "reverses": reverses}
    return (name, list(D.KEYS["compensate"]), "s/2", "compensate", content_id(D.COMPENSATION_PREFIX, payload), AT, "me", None, None, None, reason, reverses)


def test_events_say_what_their_id_says(spark):
    op = lambda c: D.OPERATION_PREFIX + c * 64
    reject = {"schema": "s/2", "op": "reject_proposal", "proposal_id": "rename-proposal:7", "at": AT, "by": "me", "reason": "no"}
    rows = [
        rename(), rename("linked", "rename-proposal:1"), rename("edited", wrong=True), rename("order", keys=sorted(D.KEYS["rename"])), rename("time", at="2025-01-01 00:00"), rename("who", by=" "), rename("proposal", "7"), compensate("comp", [op("a"), op("b")]),
        compensate("unsorted", [op("b"), op("a")]), compensate("none", []), ("other", ["op"], "s/2", "delete", None, AT, "me", None, None, None, None, None), ("null", None, None, None, None, None, None, None, None, None, None, None),
        ("reject", list(D.KEYS["reject_proposal"]), "s/2", "reject_proposal", content_id(D.OPERATION_PREFIX, reject), AT, "me", None, None, "rename-proposal:7", "no", None),
    ]
    got = {r.name: r.error for r in D.checked_events(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {
        "ok": None, "linked": None, "edited": "id doesn't match", "order": "closed shape", "time": "time without offset", "who": "invalid field", "proposal": "invalid field", "comp": None, "unsorted": "invalid field", "none": "invalid field",
        "other": "unknown op", "null": "unknown op", "reject": None,
    }


def test_unknown_proposals_and_empty_ledgers(spark, rows):
    p = spark.createDataFrame([("rename-proposal:1", AT)], "id string, at string")
    r = spark.createDataFrame([("merge", "o1", "rename-proposal:9", True), ("merge", "o1", "rename-proposal:9", True)], "kind string, operation_id string, proposal_id string, active boolean")
    assert rows(D.proposal_routes(p, r)[1]) == [("merge", "o1", "rename-proposal:9")] and rows(D.proposal_routes(p, r.limit(0))[0]) == [("rename-proposal:1", 0, "pending")]
    e = spark.createDataFrame([], "seq int, id string, reversal boolean, at string")
    assert [x.collect() for x in D.operations(e)] == [[], []]


def test_a_clean_replay_has_no_problems(spark):
    entries = spark.createDataFrame([("d1", "merge", "m1", "s", "c", "absorbed", AT, None)], "id string, phase string, operation_id string, source string, candidate string, outcome string, classified_at string, supersedes string")
    tips, problems = D.chains(entries)
    o = spark.createDataFrame([("merge", "m1", "lost"), ("merge", "m2", "applied_normally")], "phase string, operation_id string, outcome string")
    assert problems.collect() == [] and D.replay_problems(tips, o).collect() == [] and [r.problem for r in D.replay_problems(tips, o.limit(0)).collect()] == ["no such operation"]

import base64

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evigraph.llm import bpe

FILE = f"{bpe.TOKENIZERS}/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def ranks():
    with open(FILE, "rb") as f:
        return bpe.read_ranks(f.read())


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(f"{bpe.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


def plain_merge(piece, ranks):
    parts = [bytes([b]) for b in piece]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: (ranks.get(parts[i] + parts[i + 1], 1 << 60), i))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[p] for p in parts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=24) | st.text(max_size=12).map(lambda s: s.encode("utf-8", "surrogatepass")), max_size=8))
def test_many_pieces_equal_each_piece_alone(pieces):
    ranks = test_many_pieces_equal_each_piece_alone.ranks
    ids, sizes = bpe.PairIndexEncoder(ranks).encode(pieces)
    at = 0
    for p, n in zip(pieces, sizes, strict=True):
        assert ids[at : at + n].tolist() == plain_merge(p, ranks)
        at += n
    assert at == len(ids)


with open(FILE, "rb") as _f:
    test_many_pieces_equal_each_piece_alone.ranks = bpe.read_ranks(_f.read())


TEXTS = ["", None, " ", "aaaaaaaaaaaaa", "Hello  world\n\n\tdon't stop", "<|endoftext|> is text", "ガガーリン 안녕 مرحبا", "é​\x00\x1f", "x" * 20_000, "12,345.67 €", "🙂🙃" * 50, "repeat", "repeat"]


def test_corpus_against_the_library(spark, reference):
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, ids bigint")
    got = {r.doc_id: list(r.ids) for r in bpe.encode_corpus(df).collect()}
    assert got == {i: reference(t) if t else [] for i, t in enumerate(TEXTS)}


def test_round_trip(spark, ranks):
    token = {v: k for k, v in ranks.items()}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string").repartition(3)
    for r in bpe.encode_corpus(df).collect():
        assert b"".join(token[i] for i in r.ids).decode() == (TEXTS[r.doc_id] or "")


def test_empty_table(spark):
    assert bpe.encode_corpus(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_forgetting_pieces_changes_nothing(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"word{i % 7} and more {i}") for i in range(60)], "doc_id bigint, text string").coalesce(1)
    want = bpe.encode_corpus(df).collect()
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    batches = list(bpe.encode_batches(iter(df.selectExpr("doc_id AS _key", "text AS _text").toArrow().to_batches(max_chunksize=5)), bpe.read_ranks(open(FILE, "rb").read()), "_key", "_text"))
    got = [(k, v) for b in batches for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    assert sorted(got) == sorted((r.doc_id, list(r.ids)) for r in want)


def test_ranks_file(ranks):
    assert ranks[base64.b64decode("YQ==")] == ranks[b"a"] and len(ranks) == 50_256

"""Encoding of a corpus with a public byte-level BPE vocabulary, by a pair occurrence index."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Where the vocabulary files are; a file's name is appended.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the published pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces whose ids a worker remembers; beyond that it starts over, which changes no result.
REMEMBERED = 400_000
_SHIFT = 20


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes to id from a file of lines 'base64 rank'."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line.strip())}


class PairIndexEncoder:
    """Encodes many pieces at once.

    All pieces lie side by side in one array with links to the next and the previous live
    position. The index maps each mergeable pair, named by the id it merges to, to all its
    positions. Active ranks are taken in ascending order from a heap; at each of a rank's
    positions, in ascending order, the pair is merged if it still stands there, and the two
    pairs beside it enter the lists of their own ranks. Pieces never touch, so this equals
    merging each piece alone by its lowest rank.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.token = [b""] * (max(ranks.values()) + 1)
        for k, v in ranks.items():
            self.token[v] = k
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.pairs: dict[int, int] = {}

    def rank(self, a: int, b: int) -> int:
        """The id that a pair merges to, -1 if to none."""
        key = a << _SHIFT | b
        r = self.pairs.get(key)
        if r is None:
            r = self.pairs[key] = self.ranks.get(self.token[a] + self.token[b], -1)
        return r

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces side by side, number of ids of each piece)."""
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        flat = self.byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        n = len(flat)
        if not n:
            return np.zeros(0, np.int32), sizes
        ends = np.cumsum(sizes)
        last = np.zeros(n, dtype=bool)
        last[ends[sizes > 0] - 1] = True
        # the index of the first pairs, built by sorting
        at = np.flatnonzero(~last[:-1]) if n > 1 else np.zeros(0, np.int64)
        keys = flat[at].astype(np.int64) << _SHIFT | flat[at + 1]
        distinct, inverse = np.unique(keys, return_inverse=True)
        of = np.array([self.rank(int(k) >> _SHIFT, int(k) & ((1 << _SHIFT) - 1)) for k in distinct], dtype=np.int64)
        r = of[inverse] if len(distinct) else np.zeros(0, np.int64)
        at, r = at[r >= 0], r[r >= 0]
        order = np.argsort(r, kind="stable")
        at, r = at[order], r[order]
        active, first = np.unique(r, return_index=True)
        index: dict[int, list[int]] = {int(k): x.tolist() for k, x in zip(active, np.split(at, first[1:]), strict=True)} if len(active) else {}
        heap = [int(k) for k in active]  # sorted, so a heap
        sym = flat.tolist()
        nxt = np.arange(1, n + 1)
        nxt[last] = -1
        prv = np.arange(-1, n - 1)
        prv[1:][last[:-1]] = -1
        nxt, prv, rank, pairs = nxt.tolist(), prv.tolist(), self.rank, self.pairs
        while heap:
            new = heappop(heap)
            positions = index.pop(new)
            positions.sort()
            for p in positions:
                a = sym[p]
                q = nxt[p]
                if a < 0 or q < 0 or pairs.get(a << _SHIFT | sym[q], -1) != new:
                    continue
                sym[p], sym[q] = new, -1
                after, before = nxt[q], prv[p]
                nxt[p] = after
                if after >= 0:
                    prv[after] = p
                    k = rank(new, sym[after])
                    if k >= 0:
                        if k in index:
                            index[k].append(p)
                        else:
                            index[k] = [p]
                            heappush(heap, k)
                if before >= 0:
                    k = rank(sym[before], new)
                    if k >= 0:
                        if k in index:
                            index[k].append(before)
                        else:
                            index[k] = [before]
                            heappush(heap, k)
        out = np.array(sym, dtype=np.int32)
        live = out >= 0
        counts = np.add.reduceat(live, np.concatenate(([0], ends[:-1]))[sizes > 0]) if n else []
        lengths = np.zeros(len(pieces), dtype=np.int64)
        lengths[sizes > 0] = counts
        return out[live], lengths


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, ... of each range, side by side."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total, dtype=np.int64) + shift


def encode_batches(batches: Iterator[pa.RecordBatch], ranks: dict[bytes, int], key: str, text: str) -> Iterator[pa.RecordBatch]:
    """(key, ids) of each row of Arrow batches."""
    import regex

    split, encoder = regex.compile(PATTERN).findall, PairIndexEncoder(ranks)
    known: dict[str, int] = {}
    store, starts, lengths = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        if len(known) > REMEMBERED:
            known, store, starts, lengths = {}, np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        fresh: list[str] = []
        rows: list[np.ndarray] = []
        for t in batch.column(text).to_pylist():
            numbers = []
            for piece in split(t) if t else ():
                n = known.get(piece)
                if n is None:
                    n = known[piece] = len(known)
                    fresh.append(piece)
                numbers.append(n)
            rows.append(np.array(numbers, dtype=np.int64))
        if fresh:
            ids, sizes = encoder.encode([p.encode("utf-8", "surrogatepass") for p in fresh])
            starts = np.concatenate((starts, len(store) + np.concatenate(([0], np.cumsum(sizes)[:-1]))))
            lengths, store = np.concatenate((lengths, sizes)), np.concatenate((store, ids))
        pieces = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        values = store[_ranges(starts[pieces], lengths[pieces])] if len(pieces) else np.zeros(0, np.int32)
        per_row = np.array([int(lengths[x].sum()) if len(x) else 0 for x in rows], dtype=np.int64)
        offsets = np.concatenate(([0], np.cumsum(per_row))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(key), lists], names=[key, "ids"])


def encode_corpus(documents: DataFrame, vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken", key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>): the ids of each row's text, without special tokens.

    Null and empty texts have the empty list. The strings of special tokens are ordinary
    text. The vocabulary file (under 1 MB) is read by the driver and sent to the workers.
    A partition's distinct pieces are encoded together, batch by batch; rows are neither
    shuffled nor cut, however long. Other columns are dropped. A null key stays null.
    """
    with open(vocabulary, "rb") as f:
        content = f.read()
    sent = documents.sparkSession.sparkContext.broadcast(content)

    def run(batches):
        return encode_batches(batches, read_ranks(sent.value), "_key", "_text")

    kind = documents.schema[key].dataType.simpleString()
    return documents.selectExpr(f"`{key}` AS _key", f"`{text}` AS _text").mapInArrow(run, f"_key {kind}, ids array<int>").withColumnRenamed("_key", key)

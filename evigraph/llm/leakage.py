"""Evaluation texts in training text, by a stored positional inverted index.

build_index() writes the postings of a corpus once: for every term of a segment (a run of
documents) its sorted positions, in a table partitioned by term shard. Item sets are then
answered from that table: their windows meet it at their rarest term, and only the segments
that hold it hand out postings, which are intersected by offset.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Words that must follow each other.
WORDS = 12
#: A window's words count as near if they all stand within so many words.
SPAN = 16
#: Words of documents in one segment of the index; shards of terms.
SEGMENT_WORDS, TERM_SHARDS = 1_000_000, 8
#: Words of items that one group of a segment's answers holds, about.
ITEM_WORDS = 1_000_000
#: Positions between two documents, more than any span, so that no window reaches over.
GAP = 1024

_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Maximal runs of letters and digits of any script, in lower case."""
    return [w.lower() for w in _WORD.findall(text)] if text else []


# ---- postings


def packed(positions: np.ndarray) -> bytes:
    """Sorted positions as their width in bytes, the first, and the differences in that width."""
    steps = np.diff(positions)
    top = int(steps.max()) if len(steps) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
    return bytes([width]) + int(positions[0]).to_bytes(8, "little") + steps.astype(f"<u{width}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    width, first = data[0], int.from_bytes(data[1:9], "little")
    steps = np.frombuffer(data, f"<u{width}", offset=9).astype(np.int64)
    return first + np.concatenate(([0], np.cumsum(steps)))


def segment_rows(segment: int, keys: list, texts: list[list[str]], kind: pa.DataType) -> pa.RecordBatch:
    """The rows of one segment: one of its documents with where each starts, one per term."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + GAP)[:-1]))
    flat = pa.array([w for t in texts for w in t], pa.string()).dictionary_encode()
    codes = flat.indices.to_numpy()
    at = np.repeat(starts, sizes) + np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.argsort(codes, kind="stable")
    counts = np.bincount(codes, minlength=len(flat.dictionary))
    ends = np.cumsum(counts)
    at = at[order]
    terms = flat.dictionary.to_pylist()
    rows = sorted(range(len(terms)), key=terms.__getitem__)
    lists = [packed(at[ends[i] - counts[i] : ends[i]]) for i in rows]
    n = len(rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([segment] * (n + 1), pa.int64()),
            pa.array([-1] + [zlib.crc32(terms[i].encode("utf-8", "surrogatepass")) % TERM_SHARDS for i in rows], pa.int32()),
            pa.array([None] + [terms[i] for i in rows], pa.string()),
            pa.array([int(sizes.sum())] + [int(counts[i]) for i in rows], pa.int64()),
            pa.array([starts.astype("<i8").tobytes(), *lists], pa.binary()),
            pa.array([keys] + [None] * n, pa.list_(kind)),
        ],
        names=["segment", "shard", "term", "n", "positions", "keys"],
    )


def build_index(documents: DataFrame, key: str = "doc_id", text: str = "text", segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The positional inverted index of a corpus, written to the shared folder and read back.

    (segment, term, n, positions, keys, shard): n and positions are a term's in a segment,
    positions packed; the row without term holds the segment's documents and their starts.
    Partitioned by term shard, sorted by term inside a file, so that a reader of few terms
    skips the rest. A task indexes the documents that it reads: neither text nor postings are
    shuffled, and a segment's size is bounded whatever its documents are (a longer document is
    a segment of its own). Texts that are null or hold no word aren't in it.
    """
    docs = documents.selectExpr(f"`{key}` AS _key", f"`{text}` AS _text").where("_text IS NOT NULL")
    kind = docs.schema["_key"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 24
        keys, texts, size, of = [], [], 0, pa.int64()
        for b in batches:
            of = b.column(0).type
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ws = words(t)
                if ws:
                    keys.append(k)
                    texts.append(ws)
                    size += len(ws)
                if size >= segment_words:
                    yield segment_rows(segment, keys, texts, of)
                    keys, texts, size, segment = [], [], 0, segment + 1
        if keys:
            yield segment_rows(segment, keys, texts, of)

    rows = docs.mapInArrow(index, f"segment bigint, shard int, term string, n bigint, positions binary, keys array<{kind}>")
    return materialise(rows, "postings", ("shard",))


# ---- intersecting lists


@dataclass
class Postings:
    """The postings of some terms in one segment."""

    of: dict[str, np.ndarray]
    starts: np.ndarray

    def documents(self, positions: np.ndarray) -> np.ndarray:
        return np.unique(np.searchsorted(self.starts, positions, side="right") - 1)


def _held(sorted_values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    i = np.searchsorted(sorted_values, wanted)
    i[i == len(sorted_values)] = 0
    return sorted_values[i] == wanted if len(sorted_values) else np.zeros(len(wanted), bool)


def phrase_starts(lists: list[np.ndarray]) -> np.ndarray:
    """Positions from which the lists' terms stand one after another: the lists, each moved
    back by its term's offset, are intersected from the shortest on."""
    order = sorted(range(len(lists)), key=lambda o: len(lists[o]))
    starts = lists[order[0]] - order[0]
    for o in order[1:]:
        if not len(starts):
            break
        starts = starts[_held(lists[o], starts + o)]
    return starts


def near_positions(lists: list[np.ndarray], span: int) -> np.ndarray:
    """Positions of the rarest term with all terms inside one stretch of span words, in any order."""
    lists = sorted(lists, key=len)
    at = lists[0]
    for p in lists[1:]:
        at = at[np.searchsorted(p, at + span) > np.searchsorted(p, at - span + 1)]
    good = np.zeros(len(at), bool)
    for shift in range(span):
        start = at - shift
        inside = np.ones(len(at), bool)
        for p in lists[1:]:
            inside &= np.searchsorted(p, start + span) > np.searchsorted(p, start)
        good |= inside
    return at[good]


def search(postings: Postings, items: list[tuple[int, list[str]]], n: int, span: int | None) -> set[tuple[int, int, bool]]:
    """(document, item, exact) of all windows of the items in one segment; without span only the exact ones."""
    found: set[tuple[int, int, bool]] = set()
    seen: dict[tuple[str, ...], list[tuple[int, bool]]] = {}
    for item, ws in items:
        for i in range(len(ws) - n + 1):
            w = tuple(ws[i : i + n])
            if w not in seen:
                lists = [postings.of.get(t) for t in w]
                hits: list[tuple[int, bool]] = []
                if all(x is not None for x in lists):
                    hits += [(d, True) for d in postings.documents(phrase_starts(lists)).tolist()]
                    if span:
                        different = [postings.of[t] for t in dict.fromkeys(w)]
                        hits += [(d, False) for d in postings.documents(near_positions(different, span)).tolist()]
                seen[w] = hits
            found.update((d, item, exact) for d, exact in seen[w])
    return found


# ---- the query


def item_words(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item_id, ws): the words of each item; items without id or text are left out."""
    @F.pandas_udf("array<string>")
    def split(t: pd.Series) -> pd.Series:
        return t.map(words)

    x = items.selectExpr(f"CAST(`{item}` AS BIGINT) AS item_id", f"`{text}` AS _text").where("item_id IS NOT NULL AND _text IS NOT NULL").distinct()
    return x.select("item_id", split("_text").alias("ws"))


def _answer(n: int, span: int | None, kind: pa.DataType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        keys, of, starts = [], {}, np.zeros(0, np.int64)
        for term, positions, of_docs in zip(held.column("term").to_pylist(), held.column("positions").to_pylist(), held.column("keys").to_pylist(), strict=True):
            if term is None:
                keys, starts = of_docs, np.frombuffer(positions, "<i8")
            else:
                of[term] = unpacked(positions)
        items = list(zip(asked.column("item_id").to_pylist(), asked.column("ws").to_pylist(), strict=True))
        hits = sorted(search(Postings(of, starts), items, n, span)) if keys else []
        return pa.table({"_key": pa.array([keys[d] for d, _, _ in hits], kind), "item_id": pa.array([i for _, i, _ in hits], pa.int64()), "exact": pa.array([e for *_, e in hits], pa.bool_())})

    return run


def leaked_in(index: DataFrame, items: DataFrame, n: int = WORDS, span: int | None = None, key: str = "doc_id", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """leaked_items() against an index that build_index() made; items are a table of any size.

    The rarest term of each window, by its count in the corpus, leads to the segments where the
    window may be; a window with a term that the corpus lacks leads nowhere. Such a segment
    hands out the postings of the item's terms, and only those are shuffled; they are
    intersected in the group of a segment and a block of items. No item comes to the driver.
    """
    its = materialise(item_words(items, item, item_text).where(F.size("ws") >= n), "items")
    total = its.agg(F.sum(F.size("ws"))).first()[0] or 0
    blocks = max(1, -(-int(total) // ITEM_WORDS))
    its = its.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int"))
    terms = index.where("term IS NOT NULL")
    wanted = its.select(F.explode(F.array_distinct("ws")).alias("term")).distinct()
    counts = terms.select("term", "n").join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    placed = its.select("item_id", "ws", F.posexplode("ws").alias("at", "term")).join(counts, "term", "left").groupBy("item_id", "ws").agg(F.array_sort(F.collect_list(F.struct("at", "term", "df"))).alias("p"))
    windows = placed.select("item_id", F.explode(F.transform(F.sequence(F.lit(1), F.size("p") - (n - 1)), lambda i: F.slice("p", i, F.lit(n)))).alias("w")).where(~F.exists("w", lambda x: x["df"].isNull()))
    rarest = windows.select("item_id", F.array_min(F.transform("w", lambda x: F.struct(x["df"].alias("df"), x["term"].alias("term"))))["term"].alias("term")).distinct()
    at = materialise(terms.select("term", "segment").join(rarest, "term").select("segment", "item_id").distinct(), "segments_of_items")
    asked = at.join(its, "item_id")
    needed = asked.select("segment", "block", F.explode("ws").alias("term")).distinct()
    lists = terms.select("segment", "term", "positions", "keys").join(needed, ["segment", "term"]).select("segment", "block", "term", "positions", "keys")
    docs = index.where("shard = -1").select("segment", "term", "positions", "keys").join(asked.select("segment", "block").distinct(), "segment").select("segment", "block", "term", "positions", "keys")
    kind = index.schema["keys"].dataType.elementType
    arrow = pa.int64() if kind.simpleString() == "bigint" else pa.int32() if kind.simpleString() == "int" else pa.string()
    groups = asked.select("segment", "block", "item_id", "ws").groupBy("segment", "block").cogroup(lists.unionByName(docs).toDF("_s", "_b", "term", "positions", "keys").groupBy("_s", "_b"))
    found = groups.applyInArrow(_answer(n, span, arrow), f"_key {kind.simpleString()}, item_id bigint, exact boolean")
    return found.distinct().withColumnRenamed("_key", key)


def leaked_items(documents: DataFrame, items: DataFrame, n: int = WORDS, span: int | None = None, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_id, exact), distinct: documents with n consecutive words of an item.

    With span, also documents that hold all words of such a window within span words, as
    exact = false. Words are runs of letters and digits in lower case; what stands between
    them doesn't matter. Items of fewer words, null and empty texts give no rows. Keys are
    integers or strings. The index is built for this call; build_index() and leaked_in() do
    the same in two steps, for several item sets.
    """
    return leaked_in(build_index(documents, key, text), items, n, span, key, item, item_text)

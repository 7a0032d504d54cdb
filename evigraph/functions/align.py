"""How alike names are: all pairs of a batch at once, over arrays of word numbers.

A batch of names becomes one vocabulary of words and a matrix of word numbers per name part.
What two words have to do with each other (equal, near, initial, dated) is worked out once for
each different pair of words; the verdict on a pair of parts is then a reduction over the
matrix of its words.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np

#: Cells of a word matrix that are worked on at a time.
CELLS = 2_000_000


def common_letters(pairs: Sequence[tuple[str, str]]) -> np.ndarray:
    """The length of the longest common subsequence of each pair of strings."""
    out = np.zeros(len(pairs), np.int64)
    short = [i for i, (a, b) in enumerate(pairs) if a and b and min(len(a), len(b)) <= 63]
    done = set(short)
    for i, (a, b) in enumerate(pairs):
        if a and b and i not in done:
            out[i] = _one_lcs(a, b)
    short.sort(key=lambda i: max(len(pairs[i][0]), len(pairs[i][1])))
    for at in range(0, len(short), 8192):
        rows = short[at : at + 8192]
        ab = [sorted(pairs[i], key=len) for i in rows]
        a, b = _codes([x for x, _ in ab], 1), _codes([y for _, y in ab], 2)
        bit = np.left_shift(np.uint64(1), np.arange(a.shape[1], dtype=np.uint64))
        n = np.array([len(x) for x, _ in ab], np.uint64)
        full = np.left_shift(np.uint64(1), n) - np.uint64(1)
        row = full.copy()
        for j in range(b.shape[1]):
            hit = row & ((a == b[:, j : j + 1]) * bit).sum(axis=1, dtype=np.uint64)
            row = ((row + hit) | (row - hit)) & full
        out[rows] = n.astype(np.int64) - np.bitwise_count(row).astype(np.int64)
    return out


def _codes(strings: list[str], pad: int) -> np.ndarray:
    """Code points; the two sides pad with different numbers, which are no letters."""
    width = max(map(len, strings))
    out = np.full((len(strings), width), np.uint32(0xFFFFFFFF - pad), np.uint32)
    for i, s in enumerate(strings):
        out[i, : len(s)] = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)
    return out


def _one_lcs(a: str, b: str) -> int:
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for c in b:
        hit = row & at.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def ratios(pairs: Sequence[tuple[str, str]]) -> np.ndarray:
    """2 x LCS / (len a + len b) of each pair; two empty strings are equal."""
    n = np.array([len(a) + len(b) for a, b in pairs], np.float64)
    return np.where(n > 0, 2 * common_letters(pairs) / np.maximum(n, 1), 1.0)


class Words:
    """The vocabulary of a batch: each word's number and what the rules ask of it."""

    def __init__(self, stop: frozenset[str], near: float) -> None:
        self.stop, self.near = stop, near
        self.number: dict[str, int] = {}
        self.known: dict[tuple[int, int], float] = {}

    def of(self, words: Sequence[str]) -> list[int]:
        return [self.number.setdefault(w, len(self.number)) for w in words]

    def close(self) -> None:
        """Called when all words are in."""
        self.text = list(self.number)
        bare = [w.rstrip(".") for w in self.text]
        self.letter = np.array([ord(b[0]) if b else -1 for b in bare], np.int64)
        self.single = np.array([len(b) == 1 for b in bare], bool)
        self.size = np.array([len(w) for w in self.text], np.int64)
        self.hard = np.array([any(c.isdigit() for c in w) for w in self.text], bool)
        self.telling = ~self.hard & np.array([w not in self.stop for w in self.text], bool)
        iso = [bool(re.fullmatch(r"\d{4}(-\d{2}){1,2}", w)) for w in self.text]
        self.dates = np.array(iso, bool)

    def ratio(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ratios of words by number; each different pair is computed once."""
        n = len(self.text)
        key = np.minimum(a, b) * n + np.maximum(a, b)
        different, back = np.unique(key, return_inverse=True)
        pairs = [(self.text[k // n], self.text[k % n]) for k in different.tolist()]
        return ratios(pairs)[back] if len(pairs) else np.zeros(0)


class Relations:
    """Links between the words of two padded matrices of word numbers (-1 is no word)."""

    def __init__(self, words: Words, a: np.ndarray, b: np.ndarray) -> None:
        self.words, self.a, self.b = words, a, b
        self.x, self.y = np.broadcast_arrays(a[:, :, None], b[:, None, :])
        self.both = (self.x >= 0) & (self.y >= 0)
        self.equal = self.both & (self.x == self.y)

    def initials(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        w = self.words
        return (w.letter[x] == w.letter[y]) & (w.single[x] | w.single[y]) & (w.letter[x] >= 0)

    def _same_place(self) -> np.ndarray:
        i = np.arange(self.a.shape[1])[None, :, None]
        j = np.arange(self.b.shape[1])[None, None, :]
        na, nb = (self.a >= 0).sum(1)[:, None, None], (self.b >= 0).sum(1)[:, None, None]
        return (i == j) | (na - i == nb - j)

    def linked(self) -> np.ndarray:
        """Equal, an initial in the same place from either end, or near in spelling."""
        w = self.words
        link = self.equal | (self.both & self._same_place() & self.initials(self.x, self.y))
        # a ratio is only asked for where it can decide
        open_a = w.telling[self.a] & (self.a >= 0) & ~link.any(2)
        open_b = w.telling[self.b] & (self.b >= 0) & ~link.any(1)
        la, lb = w.size[self.x], w.size[self.y]
        ask = self.both & (open_a[:, :, None] | open_b[:, None, :]) & (2 * np.minimum(la, lb) >= w.near * (la + lb) - 1e-12)
        at = np.nonzero(ask)
        link[at] |= w.ratio(self.x[at], self.y[at]) >= w.near
        return link

    def numbers_conflict(self) -> np.ndarray:
        """Both sides have words with digits, and one of these has no equal and no date that
        begins with it, or that it begins with, on the other side."""
        w = self.words
        ha, hb = (self.a >= 0) & w.hard[self.a], (self.b >= 0) & w.hard[self.b]
        same = self.equal.copy()
        ask = self.both & ~same & ha[:, :, None] & hb[:, None, :] & (w.dates[self.x] | w.dates[self.y])
        for i, j, k in zip(*np.nonzero(ask), strict=True):
            s, t = sorted((w.text[self.a[i, j]], w.text[self.b[i, k]]), key=len)
            same[i, j, k] = t.startswith(s + "-")
        lost = (ha & ~same.any(2)).any(1) | (hb & ~same.any(1)).any(1)
        return ha.any(1) & hb.any(1) & lost

    def disagree(self) -> np.ndarray:
        """Numbers conflict, or either side has a telling word that nothing links to the other."""
        link, t = self.linked(), self.words.telling
        alone_a = ((self.a >= 0) & t[self.a] & ~link.any(2)).any(1)
        alone_b = ((self.b >= 0) & t[self.b] & ~link.any(1)).any(1)
        return self.numbers_conflict() | (alone_a & alone_b)


def placed_ratio(words: Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The mean ratio of words in the same place, an initial counting as equal, a word without
    partner as nothing; two sides without words are equal."""
    w = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, w - m.shape[1])), constant_values=-1) for m in (a, b))
    both = (a >= 0) & (b >= 0)
    score = np.zeros(a.shape)
    score[both] = words.ratio(a[both], b[both])
    initial = both & (words.letter[a] == words.letter[b]) & (words.letter[a] >= 0) & (words.single[a] | words.single[b])
    score[initial] = 1.0
    n = np.maximum((a >= 0).sum(1), (b >= 0).sum(1))
    return np.where(n > 0, score.sum(1) / np.maximum(n, 1), 1.0)


def padded(rows: list[list[int]]) -> np.ndarray:
    out = np.full((len(rows), max([1, *map(len, rows)])), -1, np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def compare_parts(left: Sequence[str], right: Sequence[str], split: Callable[[str], list[str]], stop: frozenset[str], near: float) -> tuple[np.ndarray, np.ndarray]:
    """(similarity, numbers conflict) of each pair of name parts; similarity 0 where they disagree.

    split gives a part's words for the rules; its blank-separated words are aligned by place.
    """
    words = Words(stop, near)
    rules = {s: words.of(split(s)) for s in {*left, *right}}
    plain = {s: words.of(s.split()) for s in rules}
    if not words.number:
        words.of([""])
    words.close()
    similar, conflict = np.zeros(len(left)), np.zeros(len(left), bool)
    width = np.array([max(1, len(rules[a])) * max(1, len(rules[b])) for a, b in zip(left, right, strict=True)], np.int64)
    order, at = np.argsort(width, kind="stable"), 0
    while at < len(order):
        n = max(1, int(CELLS // width[order[at]]))
        rows = order[at : at + n]
        n = max(1, int(CELLS // width[rows[-1]]))  # the widest of these sets the size
        rows = rows[:n]
        at += len(rows)
        r = Relations(words, padded([rules[left[i]] for i in rows]), padded([rules[right[i]] for i in rows]))
        conflict[rows] = r.numbers_conflict()
        ok = rows[~r.disagree()]
        if len(ok):
            whole = ratios([(left[i], right[i]) for i in ok])
            place = placed_ratio(words, padded([plain[left[i]] for i in ok]), padded([plain[right[i]] for i in ok]))
            similar[ok] = np.maximum(whole, place)
    return similar, conflict

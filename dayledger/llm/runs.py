"""Periodic runs of words, found as maximal pairs in the tree of LCP intervals.

Two places in a text are a maximal pair if the same words follow both and neither the words before nor the
words behind these agree. Where the distance q of the two is short against the length l of what they share,
the words from the first place on, l + q of them, repeat with period q, and no neighbour extends them: a run.
Suffixes are sorted by doubling, the tree is walked from the leaves up, and every node holds the places
below it in one list per left word, so that pairs with equal left words are never formed.

Cases. Null counts as empty. Texts without a run come back as their words joined by one space. Runs may
overlap; each is reported once, with its smallest period. Equal rows are treated alike; other columns play
no part. A text is never split: one of n words takes some 8 bytes a word for each doubling of its longest
repeat, while it is worked on.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that are worked on at once (a longer text is a portion of its own).
PORTION = 1 << 17

Run = tuple[int, int, int]


def least_shared(min_length: int, repeats: int) -> int:
    """Fewest words that the two places of a run with these bounds share: length - period."""
    return -(-min_length * (repeats - 1) // repeats)


def repeated(ids: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
    """Texts in which some ``width`` consecutive words occur twice (and, by a hash collision, others)."""
    if len(ids) < width:
        return np.zeros(0, np.int64)
    power = np.cumprod(np.r_[np.uint64(1), np.full(len(ids), 0x9E3779B97F4A7C15, np.uint64)], dtype=np.uint64)
    spread = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    total = np.r_[np.uint64(0), np.cumsum((spread ^ (spread >> np.uint64(29))) * power[:-1], dtype=np.uint64)]
    gram = (total[width:] - total[:-width]) * power[len(ids) - width::-1]
    at = np.flatnonzero(text[width - 1:] == text[:len(text) - width + 1])
    key, owner = gram[at], text[at]
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    return np.unique(owner[1:][(key[1:] == key[:-1]) & (owner[1:] == owner[:-1])])


def suffixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes, and how many words each shares with the one before it."""
    n = len(words)
    ranks = [np.unique(words, return_inverse=True)[1]]
    width = 1
    while ranks[-1].max(initial=0) < n - 1:
        behind = np.zeros(n, np.int64)
        behind[:max(0, n - width)] = ranks[-1][width:] + 1
        ranks.append(np.unique(ranks[-1] * (n + 1) + behind, return_inverse=True)[1])
        width *= 2
    order = np.empty(n, np.int64)
    order[ranks[-1]] = np.arange(n)
    ranks = [r.astype(np.int32) for r in ranks]
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(max(0, n - 1), np.int64)
    for level in range(len(ranks) - 2, -1, -1):
        rank, step = ranks[level], 1 << level
        inside = np.flatnonzero((a < n) & (b < n))
        same = inside[rank[a[inside]] == rank[b[inside]]]
        a[same] += step
        b[same] += step
        shared[same] += step
    return order, np.r_[0, shared]


class Node:
    """Places below an LCP interval: all in order, and by the word left of each."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, left: int):
        self.places, self.classes = [place], {left: [place]}

    def partners(self, place: int, left: int, near: int, far: int) -> list[int]:
        """Places of other classes at a distance from ``near`` to ``far``."""
        low, high = bisect_left(self.places, place - far), bisect_right(self.places, place + far)
        if low == high:
            return []
        found = []
        if high - low <= len(self.classes):
            own = self.classes.get(left, [])
            for other in self.places[low:high]:
                k = bisect_left(own, other)
                if not (k < len(own) and own[k] == other):
                    found.append(other)
        else:
            for word, others in self.classes.items():
                if word != left:
                    found += others[bisect_left(others, place - far):bisect_right(others, place + far)]
        return [x for x in found if abs(x - place) >= near]

    def take(self, other: Node) -> None:
        for left, places in other.classes.items():
            own = self.classes.setdefault(left, [])
            for place in places:
                insort(own, place)
                insort(self.places, place)


def joined(a: Node, b: Node, shared: int, min_length: int, repeats: int, out: list[Run]) -> Node:
    """Both nodes as one, after their maximal pairs are noted: places of different nodes and left words."""
    big, small = (a, b) if len(a.places) >= len(b.places) else (b, a)
    near, far = max(1, min_length - shared), shared // (repeats - 1)
    if near <= far:
        for left, places in small.classes.items():
            for place in places:
                out += [(min(place, x), shared + abs(place - x), abs(place - x)) for x in big.partners(place, left, near, far)]
    big.take(small)
    return big


def maximal_pairs(words: np.ndarray, min_length: int, repeats: int) -> list[Run]:
    """(start, length, distance) of every maximal pair that the bounds allow, from the leaves up.

    ``words`` begins with, and between texts holds, numbers that occur once.
    """
    order, shared = suffixes(words)
    least = least_shared(min_length, repeats)
    out: list[Run] = []
    first = np.flatnonzero((shared[1:] >= least) & (shared[:-1] < least))  # suffixes whose successor shares enough
    left = words[order - 1].tolist()
    for start in first.tolist():
        stop = start + 1
        while stop < len(shared) and shared[stop] >= least:
            stop += 1
        places, lcps = order[start:stop].tolist(), shared[start:stop].tolist() + [0]
        stack: list[tuple[int, Node]] = []
        for k, place in enumerate(places):
            node, level = Node(place, left[start + k]), lcps[k + 1]
            while stack and stack[-1][0] >= level:
                above, child = stack.pop()
                node = joined(child, node, above, min_length, repeats, out)
            stack.append((level, node))
    return out


def runs_of(words: np.ndarray, min_length: int = 24, repeats: int = 3) -> list[Run]:
    """(start, length, smallest period) of every run in ``words`` as in ``maximal_pairs``. A stretch that
    repeats with period q also does with multiples of q, which are maximal pairs of the same extent."""
    smallest: dict[tuple[int, int], int] = {}
    for start, length, period in maximal_pairs(words, min_length, repeats):
        smallest[start, length] = min(period, smallest.get((start, length), period))
    return sorted((start, length, period) for (start, length), period in smallest.items())


def portions(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """Words of consecutive texts, so many texts at once that they hold about PORTION words."""
    part, size = [], 0
    for text in texts:
        words = (text.as_py() or "").encode().split()  # bytes split at ASCII white space only
        if part and size + len(words) > PORTION:
            yield part
            part, size = [], 0
        part.append(words)
        size += len(words)
    if part:
        yield part


def found_in(part: list[list[bytes]], min_length: int, repeats: int) -> list[list[Run]]:
    """Runs of every text of a portion."""
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for words in part for w in words], np.int64)
    sizes = np.array([len(words) for words in part])
    first = np.r_[0, np.cumsum(sizes)]
    out: list[list[Run]] = [[] for _ in part]
    hit = repeated(ids, np.repeat(np.arange(len(part)), sizes), least_shared(min_length, repeats))
    if not len(hit):
        return out
    # A number of its own stands before each text and after the last, so nothing reaches across.
    pieces, starts, at = [], [], 0
    for k, text in enumerate(hit.tolist()):
        pieces += [[len(number) + k], ids[first[text]:first[text + 1]]]
        starts.append(at + 1)
        at += 1 + sizes[text]
    all_words = np.concatenate([*pieces, [len(number) + len(hit)]])
    for start, length, period in runs_of(all_words, min_length, repeats):
        k = bisect_right(starts, start) - 1
        out[hit[k]].append((start - starts[k], length, period))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> str:
    """The words but for those that some run holds after its first period."""
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return b" ".join(words).decode()


RESULT = "struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, collapsed: string>"


def detector(min_length: int, repeats: int):
    run_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sizes, found, rest = [], [], []
            for part in portions(texts):
                for words, runs in zip(part, found_in(part, min_length, repeats)):
                    sizes.append(len(words))
                    found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                    rest.append(collapsed(words, runs))
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(found, run_type), pa.array(rest, pa.string())], names=["n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = 24, repeats: int = 3) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row: runs of ``min_length`` words or more that hold
    ``repeats`` periods or more, by start and period, and the text with every run cut to its first period."""
    found = docs.select(F.col(doc_id).alias("doc_id"), detector(min_length, repeats)(F.col(text)).alias("found"))
    return found.select("doc_id", "found.*")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first."""
    def better(best: Column, x: Column) -> Column:
        return F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)

    return F.reduce(runs, F.lit(None).cast("struct<start: long, length: long, period: long>"), better)

"""Bloom filters over 64-bit hashes, built by Spark tasks in a bounded number of partial filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A filter has at most this many bits (32 MB); beyond it more rows pass, none is missed.
MAX_BITS = 1 << 28
BITS_PER_ITEM = 16
HASHES = 4
#: Partial filters that meet in the merge, at most, and bits in one piece of a filter.
MAX_PARTIALS = 128
PIECE_BITS = 1 << 20


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions of every hash, one column for each hash function (double hashing)."""
    h = hashes.astype(np.int64, copy=False).view(np.uint64)
    mixed = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    step = (mixed >> np.uint64(17)) | np.uint64(1)
    return np.stack([((mixed + np.uint64(i) * step) >> np.uint64(7)) & np.uint64(bits - 1) for i in range(HASHES)], axis=1)


def holds(filter_: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether all bits of each row of positions are set."""
    hit = np.ones(len(at), dtype=bool)
    for column in at.T:
        hit &= (filter_[column >> np.uint64(3)] >> (column & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return hit


def put(filter_: np.ndarray, at: np.ndarray) -> None:
    flat = at.ravel()
    np.bitwise_or.at(filter_, flat >> np.uint64(3), np.left_shift(np.uint8(1), (flat & np.uint64(7)).astype(np.uint8)))


def bits_for(items: int) -> int:
    return int(min(MAX_BITS, max(1 << 16, 1 << (max(1, items * BITS_PER_ITEM) - 1).bit_length())))


def build(hashes: DataFrame, items: int, repeated_only: bool) -> tuple[np.ndarray, int]:
    """A filter over the one column of ``hashes``: of all its values, or of those seen at least twice.

    First pass over the hashes: every task sets the bits of what it sees once and of what it sees
    again. Merging two partial filters, what both saw once has been seen twice. A null hash is skipped.
    """
    bits = bits_for(items)
    column = hashes.columns[0]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once, again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            values, counts = np.unique(batch[column].dropna().to_numpy(dtype=np.int64), return_counts=True)
            at = positions(values, bits)
            put(again, at[(counts > 1) | holds(once, at)])
            put(once, at)
        size = min(PIECE_BITS, bits) // 8
        for k in range(bits // 8 // size):
            a, b = once[k * size:(k + 1) * size], again[k * size:(k + 1) * size]
            if a.any():
                yield pd.DataFrame({"piece": [k], "once": [a.tobytes()], "again": [b.tobytes() if b.any() else None]})

    def merge(pieces: pd.DataFrame) -> pd.DataFrame:
        once = again = np.zeros(min(PIECE_BITS, bits) // 8, np.uint8)
        for a, b in zip(pieces["once"], pieces["again"]):
            a = np.frombuffer(a, np.uint8)
            again = again | (once & a) if b is None else again | (once & a) | np.frombuffer(b, np.uint8)
            once = once | a
        return pd.DataFrame({"piece": pieces["piece"][:1], "bits": [(again if repeated_only else once).tobytes()]})

    parts = hashes.coalesce(MAX_PARTIALS).mapInPandas(partial, "piece int, once binary, again binary")
    merged = parts.groupBy("piece").applyInPandas(merge, "piece int, bits binary").collect()
    size, out = min(PIECE_BITS, bits) // 8, np.zeros(bits // 8, np.uint8)
    for row in merged:  # at most MAX_BITS in all
        out[row["piece"] * size:(row["piece"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return out, bits


def might_hold(df: DataFrame, filter_: tuple[np.ndarray, int], hash_: Column) -> Column:
    """Second pass: whether a row's hash may be in the filter."""
    sent, bits = df.sparkSession.sparkContext.broadcast(filter_[0]), filter_[1]

    @F.pandas_udf("boolean")
    def test(h: pd.Series) -> pd.Series:
        return pd.Series(holds(sent.value, positions(h.fillna(0).to_numpy(dtype=np.int64), bits)))

    return test(hash_)

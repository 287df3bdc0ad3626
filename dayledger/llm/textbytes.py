"""Words of many texts at once, as NumPy arrays over the bytes of an Arrow batch.

A batch of texts is one byte buffer. Words are found by comparing neighbouring bytes, hashed by a
polynomial over their bytes and kept as arrays; no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

POWERS = np.cumprod(np.r_[np.uint64(1), np.full(255, 0x100000001B3, np.uint64)], dtype=np.uint64)


def byte_table(letters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(letters.encode("latin-1"), np.uint8)] = True
    return out


#: ASCII white space; letters and digits, where any byte of a longer UTF-8 sequence counts as a letter.
SPACE = byte_table(" \t\n\x0b\x0c\r")
ALNUM = byte_table("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
ALNUM[128:] = True


@dataclass
class Words:
    """``raw`` bytes of all texts, each followed by a space; ``low`` the same in lower case; ``start``,
    ``stop`` of every word; ``hash`` of its lower-case bytes; ``doc`` its text; ``first`` word of each
    text, with the number of words at the end."""

    raw: np.ndarray
    low: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def portions(texts: list[str | None], characters: int = 1 << 19) -> Iterator[slice]:
    """Consecutive parts of ``texts`` of about so many characters; a longer text is a part of its own."""
    start = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text or "") > characters:
            yield slice(start, k)
            start, size = k, 0
        size += len(text or "") + 1
    if start < len(texts):
        yield slice(start, len(texts))


def lower(raw: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and of the accented Latin letters U+00C0 to U+00DE."""
    low = raw.copy()
    low[(raw >= 65) & (raw <= 90)] += 32
    second = np.flatnonzero(raw[:-1] == 0xC3) + 1
    second = second[(raw[second] >= 0x80) & (raw[second] <= 0x9E) & (raw[second] != 0x97)]
    low[second] += 32
    return low


def split(texts: list[str | None], inside: np.ndarray) -> Words:
    """Words of ``texts``: runs of bytes for which ``inside`` holds. Null is an empty text."""
    parts = [(t or "").encode() for t in texts]
    raw = np.frombuffer(b" ".join([*parts, b""]) or b" ", np.uint8)
    low = lower(raw)
    is_in = inside[raw]
    edges = np.diff(np.r_[False, is_in, False].astype(np.int8))
    start, stop = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    ends = np.cumsum([len(p) + 1 for p in parts]) if parts else np.zeros(0, np.int64)
    doc = np.searchsorted(ends, start, side="right")
    first = np.searchsorted(doc, np.arange(len(parts) + 1))
    return Words(raw, low, start, stop, hashes(low, start, stop), doc, first)


def hashes(low: np.ndarray, start: np.ndarray, stop: np.ndarray, at_once: int = 1 << 16) -> np.ndarray:
    """64-bit hash of each word, ``at_once`` words at a time. Beyond 256 bytes of a word the powers repeat."""
    out = np.zeros(len(start), np.uint64)
    for k in range(0, len(start), at_once):
        first, length = start[k:k + at_once], (stop - start)[k:k + at_once]
        edge = np.r_[0, np.cumsum(length)[:-1]]
        offset = np.arange(length.sum()) - np.repeat(edge, length)
        value = low[offset + np.repeat(first, length)].astype(np.uint64) + np.uint64(1)
        out[k:k + at_once] = mix(np.add.reduceat(value * POWERS[offset & 255], edge) ^ length.astype(np.uint64))
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words that lie in one text, and the index of their first word."""
    if len(words.hash) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(words.doc[n - 1:] == words.doc[:len(words.doc) - n + 1])
    out = words.hash[at]
    for k in range(1, n):
        out = mix(out + np.uint64(k)) + words.hash[at + k]
    return mix(out), at

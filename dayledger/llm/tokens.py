"""Token ids of whole texts by the file of a public byte-level tokenizer.

The file holds one base64 token and its rank a line. The ids are those of the ``tokenizers`` library with the
same vocabulary (tests compare them), which takes more than three times as long for them.

A pattern that looks ahead is matched by backtracking, which is a third of the time. Byte-level patterns look
ahead only where white space follows white space, so texts without such runs are cut by a plainer one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts whose ids a task holds at once.
AT_ONCE = 512

#: White space after white space, by all that Unicode or Python takes for it.
RUN = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]{2}"


@lru_cache(maxsize=8)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}


@lru_cache(maxsize=8)
def encoding_of(path: str, pattern: str, special: tuple[tuple[str, int], ...]):
    """Made once a process, as it takes as long as some hundred texts."""
    import tiktoken

    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks_of(path), special_tokens=dict(special))


@dataclass(frozen=True)
class Vocabulary:
    """``path`` of the ranks, readable by every executor; ``pattern`` that cuts texts before merging; ``special``
    strings with an id of their own. ``plain``, if given, cuts texts alike in which no white space follows white space."""

    path: str
    pattern: str
    special: dict[str, int] = field(default_factory=dict)
    plain: str | None = None

    def encoding(self, pattern: str | None = None):
        return encoding_of(self.path, pattern or self.pattern, tuple(self.special.items()))

    def ids(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of every text as little-endian 32-bit numbers."""
        for text, runs in zip(texts.to_pylist(), pc.match_substring_regex(texts, RUN).to_pylist()):
            encoding = self.encoding() if runs else self.encoding(self.plain)
            yield encoding.encode_to_numpy(text or "", allowed_special="all").astype("<u4", copy=False).tobytes()


def spans(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, stop) of the pieces: full ones, but the first, which takes what is left over."""
    first = length % capacity or min(length, capacity)
    edges = [0, *range(first, length + 1, capacity)]
    return list(zip(edges, edges[1:]))


def pieces(text: Column, vocabulary: Vocabulary, end: int, capacity: int) -> Column:
    """Pieces of at most ``capacity`` ids of every text with ``end`` behind it: where each begins, how
    long it is, and its ids as little-endian 32-bit numbers. Null is an empty text."""
    fields = [pa.field("start", pa.int64()), pa.field("length", pa.int64()), pa.field("ids", pa.binary())]

    @F.arrow_udf("array<struct<start: long, length: long, ids: binary>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        last = end.to_bytes(4, "little")
        for texts in batches:
            for k in range(0, max(1, len(texts)), AT_ONCE):  # ids take more room than their texts
                starts, lengths, ids, offsets = [], [], [], [0]
                for some in vocabulary.ids(texts[k:k + AT_ONCE]):
                    some += last
                    for a, b in spans(len(some) // 4, capacity):
                        starts.append(a)
                        lengths.append(b - a)
                        ids.append(some[4 * a:4 * b])
                    offsets.append(len(ids))
                columns = [pa.array(values, f.type) for values, f in zip((starts, lengths, ids), fields)]
                yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=fields))

    return run(text)

"""Toxicity by class-conditional Kneser-Ney language models.

The models run over the bytes of each word (lower case, with a mark at both ends), ``ORDER`` bytes at a
time. Counts of the longest n-grams are kept for toxic and for ordinary documents; all shorter ones are
shared: continuation counts over all documents, labelled or not. So an expression that only one class
has seen stands out, and one that neither has seen often falls back to the same probability in both.

Documents are split into portions of text once; a portion keeps its distinct words and the number of each
word in its order. Words are counted over all portions. The distinct words are read in chunks: a chunk sends
its distinct n-grams, packed, to buckets chosen by the two bytes before the last. All n-grams of 3 bytes and
more with one context, and all shorter n-grams they fall back to, are then in one bucket, so that counts,
continuation counts of every order and log ratios need no further shuffle; those of 1 and 2 bytes are a
table of at most 65,536 rows. A bucket answers every chunk with the log ratios of the n-grams it sent, in their
order; a chunk sums them per word. Portions ask for the sums of their words in the same way, by ranges of the
words' hash. No table of n-grams or words passes through the driver, and none is cut.

A document's evidence is compared per length: the mean log ratio of its words, and the log ratios of its
most toxic words and passages. A logistic regression, fitted on labelled documents whose counts the
models did not see, maps it to a probability.

Bounds: class counts come from all usable labelled documents; about a fifth of ``SAMPLE_DOCS`` others, by a
hash of the id, calibrate the evidence.

Defined cases: null and empty texts have no evidence and get the score of a document without any; null
labels are left out, of contradicting labels of one id the larger counts; with labels of one kind only,
or none, every score is the mean label, or 0; repeated rows get equal scores; empty tables give no rows.
Id, language, source and label never reach a score; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm import bloom, textbytes
from dayledger.llm.common import discard, stored
from dayledger.llm.quality import held_out, sampled

ORDER = 7
#: Labelled documents of which a fifth calibrates, at most.
SAMPLE_DOCS = 100_000
#: One of so many labelled documents calibrates instead of being counted.
CALIBRATION = 5
#: Words of a passage.
PASSAGE = 8
#: Characters of a portion; log ratios are multiples of 1 / ``EXACT``, so their sums do not depend on the order.
PORTION = 1 << 21
EXACT = float(1 << 20)
CLASSES = ("toxic", "ordinary")
#: N-grams that a chunk of the distinct words sends, repeats included, and that a bucket gets on average, at most.
CHUNK = 1 << 20


def word_grams(words: textbytes.Words) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of each word and at its end mark, and the word it belongs to.
    The oldest byte is the highest; bytes before the word are 0, its two marks 1."""
    length = words.stop - words.start
    edge = np.r_[0, np.cumsum(length + 1)]
    which = np.repeat(np.arange(len(length)), length + 1)
    offset = np.arange(edge[-1]) - edge[which]
    last = offset == length[which]
    byte = np.where(last, 1, words.low[np.minimum(words.start[which] + offset, len(words.low) - 1)]).astype(np.int64)
    gram = byte.copy()
    for back in range(1, ORDER):
        older = np.r_[np.zeros(back, np.int64), byte[:-back]] if len(byte) > back else np.zeros(len(byte), np.int64)
        gram |= np.where(offset >= back, older, np.where(offset == back - 1, 1, 0)) << (8 * back)
    return gram, which


def distinct_words(texts: list[str | None]) -> tuple[textbytes.Words, np.ndarray, np.ndarray, textbytes.Words]:
    """Words of ``texts``; the distinct ones as a ``Words`` of their own and each word's number in it."""
    words = textbytes.split(texts, textbytes.ALNUM)
    _, first, number = np.unique(words.hash, return_index=True, return_inverse=True)
    few = textbytes.Words(words.raw, words.low, words.start[first], words.stop[first], words.hash[first], words.doc[first], words.first)
    return words, first, number, few


def portioned(docs: DataFrame) -> DataFrame:
    """One row per portion of ``doc_id, text, y`` (y null: not labelled, or kept for calibration): its ids, the
    words of each text, the number of every word, and of each in ``word`` how often it occurs, also by class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        portion = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, y = batch.column("text").to_pylist(), batch.column("y").to_numpy(zero_copy_only=False).astype(float)
            for part in textbytes.portions(texts, PORTION):
                words, _, number, few = distinct_words(texts[part])
                label, n = y[part][words.doc], len(few.hash)
                length = few.stop - few.start
                edge = np.r_[0, np.cumsum(length)]
                body = few.low[np.arange(edge[-1]) + np.repeat(few.start - edge[:-1], length)]
                word = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(edge.astype(np.int32).tobytes()), pa.py_buffer(body.tobytes())])
                counts = [np.bincount(number[chosen], minlength=n) for chosen in (label == 1, label == 0)]
                ids = batch.column("doc_id").slice(part.start, part.stop - part.start)
                one = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, word, *[pa.array(c, pa.int64()) for c in counts])]
                often = np.bincount(number, minlength=n)
                # Frequent words get small numbers, which pack well; ``often`` tells which word a number means.
                rank = np.empty(n, np.int64)
                rank[np.argsort(-often, kind="stable")] = np.arange(n)
                order = [pa.array([packed(x.astype(np.int32))], pa.binary()) for x in (np.diff(words.first), rank[number], often)]
                yield pa.RecordBatch.from_arrays([pa.array([portion], pa.int64()), one[0], *order, *one[1:]],
                                                 ["portion", "ids", "lengths", "number", "often", "word", *CLASSES])
                portion += 1

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "y").mapInArrow(
        run, f"portion long, ids array<{kind}>, lengths binary, number binary, often binary, word array<binary>, " + ", ".join(f"{c} array<long>" for c in CLASSES))


def vocabulary(portions: DataFrame) -> DataFrame:
    """``word, toxic, ordinary`` of every distinct word."""
    rows = portions.select(F.explode(F.arrays_zip("word", *CLASSES)).alias("w")).select("w.*")
    return rows.groupBy("word").agg(*[F.sum(c).alias(c) for c in CLASSES])


def spelled(words: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """``word_grams`` of the bytes of ``words``."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    stop = np.cumsum(length + 1) - 1
    low = np.frombuffer(b" ".join([*map(bytes, words), b""]) or b" ", np.uint8)
    none = np.zeros(0, np.int64)
    return word_grams(textbytes.Words(low, low, stop - length, stop, none, none, none))


def packed(x: np.ndarray) -> bytes:
    """Integers with their bytes of one rank together, compressed."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd", 9).compress(planes, asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    if not size:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], size), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def folded(x: np.ndarray) -> np.ndarray:
    """Whole numbers with the sign as lowest bit, so that small ones have no high bytes."""
    return (x << 1) ^ (x >> 63)


def unfolded(x: np.ndarray) -> np.ndarray:
    return (x >> 1) ^ -(x & 1)


def bucket_of(gram: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of n-grams by the two bytes before the last."""
    mixed = textbytes.mix(((gram >> 8) & 0xFFFF).astype(np.uint64))
    return (mixed % np.uint64(buckets)).astype(np.int32)


def dealt(words: pd.Series, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of ``words`` by (bucket, n-gram), where each bucket starts, and of every
    n-gram that occurs its place among them and its word."""
    gram, which = spelled(words)
    few, place = np.unique(gram, return_inverse=True)
    bucket = bucket_of(few, buckets)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(few), np.int64)
    rank[order] = np.arange(len(few))
    return few[order], np.searchsorted(bucket[order], np.arange(buckets + 1)), rank[place], which


def vocabulary_grams(words: DataFrame) -> DataFrame:
    """``chunk, bucket, buckets, gram, toxic, ordinary, word``: per chunk of ``vocabulary`` and bucket the distinct
    n-grams and their counts, packed. The words of the chunk stand in a row of their own, of bucket -1."""
    total = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    buckets = int(min(1 << 16, max(8, total // CHUNK)))
    names = ["chunk", "bucket", "buckets", "gram", *CLASSES, "word"]

    def row(chunk: int, bucket: int, gram, counts, word) -> pd.DataFrame:
        return pd.DataFrame([[chunk, bucket, buckets, gram, *counts, word]], columns=names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk = TaskContext.get().partitionId() << 32
        for part in chunks(batches):
            gram, edge, place, which = dealt(part["word"], buckets)
            counts = [np.bincount(place, part[c].to_numpy(dtype=np.float64)[which], len(gram)).astype(np.int64) for c in CLASSES]
            yield row(chunk, -1, None, [None] * len(CLASSES), part["word"].tolist())
            for k in np.flatnonzero(np.diff(edge)):
                own = slice(edge[k], edge[k + 1])
                yield row(chunk, int(k), packed(gram[own]), [packed(c[own]) for c in counts], None)
            chunk += 1

    return words.select("word", *CLASSES).mapInPandas(
        run, "chunk long, bucket int, buckets int, gram binary, toxic binary, ordinary binary, word array<binary>")


def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of ``batches`` together until their words have ``CHUNK`` n-grams; a longer word is a chunk of its own."""
    held, size = [], 0
    for batch in batches:
        length = np.fromiter(map(len, batch["word"]), np.int64, len(batch)) + 1
        start = 0
        for k, n in enumerate(length.tolist()):
            if size and size + n > CHUNK:
                yield pd.concat([*held, batch[start:k]], ignore_index=True)
                held, size, start = [], 0, k
            size += n
        held.append(batch[start:])
    if size:
        yield pd.concat(held, ignore_index=True)


def gram_counts(docs: DataFrame) -> DataFrame:
    """``vocabulary_grams`` of the words of ``text, y``."""
    return vocabulary_grams(vocabulary(portioned(docs.select(F.lit(0).alias("doc_id"), "text", "y"))))


def met(rows: pa.Table) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
    """What each row of a bucket asks for, the distinct n-grams of the bucket in order, and their counts."""
    asked = [unpacked(x, np.int64) for x in rows.column("gram").to_pylist()]
    gram, place = np.unique(np.concatenate(asked), return_inverse=True)
    counts = []
    for c in CLASSES:
        each = np.concatenate([unpacked(x, np.int64) for x in rows.column(c).to_pylist()])
        counts.append(np.bincount(place, each, len(gram)).astype(np.int64))
    return asked, gram, counts


def low_bytes(gram: np.ndarray, order: int) -> np.ndarray:
    return gram & ((1 << 8 * order) - 1)


def interpolated(low: np.ndarray, n: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Kneser-Ney probability of the last byte of ``low`` (in order) from continuation counts and that of the next shorter."""
    context = low >> 8
    first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(low) else np.zeros(0, np.int64)
    kinds = np.diff(np.r_[first, len(low)])
    total = np.repeat(np.add.reduceat(n, first) if len(low) else n, kinds)
    return (n - 0.75) / total + 0.75 * np.repeat(kinds, kinds) / total * back


def statistics(counts: DataFrame) -> tuple[dict[str, tuple[float, float, float]], np.ndarray]:
    """Discounts by class, and the probability of every two bytes (at most 65,536 rows)."""
    def run(rows: pa.Table) -> pa.Table:
        _, gram, each = met(rows)
        few = [[int((c == k).sum()) for k in (1, 2, 3, 4)] for c in each]
        low, n = np.unique(low_bytes(np.unique(low_bytes(gram, 3)), 2), return_counts=True)
        return pa.table({"toxic": [few[0]], "ordinary": [few[1]], "low": [low], "n": [n]},
                        pa.schema([(k, pa.list_(pa.int64())) for k in ("toxic", "ordinary", "low", "n")]))

    found = stored(counts.filter("bucket >= 0").groupBy("bucket").applyInArrow(
        run, "toxic array<long>, ordinary array<long>, low array<long>, n array<long>"), tidy=True)
    seen = found.agg(*[F.sum(F.col(c)[k]) for c in CLASSES for k in range(4)]).first()
    pairs = found.select(F.explode(F.arrays_zip("low", "n")).alias("x")).groupBy("x.low").agg(F.sum("x.n").alias("n")).collect()
    low, n = np.array(sorted((r["low"], r["n"]) for r in pairs), np.int64).reshape(-1, 2).T
    last, kinds = np.unique(low_bytes(low, 1), return_counts=True)
    one = np.zeros(1 << 8)
    one[last] = interpolated(last, kinds, np.full(len(last), 1 / 256))
    two = np.zeros(1 << 16)
    two[low] = interpolated(low, n, one[low_bytes(low, 1)])
    return {c: discounts([seen[4 * i + k] or 0 for k in range(4)]) for i, c in enumerate(CLASSES)}, two


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more, from how often 1 to 4 occur."""
    n1, n2, n3, n4 = n
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    bound = lambda d, k: min(max(d, 0.1), k - 0.05)
    return (bound(1 - 2 * y * n2 / n1, 1), bound(2 - 3 * y * n3 / n2, 2), bound(3 - 4 * y * n4 / max(1, n3), 3))


def backed_off(gram: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of ``ORDER - 1`` bytes in which the ``gram`` of a bucket end, in order, and the probability of
    their last byte by interpolated Kneser-Ney over continuation counts, shortest first."""
    seen = {ORDER: gram}
    for order in range(ORDER - 1, 2, -1):
        seen[order] = np.unique(low_bytes(seen[order + 1], order))
    p = None
    for order in range(3, ORDER):
        low = seen[order]
        n = np.bincount(np.searchsorted(low, low_bytes(seen[order + 1], order)), minlength=len(low))
        back = two[low_bytes(low, 2)] if p is None else p[np.searchsorted(seen[order - 1], low_bytes(low, order - 1))]
        p = interpolated(low, n, back)
    return seen[ORDER - 1], p


def shared_backoff(counts: DataFrame) -> DataFrame:
    """``low, p``: probability of the last byte of every n-gram of ``ORDER - 1`` bytes that occurs."""
    _, two = statistics(counts)

    def run(rows: pa.Table) -> pa.Table:
        low, p = backed_off(met(rows)[1], two)
        return pa.table({"low": low, "p": p})

    return counts.filter("bucket >= 0").groupBy("bucket").applyInArrow(run, "low long, p double")


def gram_ratios(gram: np.ndarray, counts: list[np.ndarray], given: dict[str, tuple[float, float, float]], two: np.ndarray) -> np.ndarray:
    """log P(last byte | toxic) / P(.. | ordinary) of the ``gram`` of a bucket, as whole multiples of 1 / ``EXACT``:
    of those that either class has seen; that of the spare mass where only the context has been seen; else 0."""
    context = gram >> 8
    first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
    kinds = np.diff(np.r_[first, len(gram)])
    low, shorter = backed_off(gram, two)
    back = shorter[np.searchsorted(low, low_bytes(gram, ORDER - 1))]
    p, rest, total = [], [], []
    for count, d in zip(counts, given.values()):
        off = np.where(count <= 0, 0.0, np.where(count == 1, d[0], np.where(count == 2, d[1], d[2])))
        sum_ = np.repeat(np.add.reduceat(count, first), kinds)
        spare = np.repeat(np.add.reduceat(off, first), kinds)
        some = np.maximum(sum_, 1)
        rest.append(np.where(sum_ > 0, spare / some, 1.0))
        p.append(np.where(sum_ > 0, (count - off) / some, 0.0) + rest[-1] * back)
        total.append(sum_)
    fallback = np.log(np.maximum(rest[0], 1e-4) / np.maximum(rest[1], 1e-4))
    ratio = np.where(counts[0] + counts[1] > 0, np.log(p[0] / p[1]), np.where(total[0] + total[1] > 0, fallback, 0.0))
    return np.rint(ratio * EXACT).astype(np.int32)


def word_ratios(counts: DataFrame) -> DataFrame:
    """``word, ratio``: summed log ratios of the n-grams of every word of ``vocabulary_grams`` where they are not all 0."""
    given, two = statistics(counts)

    def answer(rows: pa.Table) -> pa.Table:
        asked, gram, each = met(rows)
        ratio = gram_ratios(gram, each, given, two)
        told = [packed(ratio[np.searchsorted(gram, own)]) for own in asked]
        return pa.table({"chunk": rows.column("chunk"), "bucket": rows.column("bucket"), "buckets": rows.column("buckets"),
                         "ratio": pa.array(told, pa.binary())})

    def add_up(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket").to_numpy()
        words = pd.Series(rows.column("word")[int(np.argmin(bucket))].as_py())
        gram, edge, place, which = dealt(words, rows.column("buckets")[0].as_py())
        ratio = np.zeros(len(gram), np.int32)
        for k, told in zip(bucket.tolist(), rows.column("ratio").to_pylist()):
            if k >= 0:
                ratio[edge[k]:edge[k + 1]] = unpacked(told, np.int32)
        told = ratio[place]
        some = np.flatnonzero(np.bincount(which, told != 0, len(words)))
        sums = np.bincount(which, told, len(words))[some] / EXACT
        return pa.table({"word": pa.array(words.to_numpy()[some], pa.binary()), "ratio": sums})

    answers = counts.filter("bucket >= 0").groupBy("bucket").applyInArrow(answer, "chunk long, bucket int, buckets int, ratio binary")
    own = counts.filter("bucket < 0").select("chunk", "bucket", "buckets", F.lit(None).cast("binary").alias("ratio"), "word")
    both = own.unionByName(answers.withColumn("word", F.lit(None).cast("array<binary>")))
    return both.groupBy("chunk").applyInArrow(add_up, "word binary, ratio double")


def evidence(llr: np.ndarray, count: np.ndarray) -> np.ndarray:
    """One row per text of ``count`` words, from the log ratio of each word: their mean; largest and second
    largest of a word; largest mean of a passage; share of words over 2; words."""
    out = np.zeros((len(count), 6))
    if not len(llr):
        return out
    edge = np.r_[0, np.cumsum(count)]
    have = np.flatnonzero(count)
    first = edge[:-1][have]
    out[have, 0] = np.add.reduceat(llr, first) / count[have]
    out[have, 1] = best = np.maximum.reduceat(llr, first)
    # The second largest: with one occurrence of the largest taken out.
    doc = np.repeat(np.arange(len(count)), count)
    top = np.full(len(count), -1)
    at = np.flatnonzero(llr == out[doc, 1])
    top[doc[at[::-1]]] = at[::-1]
    rest = llr.copy()
    rest[top[have]] = -np.inf
    second = np.maximum.reduceat(rest, first)
    out[have, 2] = np.where(np.isfinite(second), second, np.minimum(best, 0))
    sums = np.r_[0, np.cumsum(llr)]
    stop = np.minimum(np.arange(len(llr)) + PASSAGE, edge[doc + 1])
    out[have, 3] = np.maximum.reduceat((sums[stop] - sums[:-1]) / PASSAGE, first)
    out[have, 4] = np.add.reduceat((llr > 2).astype(float), first) / count[have]
    out[have, 5] = np.log1p(count[have])
    return out


def hashed(words: pa.Array) -> np.ndarray:
    """The hashes by which a portion tells its words apart."""
    words = words.cast(pa.large_binary())
    edge = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    if not len(words):
        return np.zeros(0, np.uint64)
    body = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    return textbytes.hashes(body, edge[:-1], edge[1:])


def by_range(hash_: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The ranges of hashes, in order, that have the same upper ``bits``."""
    bucket = (hash_ >> np.uint64(64 - bits)).astype(np.int64)
    edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(hash_) else np.zeros(1, np.int64)
    for k, stop in zip(edge[:-1].tolist(), edge[1:].tolist()):
        yield int(bucket[k]), slice(k, stop)


def measured(portions: DataFrame, values: DataFrame) -> DataFrame:
    """``doc_id, x``, stored: evidence of every document of ``portions`` by the ``word, ratio`` of ``values``. Where
    these two are stored tables themselves, they are discarded once they are used up."""
    bits = max(3, int((portions.agg(F.sum(F.size("word"))).first()[0] or 0) // CHUNK).bit_length())

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                hash_ = hashed(batch.column("word")[k].values)
                rows = [(bucket, packed(hash_[own])) for bucket, own in by_range(hash_, bits)]
                yield pa.RecordBatch.from_pydict({"portion": [batch.column("portion")[k].as_py()] * len(rows), "bucket": [r[0] for r in rows],
                                                  "hash": [r[1] for r in rows]}, pa.schema([("portion", pa.int64()), ("bucket", pa.int64()), ("hash", pa.binary())]))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hash_ = hashed(batch.column("word"))
            order = np.argsort(hash_)
            hash_, ratio = hash_[order], np.rint(batch.column("ratio").to_numpy()[order] * EXACT).astype(np.int64)
            rows = [(bucket, packed(hash_[own]), packed(ratio[own])) for bucket, own in by_range(hash_, bits)]
            yield pa.RecordBatch.from_pydict(dict(zip(("bucket", "hash", "ratio"), zip(*rows))) if rows else {"bucket": [], "hash": [], "ratio": []},
                                             pa.schema([("bucket", pa.int64()), ("hash", pa.binary()), ("ratio", pa.binary())]))

    def answer(told: pa.Table, asked: pa.Table) -> pa.Table:
        known = np.concatenate([np.zeros(0, np.uint64), *[unpacked(x, np.uint64) for x in told.column("hash").to_pylist()]])
        ratio = np.concatenate([np.zeros(0, np.int64), *[unpacked(x, np.int64) for x in told.column("ratio").to_pylist()]])
        order = np.argsort(known)
        known, ratio = np.r_[known[order], np.uint64(0)], np.r_[ratio[order], 0]
        found = []
        for x in asked.column("hash").to_pylist():
            hash_ = unpacked(x, np.uint64)
            at = np.searchsorted(known[:-1], hash_)
            found.append(packed(folded(np.where((known[at] == hash_) & (at < len(known) - 1), ratio[at], 0))))
        return pa.table({"portion": asked.column("portion"), "bucket": asked.column("bucket"), "ratio": pa.array(found, pa.binary())})

    def weigh(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket").to_numpy()
        order = np.argsort(bucket)
        own = int(order[0])  # bucket -1: the portion itself
        count, number, often = (unpacked(rows.column(c)[own].as_py(), np.int32) for c in ("lengths", "number", "often"))
        llr = np.concatenate([np.zeros(0), *[unfolded(unpacked(rows.column("ratio")[int(k)].as_py(), np.int64)) / EXACT for k in order[1:]]])
        llr = llr[np.argsort(-often, kind="stable")]
        x = evidence(llr[number], count.astype(np.int64))
        edge = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
        return pa.table({"doc_id": rows.column("ids")[own].values, "x": pa.ListArray.from_arrays(edge, pa.array(x.ravel()))})

    asks = portions.select("portion", "word").mapInArrow(ask, "portion long, bucket long, hash binary")
    tells = values.select("word", "ratio").mapInArrow(tell, "bucket long, hash binary, ratio binary")
    answers = stored(tells.groupBy("bucket").cogroup(asks.groupBy("bucket")).applyInArrow(answer, "portion long, bucket long, ratio binary"), tidy=True)
    kind = portions.schema["ids"].dataType.elementType.simpleString()
    # The answers are stored, so the words of the portions have done their work: only their order is kept.
    own = stored(portions.select("portion", F.lit(-1).cast("long").alias("bucket"), "ids", "lengths", "number", "often"), tidy=True)
    discard(portions, values)
    found = own.unionByName(answers, allowMissingColumns=True).groupBy("portion").applyInArrow(weigh, f"doc_id {kind}, x array<double>")
    out = stored(found, tidy=True)
    discard(own, answers)
    return out


def stretched(x: np.ndarray) -> np.ndarray:
    """Inputs of the calibration: evidence, bounded, and squares of the word evidence."""
    x = np.column_stack([np.clip(x[:, 0] * 10, -3, 3), np.clip(x[:, 1:4], -8, 8), np.minimum(x[:, 4] * 20, 3), x[:, 5]])
    return np.column_stack([np.ones(len(x)), x, x[:, 1:4] ** 2 / 8, x[:, 5] * x[:, 1] / 8])


def calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    x, w = stretched(x), None
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + 0.1 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w - np.linalg.solve(curve, slope)
    return w


def train(docs: DataFrame, labels: DataFrame, parts: int, part: int, sample: int = SAMPLE_DOCS):
    """``doc_id, x`` of every document and the weights of the evidence x, or a constant score where labels are
    of one kind or missing."""
    usable = ~held_out(F.col("doc_id"), parts, part)
    fold = F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(CALIBRATION)) == 0
    known = labels.filter(usable).select("doc_id", "toxic")
    kinds = known.groupBy("toxic").count().filter("toxic IS NOT NULL").collect()
    if len(kinds) < 2:
        return float(kinds[0]["toxic"]) if kinds else 0.0
    portions = stored(portioned(marked(docs.select("doc_id", "text"), stored(labelled(known.filter(~fold)), tidy=True))), tidy=True)
    words = stored(vocabulary(portions), tidy=True)
    grams = stored(vocabulary_grams(words), tidy=True)
    discard(words)
    values = stored(word_ratios(grams), tidy=True)
    discard(grams)
    found = measured(portions, values)
    rows = sampled(found.select("doc_id", F.col("x").alias("text")), known.filter(fold), "toxic", F.lit(True), sample // CALIBRATION).toArrow().to_pandas()
    if rows["y"].nunique() < 2:
        return found, np.r_[-2.0, 0.0, 1.0, np.zeros(8)]
    x, y = np.stack(rows["text"]), rows["y"].to_numpy()
    order = np.lexsort((*x.T, y))  # reruns agree
    return found, calibrate(x[order], y[order])


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with the ``y`` of ``labels``, or null. Only texts whose id may have a label meet the labels."""
    key = F.xxhash64("doc_id")
    filter_ = bloom.build(labels.select(key.alias("key")), labels.count(), repeated_only=False)
    rows = docs.withColumn("maybe", bloom.might_hold(docs, filter_, key))
    met = rows.filter("maybe").join(labels, "doc_id", "left")
    return met.drop("maybe").unionByName(rows.filter("NOT maybe").drop("maybe").withColumn("y", F.lit(None).cast("double")))


def labelled(labels: DataFrame) -> DataFrame:
    """``doc_id, y`` of all labels."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    return known.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("y"))


def score(docs: DataFrame, labels: DataFrame, parts: int = 4, part: int = 2) -> DataFrame:
    """``doc_id, held_out, score`` of every document."""
    trained = train(docs, labels, parts, part)
    apart = held_out(F.col("doc_id"), parts, part).alias("held_out")
    if isinstance(trained, float):
        return docs.select("doc_id", apart, F.lit(trained).alias("score"))
    found, weights = trained

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(1 / (1 + np.exp(-np.clip((stretched(np.stack(x)) * weights).sum(axis=1), -30, 30))))

    return found.select("doc_id", apart, run(F.col("x")).alias("score"))

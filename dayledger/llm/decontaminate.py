"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. The n-grams of all benchmark items are counted over all documents (documents that hold them).
2. Seeds: from every stretch of ``stretch`` consecutive n-grams of an item, the one that the fewest
   documents hold. Rarity is relative, so an item that a third of all documents quote still has seeds,
   and every part of an item is covered.
3. Documents are scanned for seeds. A seed found proposes a stretch of the document, as long as the item
   plus room for insertions; proposals that overlap are merged.
4. Each proposed pair is joined with its item's text and aligned word by word. The score is the
   alignment's part of the best possible, so insertions, deletions and replaced words lower it.

The benchmark is taken in blocks of at most ``BLOCK_GRAMS`` n-grams; what is sent to the tasks has that
bound, and the documents are scanned once a block. Words are runs of letters and digits, lower case.

Defined cases: null and wordless texts and items match nothing; an item of fewer words than ``n`` is
sought as one n-gram of its own length; repeated documents each get their rows, repeated items too;
empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm import textbytes
from dayledger.llm.common import stored

BLOCK_GRAMS = 2_000_000
MATCH, MISMATCH, GAP = 2, -1, -1


def item_grams(items: DataFrame, n: int) -> DataFrame:
    """``item_id, pos, n_words, width, gram`` of every n-gram of every item (shorter items: one)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = textbytes.split(list(batch["text"]), textbytes.ALNUM)
            count = np.diff(words.first)
            for width in range(1, n + 1):
                gram, at = textbytes.grams(words, width)
                doc = words.doc[at]
                keep = np.flatnonzero(count[doc] == width if width < n else count[doc] >= n)
                yield pd.DataFrame({"item_id": batch["item_id"].to_numpy()[doc[keep]], "pos": at[keep] - words.first[doc[keep]],
                                    "n_words": count[doc[keep]], "width": width, "gram": gram[keep].view(np.int64)})
    return items.mapInPandas(run, "item_id long, pos int, n_words int, width int, gram long")


def portions(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[textbytes.Words, pd.DataFrame]]:
    """The words of the ``text`` column, a bounded part of a batch at a time, and its rows."""
    for batch in batches:
        texts = list(batch["text"])
        for part in textbytes.portions(texts):
            yield textbytes.split(texts[part], textbytes.ALNUM), batch.iloc[part]


def lookup(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``values`` occur in the sorted ``table``: (index of value, index in table)."""
    if not len(table):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    small = np.zeros(1 << 16, bool)  # most values miss: a look at 16 bits settles them
    small[(table.view(np.uint64) >> np.uint64(48)).astype(np.int64)] = True
    maybe = np.flatnonzero(small[(values.view(np.uint64) >> np.uint64(48)).astype(np.int64)])
    place = np.minimum(np.searchsorted(table, values[maybe]), len(table) - 1)
    hit = table[place] == values[maybe]
    return maybe[hit], place[hit]


def document_counts(docs: DataFrame, grams: np.ndarray, widths: list[int]) -> DataFrame:
    """``gram, n_docs``: the number of documents that hold each of the sorted ``grams``."""
    sent = docs.sparkSession.sparkContext.broadcast(grams)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(len(sent.value), np.int64)
        for words, _ in portions(batches):
            for width in widths:
                gram, at = textbytes.grams(words, width)
                found, place = lookup(gram.view(np.int64), sent.value)
                pairs = np.unique(words.doc[at[found]].astype(np.int64) * len(sent.value) + place)
                np.add.at(counts, pairs % max(1, len(sent.value)), 1)
        held = np.flatnonzero(counts)
        yield pd.DataFrame({"gram": sent.value[held], "n_docs": counts[held]})

    return docs.select("text").mapInPandas(run, "gram long, n_docs long").groupBy("gram").agg(F.sum("n_docs").alias("n_docs"))


def seeds(grams: DataFrame, counts: DataFrame, stretch: int) -> DataFrame:
    """Of every ``stretch`` consecutive n-grams of an item, the one in the fewest documents."""
    known = grams.join(counts, "gram", "left").withColumn("n_docs", F.coalesce("n_docs", F.lit(0)))
    around = Window.partitionBy("item_id").orderBy("pos").rowsBetween(0, stretch - 1)
    best = known.withColumn("best", F.min(F.struct("n_docs", "pos", "gram", "n_words", "width")).over(around))
    return best.select("item_id", "best.pos", "best.gram", "best.n_words", "best.width").distinct()


def proposals(docs: DataFrame, seeds_: pd.DataFrame, slack: float) -> DataFrame:
    """``doc_id, item_id, first_word, passage``: stretches of documents around seeds."""
    order = np.argsort(seeds_["gram"].to_numpy(), kind="stable")
    table = {c: seeds_[c].to_numpy()[order] for c in seeds_.columns}
    keys, first = np.unique(table["gram"], return_index=True)
    sent = docs.sparkSession.sparkContext.broadcast((table, keys, np.r_[first, len(order)], sorted(set(table["width"].tolist()))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, keys, spans, widths = sent.value
        for words, batch in portions(batches):
            hits = []
            for width in widths:
                gram, at = textbytes.grams(words, width)
                found, place = lookup(gram.view(np.int64), keys)
                n = spans[place + 1] - spans[place]
                row = np.repeat(spans[place] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                hits.append(pd.DataFrame({"word": np.repeat(at[found], n), "row": row}))
            hit = pd.concat(hits, ignore_index=True)
            if not len(hit):
                continue
            row, word = hit["row"].to_numpy(), hit["word"].to_numpy()
            doc, size = words.doc[word], table["n_words"][row]
            room = np.ceil(size * slack).astype(np.int64) + 2
            low = np.maximum(word - table["pos"][row] - room, words.first[doc])
            high = np.minimum(word - table["pos"][row] + size + room, words.first[doc + 1])
            span = pd.DataFrame({"doc": doc, "item": table["item_id"][row], "low": low, "high": high}).drop_duplicates() \
                .sort_values(["doc", "item", "low"], kind="stable", ignore_index=True)
            # Proposals of a pair that overlap are one.
            pair = span.groupby(["doc", "item"], sort=False)
            reach = pair["high"].cummax().groupby([span["doc"], span["item"]], sort=False).shift()
            group = (reach.isna() | (span["low"] >= reach)).cumsum()
            merged = span.groupby(group).agg(doc=("doc", "first"), item=("item", "first"), low=("low", "min"), high=("high", "max"))
            low, high = merged["low"].to_numpy(), merged["high"].to_numpy()
            raw = words.raw.tobytes()
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].array.take(merged["doc"].to_numpy()), "row_key": batch["row_key"].to_numpy()[merged["doc"].to_numpy()],
                "item_id": merged["item"].to_numpy(), "first_word": low - words.first[merged["doc"].to_numpy()],
                "passage": [raw[words.start[a]:words.stop[b - 1]].decode() for a, b in zip(low, high)]})

    return docs.mapInPandas(run, "doc_id long, row_key long, item_id long, first_word int, passage string")


def align(passage: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: score, and first and last word of it in ``passage``.

    Row by row over the item; the gap along the passage is a running maximum, so each row is a few
    array operations."""
    n = len(passage)
    gaps = np.arange(n + 1) * -GAP
    score, origin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = score[:-1] + np.where(passage == word, MATCH, MISMATCH)
        above = score[1:] + GAP
        use = diagonal >= above
        row = np.r_[0, np.where(use, diagonal, above)]
        start = np.r_[0, np.where(use, origin[:-1], origin[1:])]
        restart = row <= 0
        row[restart], start[restart] = 0, np.arange(n + 1)[restart]
        lifted = row + gaps
        running = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == running, np.arange(n + 1), 0))
        score, origin = running - gaps, start[source]
        at = int(score.argmax())
        if score[at] > best[0]:
            best = (int(score[at]), int(origin[at]), at)
    return best


def aligned(pairs: DataFrame) -> DataFrame:
    """Scores the joined ``passage`` and ``text`` (the item's) of every pair."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left = textbytes.split(list(batch["passage"]), textbytes.ALNUM)
            right = textbytes.split(list(batch["text"]), textbytes.ALNUM)
            out = []
            for k in range(len(batch)):
                item = right.hash[right.first[k]:right.first[k + 1]]
                score, start, stop = align(left.hash[left.first[k]:left.first[k + 1]], item)
                out.append((score / (MATCH * max(1, len(item))), start, stop))
            score, start, stop = (np.array(x) for x in zip(*out))
            yield batch[["doc_id", "row_key", "item_id"]].assign(
                score=score, first_word=batch["first_word"] + start.astype("int32"), last_word=(batch["first_word"] + stop - 1).astype("int32"))
    return pairs.select("doc_id", "row_key", "item_id", "first_word", "passage", "text").mapInPandas(
        run, "doc_id long, row_key long, item_id long, first_word int, last_word int, score double")


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 3, stretch: int = 3, min_score: float = 0.5,
                 slack: float = 0.3) -> DataFrame:
    """``doc_id, row_key, item_id, score, first_word, last_word`` of the best alignment of every document
    and item that reaches ``min_score``. ``row_key`` is a hash of the text: equal texts get equal rows."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("row_key"), "text")
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    grams = stored(item_grams(items, n))
    out = None
    for block in blocks(grams):
        part = grams.join(block, "item_id") if block is not None else grams
        wanted = part.select("gram", "width").distinct().toArrow().to_pandas()  # at most BLOCK_GRAMS rows
        counts = document_counts(rows, np.sort(wanted["gram"].unique()), sorted(set(wanted["width"].tolist())))
        chosen = seeds(part, counts, stretch).toArrow().to_pandas()  # no more than the block's n-grams
        pairs = proposals(rows, chosen, slack).join(items, "item_id")
        found = aligned(pairs).filter(F.col("score") >= min_score)
        out = found if out is None else out.unionByName(found)
    best = F.max(F.struct("score", "first_word", "last_word")).alias("best")
    return out.groupBy("doc_id", "row_key", "item_id").agg(best).select(
        "doc_id", "row_key", "item_id", "best.score", "best.first_word", "best.last_word")


def blocks(grams: DataFrame) -> list[DataFrame | None]:
    """Sets of items of at most about BLOCK_GRAMS n-grams each, by a hash of the item."""
    n = max(1, -(-grams.count() * 2 // BLOCK_GRAMS))
    if n == 1:
        return [None]
    ids = grams.select("item_id").distinct()
    return [ids.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k) for k in range(n)]


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold an item, all columns kept. Decided by text."""
    leaked = stored(contaminated(docs, benchmark, **options).select(F.col("row_key").alias("__leaked")).distinct())
    return docs.join(leaked, F.xxhash64("text") == F.col("__leaked"), "left_anti")

"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source shuffles its documents (by a hash of the id) into a queue. The n-th copy of a document
gets the virtual finish time ``(words of the queue up to its end, earlier rounds included) / target``;
so all sources reach their target at virtual time 1. All copies are then range-sorted on virtual time
across sources, and the stream is cut at the total budget.

Defined cases: a null text has size 0; a null source is a source of its own, last in order; rows equal
in (source, id, size) are one queue entry whose words are shared evenly; a source without words has
target 0 and takes nothing; empty input gives no rows. A document at the cut is taken in part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm.common import running_sum, stored, words

#: A slice is what one task numbers: so many words, or the millionth part of the budget if that is more,
#: which keeps the totals of all slices few.
SLICE_WORDS, MOST_SLICES = 65_536, 1_000_000


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, repeats: int) -> DataFrame:
    """``source, source_size, target`` from one row per source. Sources in code point order, nulls
    last, take ``weights`` in turn and share ``share`` times all words; a target stops at ``repeats``
    times its source, and the excess goes to the others by weight.

    Filled in closed form: in the order of cap / weight, the capped sources are a prefix, and the rest
    share what is left. The windows hold one row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                ((rank - 1) % len(weights) + 1).cast("int"))) \
        .withColumn("cap", F.col("source_size").cast("double") * repeats)
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    upto, every = fill.rowsBetween(Window.unboundedPreceding, 0), Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    filled = ranked.withColumn("budget", F.sum("source_size").over(every) * share) \
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        .withColumn("w_from", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))) \
        .withColumn("level", (F.col("budget") - F.col("cap_before")) / F.col("w_from")) \
        .withColumn("open", (F.col("level") * F.col("w") < F.col("cap")).cast("int"))
    # The first source that its share doesn't fill fixes the level of all after it.
    first_level = F.first(F.when(F.col("open") == 1, F.col("level")), ignorenulls=True).over(upto)
    return filled.withColumn("level", first_level).select(
        "source", "source_size",
        F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("w"))).alias("target"))


def measured(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, source, size`` of every row, stored: the texts are read once."""
    return stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words(F.col(text)).alias("size")))


def goals(rows: DataFrame, weights: tuple[float, ...], share: float, repeats: int) -> DataFrame:
    return targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats)


def mix(rows: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, repeats: int = 2,
        seed: int = 17) -> DataFrame:
    """The mixed stream of ``measured`` rows: one row per queue entry and copy that is taken at least in
    part, with ``doc_id, source, size, n_rows, source_size, target, copy, finish, stream_start, words``.
    ``stream_start`` is the number of words of the stream before the copy: order by it to read the mix.
    """
    budget = (rows.agg(F.sum("size")).first()[0] or 0) * share
    slice_words = max(SLICE_WORDS, budget / MOST_SLICES)
    entries = rows.filter("size > 0").groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n_rows"))
    queue = queued(entries, goals(rows, weights, share, repeats), seed, slice_words)
    copies = queue.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))) \
        .withColumn("queue_end", F.col("end") + F.col("copy") * F.col("source_size")) \
        .withColumn("words", F.greatest(F.lit(0), F.least(
            F.col("load"), F.floor("target") - F.col("queue_end") + F.col("load")))) \
        .filter("words > 0") \
        .withColumn("finish", F.col("queue_end") / F.col("target"))
    # Equal stretches of virtual time hold equal numbers of words: they are the ranges of the sort.
    n_ranges = max(1, round(budget / slice_words))
    placed = running_sum(
        copies.withColumn("range", F.floor(F.col("finish") * n_ranges).cast("long")), "words", "stream_end", [], "range",
        [F.col("finish"), F.col("source").asc_nulls_last(), F.col("key"), F.col("doc_id"), F.col("size"), F.col("copy")])
    cut = F.floor(F.lit(float(budget))).cast("long")
    return placed.withColumn("stream_start", F.col("stream_end") - F.col("words")) \
        .withColumn("words", F.least(F.col("words"), cut - F.col("stream_start"))).filter("words > 0") \
        .select("doc_id", "source", "size", "n_rows", "source_size", "target", "copy", "finish", "stream_start", "words")


def ticket(seed: int) -> Column:
    """Where a document of ``doc_id`` and ``size`` stands in its source's queue: a uniform number of 52 bits."""
    drawn = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")))
    return F.conv(F.substring(drawn, 1, 13), 16, 10).cast("long")


def queued(entries: DataFrame, goal: DataFrame, seed: int, slice_words: float) -> DataFrame:
    """Every entry with its source's target and ``end``: words of its queue up to its own last word."""
    joined = same(entries, goal, ["source"], "inner")
    key = ticket(seed)
    # A uniform key cut into equal stretches: about ``slice_words`` each.
    stretches = F.greatest(F.lit(1), F.ceil(F.col("source_size") / slice_words))
    keyed = joined.withColumn("load", F.col("size") * F.col("n_rows")).withColumn("key", key) \
        .withColumn("stretch", F.floor(F.col("key") / F.lit(2.0 ** 52) * stretches).cast("long"))
    return running_sum(keyed, "load", "end", ["source"], "stretch", [F.col("key"), F.col("doc_id"), F.col("size")])


def same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join with null equal to null. ``right`` has one row per key; a key that holds a large share of
    ``left`` is split by the adaptive skew join."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"__right_{k}" for k in keys])


def taken(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, repeats: int = 2,
          **options) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken``; zero where the mix
    takes nothing. ``options``: the seed."""
    rows = measured(docs)
    stream = mix(rows, weights, share, repeats, **options)
    entries = stream.groupBy("source", "doc_id", "size").agg((F.sum("words") / F.max("n_rows")).alias("__words"))
    aimed = same(rows, goals(rows, weights, share, repeats), ["source"], "inner")
    return same(aimed, entries, ["source", "doc_id", "size"], "left").select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce(F.floor("__words"), F.lit(0)).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, repeats: int = 2, seed: int = 17) -> DataFrame:
    """``docs`` as the mix takes them, all columns kept: a document comes once for every ``size`` words
    taken of it, the cut one if at least half of it is taken. Documents without words stay as they are.

    A queue is taken from its head, so the last place that a pass over it takes says all about a source:
    every document up to there is taken in that pass. These places, a row for each source and pass, are all
    that meets the documents; no text is moved.
    """
    place = F.struct("key", "doc_id", "size")
    stream = mix(measured(docs), weights, share, repeats, seed).filter(2 * F.floor(F.col("words") / F.col("n_rows")) >= F.col("size"))
    last = stored(stream.withColumn("key", ticket(seed)).groupBy("source", "copy").agg(F.max(place).alias("place"))
                  .groupBy("source").agg(F.collect_list("place").alias("__last")))
    keyed = docs.select(F.struct(*docs.columns).alias("__row"), "source", "doc_id", words(F.col("text")).alias("size")) \
        .withColumn("key", ticket(seed)).select("__row", "source", "size", place.alias("__place"))
    found = same(keyed, last, ["source"], "left")
    passes = F.size(F.filter(F.coalesce("__last", F.array()), lambda end: F.col("__place") <= end))
    times = F.when(F.col("size") == 0, 1).otherwise(passes)
    return found.withColumn("__times", times).filter("__times > 0").withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select("__row.*")

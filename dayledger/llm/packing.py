"""Best-fit packing of token sequences into rows of equal capacity, in bulk-synchronous rounds.

Pieces are numbered inside their length, sequences that still have room inside their gap; both numberings
are distributed. In a round every length, from the longest down, meets the gaps in the order of a stack:
the tightest gap that takes it (its successor) is served first, and what a longer piece has left is next.
Where pieces of one length and sequences of one gap meet, rank decides: the r-th bundle goes to the r-th
sequence. A bundle is as many pieces of one length as their successor gap takes. A sequence gets one bundle
a round; then gaps are updated and the rest sweeps again. A length opens new sequences for what fits neither
a gap nor what longer lengths will leave in this round, as best fit decreasing does.

What a round sends to the driver and back are counts per length and per gap, below ``capacity`` rows each.
Pieces and sequences are joined by number, in groups of a bundle or of one, so no length is hot.

Cases. Pieces as long as the capacity get sequences of their own. Lengths must be 1 to ``capacity``. Equal
rows are as many pieces. An empty table gives none. Which piece of a length goes where follows the order in
which the table was written, so reruns may deal equal lengths differently; the number of sequences agrees.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm import tokens
from dayledger.llm.common import running_sum, stored

#: Rows that one task numbers in a slice.
SLICE = 4096


def numbered(rows: DataFrame, group: str, position: str, out: str) -> DataFrame:
    """``out``: 0, 1, 2 ... inside every ``group`` by ``position``, in slices of SLICE positions."""
    sliced = rows.withColumns({"__slice": F.floor(F.col(position) / SLICE), "__one": F.lit(1).cast("long")})
    counted = running_sum(sliced, "__one", out, [group], "__slice", [F.col(position)])
    return counted.withColumn(out, F.col(out) - 1).drop("__slice", "__one")


def numbers(rows: DataFrame, count: str, out: str) -> DataFrame:
    """Every row ``count`` times with ``out`` from 0 up, dealt over tasks in slices."""
    slices = rows.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1, F.lit(SLICE).cast("long"))))
    last = F.least(F.col("__from") + SLICE, F.col(count)) - 1
    return slices.repartition(F.col("length"), F.col("__from")).withColumn(out, F.explode(F.sequence("__from", last))).drop("__from")


class Match(NamedTuple):
    """Bundles ``bundle`` to ``bundle + count - 1`` of ``length``, together ``size`` long, go to the sequences
    of ``gap`` from ``rank`` on; a new sequence has the full capacity as its gap and its own number as rank."""

    length: int
    bundle: int
    count: int
    gap: int
    rank: int
    size: int
    opened: bool


class Taken(NamedTuple):
    """Pieces ``first`` to ``stop - 1`` of ``length`` were dealt in a round, ``per`` to a bundle, from bundle ``bundle`` on."""

    length: int
    first: int
    stop: int
    per: int
    bundle: int


class Later:
    """Gaps as this round leaves them, by size. What a length is promised there waits for the next round."""

    def __init__(self, capacity: int):
        self.count = [0] * (capacity + 1)

    def add(self, gap: int, sequences: int) -> None:
        self.count[gap] += sequences

    def promise(self, length: int, waiting: int) -> int:
        """How many of ``waiting`` pieces fit: as many as it takes to each tightest gap in turn."""
        fitting = 0
        for gap in range(length, len(self.count)):
            while self.count[gap] and fitting < waiting:
                per = min(gap // length, waiting - fitting)
                used = min(self.count[gap], (waiting - fitting) // per)
                self.count[gap] -= used
                self.count[gap - per * length] += used
                fitting += used * per
        return fitting


def sweep(lengths: dict[int, tuple[int, int]], gaps: dict[int, int], capacity: int, opened: int) -> tuple[list[Match], list[Taken], int]:
    """One round over counts. ``lengths``: {length: (first piece not dealt, number of pieces)}; ``gaps``:
    {gap: sequences}; ``opened``: sequences so far. Also returns their number after the round."""
    order = sorted(gaps, reverse=True)
    stack: list[list[int]] = []  # [gap, next rank, sequences left], the tightest on top
    later = Later(capacity)
    matches, taken, pushed = [], [], 0
    for length in sorted(lengths, reverse=True):
        first, total = lengths[length]
        while pushed < len(order) and order[pushed] >= length:
            stack.append([order[pushed], 0, gaps[order[pushed]]])
            pushed += 1
        per = min(total - first, stack[-1][0] // length) if stack else 1
        bundles, dealt = (total - first) // per, 0
        while dealt < bundles and stack:
            gap, rank, free = stack[-1]
            count = min(bundles - dealt, free)
            matches.append(Match(length, dealt, count, gap, rank, per * length, False))
            later.add(gap - per * length, count)
            dealt += count
            stack[-1][1:] = [rank + count, free - count]
            if count == free:
                stack.pop()
        if dealt:
            taken.append(Taken(length, first, first + dealt * per, per, 0))
            first += dealt * per
        waiting = total - first
        if stack or not waiting:
            continue  # what is left of a bundle finds a gap in the next round
        waiting -= later.promise(length, waiting)
        if waiting:
            per = min(waiting, capacity // length)
            bundles = waiting // per
            matches.append(Match(length, dealt, bundles, capacity, opened, per * length, True))
            taken.append(Taken(length, first, first + bundles * per, per, dealt))
            later.add(capacity - per * length, bundles)
            opened += bundles
    return matches, taken, opened


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (any columns, ``length``) with ``sequence_id`` and ``offset``, the place in the sequence."""
    spark = pieces.sparkSession
    # Written with a position, so that no later retry numbers pieces otherwise.
    pieces = stored(pieces.withColumn("__at", F.monotonically_increasing_id()))
    counts = {r[0]: r[1] for r in pieces.groupBy("length").agg(F.count(F.lit(1))).collect()}  # at most ``capacity`` rows
    wrong = [n for n in counts if n is None or not 1 <= n <= capacity]
    if wrong:
        raise ValueError(f"lengths {wrong[:5]} are not within 1 to {capacity}")
    pieces = stored(numbered(pieces, "length", "__at", "__rank"))

    waiting = {length: (0, n) for length, n in counts.items()}
    gaps = spark.createDataFrame([], "sequence long, gap long, used long")
    gap_counts: dict[int, int] = {}
    opened, rounds, dealt, placed = 0, 0, [], []
    while waiting:
        matches, taken, total = sweep(waiting, gap_counts, capacity, opened)
        plan = spark.createDataFrame(matches, "length long, bundle long, count long, gap long, rank long, size long, opened boolean")
        sequences = numbered(gaps, "gap", "sequence", "__number")
        old = sequences.join(
            F.broadcast(plan.where("not opened").withColumnRenamed("gap", "to_gap")),  # fewer rows than twice the capacity
            (F.col("gap") == F.col("to_gap")) & (F.col("__number") >= F.col("rank")) & (F.col("__number") < F.col("rank") + F.col("count")), "left")
        old = old.select("sequence", "gap", "used", "length", (F.col("bundle") + F.col("__number") - F.col("rank")).alias("bundle"), "size")
        new = numbers(plan.where("opened"), "count", "__k").select(
            (F.col("rank") + F.col("__k")).alias("sequence"), "gap", F.lit(0).cast("long").alias("used"), "length",
            (F.col("bundle") + F.col("__k")).alias("bundle"), "size")
        touched = stored(old.unionByName(new))
        placed.append(touched.where("size is not null").select(
            F.lit(rounds).alias("round"), "length", "bundle", "sequence", F.col("used").alias("base")))
        size = F.coalesce("size", F.lit(0))
        gaps = touched.select("sequence", (F.col("gap") - size).alias("gap"), (F.col("used") + size).alias("used")).where("gap > 0")
        dealt += [(rounds, *t) for t in taken]
        for t in taken:
            if t.stop == waiting[t.length][1]:
                del waiting[t.length]
            else:
                waiting[t.length] = t.stop, waiting[t.length][1]
        if waiting:
            gaps = gaps.where(F.col("gap") >= min(waiting))  # the others are closed
            gap_counts = {r[0]: r[1] for r in gaps.groupBy("gap").agg(F.count(F.lit(1))).collect()}
        opened, rounds = total, rounds + 1

    table = spark.createDataFrame(dealt, "round int, length long, first long, stop long, per long, bundle long")
    columns = [c for c in pieces.columns if c not in ("__at", "__rank")]
    bundled = pieces.alias("p").join(
        F.broadcast(table).alias("t"),  # at most two rows a round and length
        (F.col("p.length") == F.col("t.length")) & (F.col("__rank") >= F.col("t.first")) & (F.col("__rank") < F.col("t.stop")), "left")
    inside = F.col("__rank") - F.col("t.first")
    bundled = bundled.select("p.*", F.col("t.round").alias("__round"), (F.col("t.bundle") + F.floor(inside / F.col("t.per"))).alias("__bundle"),
                             ((inside % F.col("t.per")) * F.col("p.length")).alias("__shift"))
    where = spark.createDataFrame([], "round int, length long, bundle long, sequence long, base long")
    for part in placed:
        where = where.unionByName(part)
    where = where.select(*[F.col(c).alias(f"__w_{c}") for c in where.columns])
    found = bundled.join(where, (F.col("__round") == F.col("__w_round")) & (F.col("length") == F.col("__w_length"))
                         & (F.col("__bundle") == F.col("__w_bundle")), "left")
    return found.select(*columns, F.col("__w_sequence").alias("sequence_id"), (F.col("__w_base") + F.col("__shift")).alias("offset"))


def pieces(docs: DataFrame, vocabulary: tokens.Vocabulary, doc_id: str = "doc_id", text: str = "text", end: int = 2, capacity: int = 1024) -> DataFrame:
    """``doc_id, piece, start, length, ids`` of every document: its ids with ``end`` behind them, cut into
    pieces of ``capacity`` only if longer, the first piece taking the rest. ``ids`` are little-endian
    32-bit numbers; a null text is an empty one."""
    cut = docs.select(F.col(doc_id).alias("doc_id"), tokens.pieces(F.col(text), vocabulary, end, capacity).alias("pieces"))
    rows = cut.select("doc_id", F.posexplode("pieces").alias("piece", "p"))
    return rows.select("doc_id", "piece", "p.start", "p.length", "p.ids")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the ids of every sequence (at most ``capacity`` of them) in their places.
    ``packed`` is what ``pack`` makes of ``pieces`` with their ids."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.reduce("parts", F.lit(b""), lambda got, p: F.concat(got, p["ids"])).alias("ids"))

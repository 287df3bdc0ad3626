"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 4 of 64 bits differ in at most 2 bits of some two of three
blocks (the three pairs of blocks see every differing bit twice, so 8 in all). Half of that radius is 1:
every fingerprint emits, for each pair of blocks, its 42 or 43 bits and all variants with one of them
flipped, 131 keys in all. The keys are shuffled; fingerprints that meet are verified on all 64 bits.
The ball over all 64 bits at once (2081 variants within 2 bits) is the second step, taken where more
than ``dense`` fingerprints meet at one key: two fingerprints that share such a variant differ in at
most 4 bits by the triangle inequality, so a star per variant links them and no pairs are compared.

Groups of links are merged by alternating large and small stars. Only distinct fingerprints take part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm import bloom, textbytes
from dayledger.llm.common import stored

BLOCKS = ((0, 21), (21, 42), (42, 64))
RADIUS = 4
#: Up to so many fingerprints at one key are compared directly.
DENSE = 2048
#: Rows of the shuffled key table a task sorts, about.
KEYS_PER_TASK = 2_000_000
#: Near copies share this part of their shingles of so many words.
SHARED, SHINGLE = 0.8, 5
#: Texts of a group that are settled at once, and others of the group that a task compares with them, about.
HEADS, SLICE = 64, 512


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def block_keys() -> list[tuple[int, int]]:
    """(mask, flip) of every key: the fingerprint under the mask, xor the flip. The block left out
    carries the number of the pair, so keys of different pairs never meet."""
    out = []
    for pair, (low, high) in enumerate(BLOCKS):
        left_out = sum(1 << b for b in range(low, high))
        mask, tag = ~left_out & (1 << 64) - 1, pair << low
        out += [(mask, tag)] + [(mask, tag ^ 1 << b) for b in range(64) if not low <= b < high]
    return [(signed(m), signed(f)) for m, f in out]


def ball() -> list[int]:
    """All xor patterns of at most two bits."""
    bits = [1 << b for b in range(64)]
    return [signed(x) for x in [0, *bits, *(a | b for i, a in enumerate(bits) for b in bits[:i])]]


def fingerprint(raw: bytes, width: int) -> int:
    """Majority of the XXH64 (seed 42) bits of all shingles of ``width`` words, repeats included."""
    parts = raw.lower().split()
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(parts) < width:
        return digest(b" ".join(parts), 42)
    counts, n = np.zeros(64, np.int64), len(parts) - width + 1
    for start in range(0, n, 1 << 15):
        piece = parts[start:min(start + (1 << 15), n) + width - 1]
        hashes = np.array([digest(b" ".join(s), 42) for s in zip(*(piece[i:] for i in range(width)))], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(width: int):
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint((t or "").encode(), width) for t in texts], dtype=np.uint64).view(np.int64))
    return run


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))


def meet(keys: np.ndarray, prints: np.ndarray, dense: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints that share a key, and the fingerprints at keys with over ``dense``.
    A key's links are those that hold its linked fingerprints together, not all its pairs."""
    order = np.lexsort((prints, keys))
    keys, prints = keys[order], prints[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    links, crowd = [np.zeros((0, 2), np.int64)], [np.zeros(0, np.int64)]
    for size in np.unique(sizes[sizes > 1]):
        runs = prints[starts[sizes == size][:, None] + np.arange(size)]
        if size > dense:
            crowd.append(runs.ravel())
        elif size <= 8:
            for i in range(size):
                for j in range(i + 1, size):
                    near = popcount(runs[:, i] ^ runs[:, j]) <= RADIUS
                    links.append(runs[near][:, [i, j]])
        else:
            links += [spanning(run) for run in runs]
    return np.unique(np.concatenate(links), axis=0), np.unique(np.concatenate(crowd))


def spanning(run: np.ndarray) -> np.ndarray:
    """Links that join what is joined by any links of the run: breadth first, each reached once."""
    found, rest = [], run
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            hit = np.flatnonzero(popcount(front[0] ^ rest) <= RADIUS)
            reached = rest[hit]
            if len(reached):
                found.append(np.stack([np.full(len(reached), front[0]), reached], axis=1))
                rest = np.delete(rest, hit)
            front = np.concatenate([front[1:], reached])
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def whole(batches: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
    parts = [b for b in batches if len(b)]
    return pd.concat(parts, ignore_index=True) if parts else None


def links(prints: DataFrame, dense: int = DENSE) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp`` whose transitive closure is that of all
    pairs within the radius. Every key's fingerprints meet in one task, which keeps 16 bytes of each."""
    n = prints.count()

    def by_key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = whole(batches)
        if rows is not None:
            found, crowd = meet(rows["key"].to_numpy(), rows["fp"].to_numpy(), dense)
            yield pd.DataFrame({"a": np.r_[found[:, 0], crowd], "b": np.r_[found[:, 1], crowd], "dense": np.r_[np.zeros(len(found), bool), np.ones(len(crowd), bool)]})

    made = F.explode(F.array(*[F.struct(F.lit(m).alias("mask"), F.lit(f).alias("flip")) for m, f in block_keys()])).alias("k")
    keyed = prints.select("fp", made).select(F.col("fp").bitwiseAND(F.col("k.mask")).bitwiseXOR(F.col("k.flip")).alias("key"), "fp")
    met = stored(keyed.repartition(max(1, n * 131 // KEYS_PER_TASK, shuffle_width(prints)), "key").mapInPandas(by_key, "a long, b long, dense boolean"))

    def by_variant(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = whole(batches)
        if rows is not None:
            order = np.lexsort((rows["fp"], rows["key"]))
            keys, fps = rows["key"].to_numpy()[order], rows["fp"].to_numpy()[order]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            heads = fps[np.repeat(first, np.diff(np.r_[first, len(keys)]))]
            yield pd.DataFrame(np.unique(np.stack([fps, heads], axis=1)[fps != heads], axis=0), columns=["a", "b"])

    crowded = stored(met.filter("dense").select(F.col("a").alias("fp")).distinct())
    n_crowded = crowded.count()
    stars = met.filter("NOT dense").select("a", "b")
    if n_crowded:
        variants = crowded.select("fp", F.explode(F.array(*[F.lit(x) for x in ball()])).alias("x")).select(
            F.col("fp").bitwiseXOR(F.col("x")).alias("key"), "fp")
        stars = stars.unionByName(variants.repartition(max(1, n_crowded * 2081 // KEYS_PER_TASK, shuffle_width(prints)), "key")
                                  .mapInPandas(by_variant, "a long, b long"))
    return stars.distinct()


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame) -> DataFrame:
    """``a, root`` of every node of ``edges`` (a, b) but the roots: the smallest node reachable.

    Alternates two contractions until nothing changes: every node links its larger neighbours to its
    smallest, then its smaller ones. Minima are combined before the shuffle; each round is written to
    the shared folder, so it is neither planned nor run again.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        moved = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            return now.select("a", F.col("b").alias("root"))
        before = state


def grouped(docs: DataFrame, width: int = 4, text: str = "text", doc_id: str = "doc_id", dense: int = DENSE) -> DataFrame:
    """``doc_id, fp, component_id`` of every row: the smallest id among the documents reachable.

    Defined cases: a null text is empty; texts without words have fingerprint 0 and are linked like any
    other; fewer words than ``width`` form one shingle; null ids are never a component's id unless it
    has no other; repeated rows stay; empty input gives no rows. Other columns are not read.
    """
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), fingerprints(width)(F.col(text)).alias("fp")))
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(prints.select("fp"), dense))
    classed = prints.join(roots, F.col("fp") == F.col("a"), "left").withColumn("root", F.coalesce("root", "fp"))
    ids = classed.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(stored(classed.join(ids, "root").select("fp", "component_id")), "fp").select("doc_id", "fp", "component_id")


def word_prints(texts: list[str | None]) -> np.ndarray:
    """Two independent fingerprints of each text, as rows: SimHash of its words, lower case, each weighing
    the root of its count. A text without words has 0 and 0."""
    words = textbytes.split(texts, ~textbytes.SPACE)
    out = np.zeros((len(texts), 2), np.int64)
    if not len(words.hash):
        return out
    order = np.lexsort((words.hash, words.doc))
    doc, hash_ = words.doc[order], words.hash[order]
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (hash_[1:] != hash_[:-1])])
    weight = np.sqrt(np.diff(np.r_[new, len(doc)])).astype(np.float32)[:, None]
    doc, hash_ = doc[new], hash_[new]
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    for k in range(2):
        bits = np.unpackbits(textbytes.mix(hash_ + np.uint64(k)).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total = np.add.reduceat(np.where(bits, weight, -weight), first, axis=0)
        out[doc[first], k] = np.packbits(total > 0, axis=1, bitorder="little").view("<i8").ravel()
    return out


def classes(texts: DataFrame, column: str, root: str, dense: int) -> DataFrame:
    """``column, root`` of every distinct fingerprint."""
    prints = stored(texts.select(F.col(column).alias("fp")).distinct())
    roots = components(links(prints, dense))
    return prints.join(roots, F.col("fp") == F.col("a"), "left").select(F.col("fp").alias(column), F.coalesce("root", "fp").alias(root))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text, lower case; fewer words are one shingle, none no shingle."""
    words = textbytes.split(texts, ~textbytes.SPACE)
    gram, at = textbytes.grams(words, SHINGLE)
    edge = np.searchsorted(words.doc[at], np.arange(len(texts) + 1))
    out = [np.unique(gram[a:b].view(np.int64)) for a, b in zip(edge[:-1], edge[1:])]
    for k in np.flatnonzero((np.diff(words.first) > 0) & (np.diff(words.first) < SHINGLE)):
        short = np.zeros(1, np.uint64)
        for word in words.hash[words.first[k]:words.first[k + 1]]:
            short = textbytes.mix(short + np.uint64(1)) + word
        out[k] = short.view(np.int64)
    return out


def near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of shingles share enough; texts without words are copies of each other."""
    if min(len(a), len(b)) < SHARED * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= SHARED * (len(a) + len(b) - both)


def settled(rest: DataFrame) -> DataFrame:
    """``text_key, keeper`` of ``text_key, group, first, grams``: in the order of ``first``, a text stays unless it
    is near one of its group that stays; its keeper is the row of the first such text, or its own.

    The first ``HEADS`` texts of every group are settled among themselves, then the others of the group
    are compared with those of them that stay, in slices; what is near none goes to the next round.
    """
    def elect(rows: pd.DataFrame) -> pd.DataFrame:
        rows, stay, keeper = rows.sort_values("place", ignore_index=True), [], []
        for k, grams in enumerate(rows["grams"]):
            found = next((h for h in stay if near(grams, rows["grams"][h])), k)
            keeper.append(rows["row"][found])
            if found == k:
                stay.append(k)
        return rows.assign(keeper=keeper)[["group", "text_key", "row", "place", "keeper", "grams"]]

    def compare(heads: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        heads = heads.sort_values("place")
        found = [next((row for row, grams in zip(heads["row"], heads["grams"]) if near(mine, grams)), None) for mine in others["grams"]]
        return pd.DataFrame({"text_key": others["text_key"], "keeper": pd.array(found, dtype="Int64")})

    done = []
    while True:
        place = F.row_number().over(Window.partitionBy("group").orderBy("first"))
        ranked = rest.withColumn("place", place).filter(F.col("place") <= HEADS).select("group", "text_key", "first.row", "place", "grams")
        heads = stored(ranked.groupBy("group").applyInPandas(
            elect, "group string, text_key long, row long, place int, keeper long, grams array<long>"))
        done.append(heads.select("text_key", "keeper"))
        others = stored(rest.join(heads.select("text_key"), "text_key", "left_anti"))
        if others.isEmpty():
            break
        slices = stored(others.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / SLICE).alias("slices")))
        left = heads.filter("keeper = row").join(slices, "group").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
        right = others.join(slices, "group").withColumn("slice", F.pmod(F.xxhash64("text_key"), "slices"))
        met = stored(left.select("group", "slice", "row", "place", "grams").groupBy("group", "slice").cogroup(
            right.select("group", "slice", "text_key", "grams").groupBy("group", "slice")).applyInPandas(compare, "text_key long, keeper long"))
        done.append(met.filter("keeper IS NOT NULL"))
        rest = stored(others.join(met.filter("keeper IS NULL").select("text_key"), "text_key", "left_semi"))
        if rest.isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", dense: int = DENSE) -> DataFrame:
    """``docs`` without near copies, all columns kept: in the order of ids (nulls last) a document stays unless
    it shares ``SHARED`` of its shingles with one that stays. Of rows equal in all columns one stays.

    For near copies as shingles see them: texts that share 0.8 or more of their 5-word shingles differ in
    about 2 % of their words, which turns few bits of a fingerprint of words, but ten of one of shingles.
    A text has two such fingerprints; texts that are near by either are linked. These groups are candidates
    only: within them the shingles themselves decide.
    """
    @F.pandas_udf("struct<p: long, q: long>")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            body = list(batch)
            for part in list(textbytes.portions(body)) or [slice(0)]:
                yield pd.DataFrame(word_prints(body[part]), columns=["p", "q"])

    row, key = F.xxhash64(*docs.columns), F.xxhash64(text)
    rows = docs.select(F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), row.alias("row")).alias("first"),
                       key.alias("text_key"), prints(F.col(text)).alias("f"))
    # Copies of a text arrive as one row per task; from here on there is one row per text.
    texts = stored(rows.groupBy("text_key", "f.p", "f.q").agg(F.count(F.lit(1)).alias("rows"), F.min("first").alias("first")))
    pairs = stored(texts.select("p", "q").distinct().join(classes(texts, "p", "by_p", dense), "p").join(classes(texts, "q", "by_q", dense), "q"))
    # A class by one fingerprint and a class by the other that share a text are one group.
    node = [F.concat(F.lit(side), F.hex(column)) for side, column in (("p", "by_p"), ("q", "by_q"))]
    merged = components(pairs.select(node[0].alias("a"), node[1].alias("b")))
    grouped_ = pairs.join(merged, node[0] == F.col("a"), "left").select("p", "q", F.coalesce("root", node[0]).alias("group"))
    placed = texts.join(stored(grouped_), ["p", "q"])
    placed = stored(placed.select("text_key", "rows", "first", "group"))
    several = placed.groupBy("group").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    asked = stored(placed.join(several, "group", "left").select("text_key", "rows", "first", "group", F.col("texts").isNotNull().alias("several")))
    copies = asked.filter("NOT several AND rows > 1").select("text_key", F.col("first.row").alias("keeper"))

    @F.pandas_udf("array<long>")
    def shingled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            body = list(batch)
            for part in list(textbytes.portions(body)) or [slice(0)]:  # shingles take more room than their texts
                yield pd.Series(shingle_sets(body[part]), dtype=object)

    # The text of a candidate is read from the one row that stands for it.
    wanted = stored(asked.filter("several").select("text_key", "group", "first", F.col("first.row").alias("row_key")))
    rows_asked = bloom.build(wanted.select("row_key"), wanted.count(), repeated_only=False)
    bodies = docs.select(row.alias("row_key"), F.col(text).alias("body"))
    bodies = bodies.filter(bloom.might_hold(docs, rows_asked, F.col("row_key"))).join(wanted.select("row_key"), "row_key", "left_semi").dropDuplicates(["row_key"])
    candidates = stored(wanted.join(bodies.select("row_key", shingled("body").alias("grams")), "row_key").drop("row_key"))
    members = stored(settled(candidates).unionByName(copies).select(F.col("text_key").alias("__text_key"), F.col("keeper").alias("__keeper")))

    # Only rows whose text may be in a group of several meet the members; the rest pass straight through.
    filter_ = bloom.build(members.select("__text_key"), members.count(), repeated_only=False)
    packed = docs.select(F.struct(*docs.columns).alias("__row"), row.alias("__row_key"), key.alias("__key"))
    packed = packed.withColumn("__maybe", bloom.might_hold(docs, filter_, F.col("__key")))
    judged = packed.filter("__maybe").join(members, F.col("__key") == F.col("__text_key"), "left")
    alone = packed.filter("NOT __maybe").select("__row.*").unionByName(judged.filter("__keeper IS NULL").select("__row.*"))
    return alone.unionByName(judged.filter("__keeper = __row_key").select("__row.*").dropDuplicates())

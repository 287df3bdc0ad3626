"""Mixing, sharding and exact dedup on small tables, against plain Python."""

import collections
import hashlib
import re
import zlib

import pytest
from edge_cases import ODD, documents  # noqa: F401

from dayledger.llm import bloom, exact_dedup, mixing, sharding


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def filled(sizes, weights=(5, 2, 1), share=1.5, repeats=2):
    """Targets by pouring: give by weight, cap, pour the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, out, full = share * sum(sizes.values()), {}, set()
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        level = left / total if open_ else 0
        over = [s for s in open_ if level * weight[s] >= repeats * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            full.add(s)
            out[s] = repeats * sizes[s]
            left -= out[s]


def test_targets_and_taken(documents):
    rows = [(i, "w " * (i % 17 + 1), f"s{i % 7}" if i % 11 else None) for i in range(400)] + ODD
    got = mixing.taken(documents(rows)).collect()
    assert len(got) == len(rows)
    sizes, taken = collections.Counter(), collections.Counter()
    for r in rows:
        sizes[r[2]] += n_words(r[1])
    want = filled(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, t in taken.items():
        assert abs(t - want[s]) < 3  # rounding of shared entries
    assert sorted(map(tuple, mixing.taken(documents(rows)).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_stream_is_fair_at_every_moment(documents):
    rows = [(i, "w " * (i % 9 + 1), "a" if i < 300 else "b" if i < 380 else "c") for i in range(400)]
    stream = sorted(mixing.mix(mixing.measured(documents(rows))).collect(), key=lambda r: r.stream_start)
    at, got = 0, collections.Counter()
    target = {r.source: r.target for r in stream}
    for r in stream:
        assert r.stream_start == at
        at += r.words
        got[r.source] += r.words
        share = [got[s] / target[s] for s in target]
        assert max(share) - min(share) < 0.2  # a few documents of 9 words
    assert at <= 1.5 * sum(n_words(r[1]) for r in rows)


def test_mix_keeps_columns_and_empty(spark, documents):
    docs = documents([(i, "w " * 10, "a") for i in range(20)] + [(99, None, "z")])
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    counts = collections.Counter(r.doc_id for r in out.collect())
    assert counts[99] == 1 and max(counts.values()) <= 2 and sum(counts.values()) == 31
    assert mixing.taken(documents([])).collect() == [] and mixing.apply_mix(documents([])).collect() == []


@pytest.mark.parametrize("share", [0.3, 1.0, 1.5, 1.97])
def test_mix_repeats_what_is_taken_and_moves_no_text(spark, documents, share):
    rows = [(i, "w " * (i % 17 + 1), f"s{i % 7}" if i % 11 else None) for i in range(300)] + [(5, "w " * 6, "s5")] * 3 + ODD
    docs = documents(rows)
    times = {}
    for r in mixing.taken(docs, share=share).collect():
        n = 1 if r.size == 0 else (2 * r.taken + r.size) // (2 * r.size)
        assert times.setdefault((r.doc_id, r.source, r.size), n) == n
    out = mixing.apply_mix(docs, share=share)
    want = collections.Counter({k: times[k] * n for k, n in collections.Counter((d, s, n_words(t)) for d, t, s in [(r + (None,) * 3)[:3] for r in rows]).items()})
    assert collections.Counter((r.doc_id, r.source, n_words(r.text)) for r in out.collect()) == +want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_shards_are_even_and_gapless(documents):
    rows = [(i, f"text {i} " * (i % 40 + 1)) for i in range(1500)] + [(9000 + i, "the same long text " * 20) for i in range(700)] + ODD
    got = sharding.shard(documents(rows)).collect()
    want = collections.Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    size, slots, homes = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for r in got:
        assert 0 <= r.shard < 24
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        homes[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    biggest, mean = max(r.size for r in got), sum(size.values()) / 24
    assert all(abs(v - mean) < max(biggest, 0.1 * mean) for v in size.values())
    same = zlib.crc32(("the same long text " * 20).encode())
    assert len(homes[same]) > 1  # a text over a shard's share is split
    assert all(len(h) == 1 for c, h in homes.items() if c != same)
    assert sharding.shard(documents([])).collect() == []


def test_exact_groups(documents):
    rows = [(i, f"T{i % 50} Ü") for i in range(300)] + [(1000 + i, f"only {i}") for i in range(300)] + [(7, "t7 Ü")] + ODD
    got = exact_dedup.exact_groups(documents(rows)).collect()
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    groups = collections.defaultdict(list)
    for d, t, *_ in rows:
        groups[hashlib.sha256(low(t).encode()).hexdigest()].append(d)
    assert collections.Counter((r.doc_id, r.text_sha256) for r in got) == collections.Counter((d, h) for h, ds in groups.items() for d in ds)
    kept = collections.Counter()
    for r in got:
        ids = groups[r.text_sha256]
        best = max((i for i in ids if i is not None), default=None)
        assert r.keep_id == best and r.group_size == len(ids)
        if r.kept:
            kept[r.text_sha256] += 1
            assert r.doc_id == best
    assert set(kept.values()) == {1} and set(kept) == set(groups)
    assert exact_dedup.exact_groups(documents([])).collect() == []


def test_full_filter_only_lets_more_through(documents, monkeypatch):
    monkeypatch.setattr(bloom, "bits_for", lambda items: 1 << 10)
    rows = [(i, f"{i % 900}") for i in range(1000)]
    got = exact_dedup.exact_groups(documents(rows)).collect()
    assert sum(r.kept for r in got) == 900 and sorted(r.group_size for r in got) == [1] * 800 + [2] * 200


def skewed(spark):
    """Settings under which adaptive execution splits partitions of a few kilobytes and broadcasts nothing by itself."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "24"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    return lambda: [spark.conf.unset(k) if v is None else spark.conf.set(k, v) for k, v in before.items()]


def test_a_text_of_half_of_all_rows_is_split_in_the_join(spark):
    from pyspark.sql import functions as F
    docs = spark.range(20_000).repartition(8).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "one text").otherwise(F.concat(F.lit("t"), F.floor(F.col("id") / 4))).alias("text"))
    undo = skewed(spark)
    try:
        out = exact_dedup.exact_groups(docs)
        got = out.groupBy("keep_id").count().collect()
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        undo()
    assert len(rows) == 20_000 and max(r["count"] for r in got) == 10_000
    assert sum(r.kept for r in rows) == 1 + 5_000
    assert "skew=true" in plan


def test_a_range_of_one_text_or_one_row_is_split_before_any_shuffle(documents):
    text = "the same long text " * 20
    rows = [(i, f"text {i} " * (i % 40 + 1)) for i in range(1500)] + [(9000 + i, text) for i in range(700)] + [(5, text)] * 1400
    out = sharding.shard(documents(rows))
    got = out.collect()
    parts = collections.Counter((r.range, r.sub, r.copy) for r in got if r.text_crc32 == zlib.crc32(text.encode()))
    whole = sum(r.size for r in got)
    limit = 2 * whole / (24 * sharding.RANGES_PER_SHARD)
    # Twice as many parts as would do: none holds more than twice the limit, chance included.
    assert max(parts.values()) * (len(text) + 8) <= 2 * limit + 8 * len(text)
    size = collections.Counter()
    for r in got:
        size[r.shard] += r.size
    assert all(abs(v - whole / 24) < 0.1 * whole / 24 for v in size.values())
    same = [r for r in got if r.doc_id == 5 and r.size > 300]
    assert len(same) >= 1400 and len({(r.shard, r.slot) for r in same}) == len(same)

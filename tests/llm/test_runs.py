"""Periodic runs against plain counting of agreeing words."""

import random
import re
import zlib

import pytest
from edge_cases import ODD, documents  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dayledger.llm import queries, runs


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(words, min_length=24, repeats=3):
    """Every maximal stretch of agreeing words at each distance, less those that repeat with a shorter one."""
    n, out = len(words), []
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, repeats * q):
                s = words[i:i + length]
                if not any(s[p:] == s[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1 if j > i else i + 1
    return sorted(out)


def kept(words, found):
    gone = {k for start, length, period in found for k in range(start + period, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


@given(st.lists(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=8), st.integers(1, 9)), max_size=5), min_size=1, max_size=4),
       st.sampled_from([(24, 3), (6, 2), (10, 4), (1, 2)]))
@settings(max_examples=300, deadline=None)
def test_every_run_and_no_other(texts, bounds):
    texts = [[w.encode() for unit, times in text for w in unit * times] for text in texts]
    assert runs.found_in(texts, *bounds) == [brute(t, *bounds) for t in texts]


def test_one_word_a_hundred_thousand_times_is_one_run():
    assert runs.found_in([[b"a"] * 100_000, [b"x", b"y"] * 20_000 + [b"x"]], 24, 3) == [[(0, 100_000, 1)], [(0, 40_001, 2)]]


def test_many_copies_of_a_line_with_other_words_between():
    line = [b"%d" % k for k in range(20)]
    text = [w for k in range(3_000) for w in [b"u%d" % k, *line]]
    assert runs.found_in([text], 24, 3) == [[]]


def test_edge_cases(documents):
    rows = ODD + [(20, "a b " * 14, "s"), (21, "x\x1cy z " * 24, None), (22, "p q r s " * 6 + "p", "s")]
    got = runs.periodic_runs(documents(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.collapsed in {kept(words_of(t), brute(words_of(t)) if len(words_of(t)) < 9_000 else [(0, 30_000, 1)]) for d, t, *_ in rows if d == r.doc_id}
    by_id = {r.doc_id: r for r in got}
    assert [tuple(x) for x in by_id[6].runs] == [(0, 30_000, 1)] and by_id[6].collapsed == "word"
    assert by_id[1].n_words == by_id[2].n_words == by_id[3].n_words == 0 and by_id[1].collapsed == ""
    assert runs.periodic_runs(documents([])).collect() == []


def test_greatest_exponent_is_compared_exactly(spark):
    rows = spark.createDataFrame([([(5, 30, 7), (9, 60, 14), (40, 29, 7)],), ([],), ([(3, 90, 21), (1, 24, 8), (2, 3_000_001, 700_000)],)],
                                 "runs array<struct<start: long, length: long, period: long>>")
    got = [r[0] and tuple(r[0]) for r in rows.select(runs.strongest(F.col("runs"))).collect()]
    assert got == [(5, 30, 7), None, (2, 3_000_001, 700_000)]


def planted(doc_id, text):
    words, h = words_of(text), zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize("seed", [1])
def test_query_against_brute_force(spark, documents, tmp_path, seed):
    import hashlib

    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.choice([0, 3, 30, 200, 400]))), "s") for i in range(300)]
    rows += [(i, " \t" + t, s) for i, t, s in rows[:40]] + [(1000, None, "s"), (1001, "", "s")]
    documents(rows, extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for i, t, _ in rows:
        words = planted(i, t)
        found = brute(words)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        want.append((i, len(found), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
                     sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(kept(words, found))))
    got = [tuple(r) for r in queries.op11_runs(spark, str(tmp_path)).collect()]
    assert sum(r[1] for r in got) > 10
    assert sorted(got, key=str) == sorted(want, key=str)

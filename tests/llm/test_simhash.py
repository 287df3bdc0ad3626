"""SimHash links and groups against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from edge_cases import ODD, documents  # noqa: F401

from dayledger.llm import simhash


def plain_print(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=4):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if bin((a ^ prints[j]) & (1 << 64) - 1).count("1") <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_fingerprints(documents):
    got = {(r.doc_id, r.fp) for r in simhash.grouped(documents(ODD)).collect()}
    assert got == {(d, simhash.signed(plain_print(t, 4))) for d, t, *_ in ODD}


@pytest.mark.parametrize("dense", [2048, 40, 2])
def test_links_lose_no_group(spark, dense):
    rng = random.Random(dense)
    prints = [rng.getrandbits(64) for _ in range(40)] + [0, 3]
    for base in prints[:12]:  # chains and clusters at all distances up to 9
        for _ in range(14):
            flipped = base
            for bit in rng.sample(range(64), rng.randint(1, 9)):
                flipped ^= 1 << bit
            prints.append(flipped)
    cluster = prints[0]
    prints += [cluster ^ 1 << i ^ 1 << j for i in range(12) for j in range(i)]
    prints = sorted({simhash.signed(p) for p in prints})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = simhash.links(df, dense)
    for r in edges.collect():
        assert bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 4
    roots = {r.a: r.root for r in simhash.components(edges).collect()}
    found = [roots.get(p, p) for p in prints]
    want = groups(prints)
    assert len(set(zip(found, want))) == len(set(found)) == len(set(want))
    for p, r in zip(prints, found):
        assert r == min(q for q, s in zip(prints, found) if s == r)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(500, 400), (7, 7)], "a long, b long")
    assert {r.a: r.root for r in simhash.components(edges).collect()} == {i: 0 for i in range(1, 201)} | {500: 400}


def test_component_ids(documents):
    rows = [(10, "a b c d e f"), (3, "A b  c d e f"), (None, "a b c d e f"), (8, None), (2, " "), (9, "quite another text than these")]
    got = {r.doc_id: r.component_id for r in simhash.grouped(documents(rows)).collect()}
    assert got == {10: 3, 3: 3, None: 3, 8: 2, 2: 2, 9: 9}
    assert simhash.grouped(documents([])).collect() == []


def test_popcount():
    assert list(simhash.popcount(np.array([0, -1, 5], dtype=np.int64))) == [0, 64, 2]

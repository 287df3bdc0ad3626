"""Decontamination: planted passages, edited ones, and alignment against the full table."""

import random

import numpy as np
from edge_cases import ODD, documents  # noqa: F401

from dayledger.llm import decontaminate as dc


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def edited(rng, text, share):
    words = text.split()
    for k in range(len(words)):
        r = rng.random()
        if r < share / 3:
            words[k] = "edited"
        elif r < share * 2 / 3:
            words[k] += " inserted"
        elif r < share:
            words[k] = ""
    return " ".join(words)


def test_finds_planted_and_leaves_the_rest(spark, documents):
    rng = random.Random(5)
    items = [(i, sentence(rng, rng.randint(20, 60))) for i in range(12)] + [(50, "only two"), (51, None), (52, ""), (53, "a quite short item")]
    docs, want = [], set()
    for i in range(200):
        text = sentence(rng, rng.randint(30, 200))
        if i % 5 == 0:
            item = rng.randrange(12)
            share = rng.choice([0, 0, 0.1, 0.2])
            text = f"{text}\n{edited(rng, items[item][1], share).upper()}! {sentence(rng, 30)}"
            want.add((i, item))
        docs.append((i, text))
    docs += [(300 + i, f"shared lead {items[0][1]} tail {i}") for i in range(300)]  # one item in most documents
    want |= {(300 + i, 0) for i in range(300)} | {(900, 50), (901, 53)}
    docs += [(900, "here only two words match"), (901, "this is a quite short item indeed")]
    docs += [(d and d + 5000, t, s) for d, t, s in ODD]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = dc.contaminated(documents(docs), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(0.5 <= r.score <= 1 for r in got)
    left = dc.clean(documents(docs), benchmark)
    assert left.columns == documents(docs).columns
    assert sorted(str(r.doc_id) for r in left.select("doc_id").collect()) == sorted(str(d) for d, *_ in docs if d not in {w[0] for w in want})


def test_blocks_give_the_same(spark, documents, monkeypatch):
    rng = random.Random(6)
    items = spark.createDataFrame([(i, sentence(rng, 30)) for i in range(20)], "item_id long, text string")
    texts = [r.text for r in items.collect()]
    docs = documents([(i, sentence(rng, 20) + " " + texts[i % 20] + " " + sentence(rng, 9)) for i in range(60)])
    whole = sorted(map(tuple, dc.contaminated(docs, items).collect()))
    monkeypatch.setattr(dc, "BLOCK_GRAMS", 300)
    assert sorted(map(tuple, dc.contaminated(docs, items).collect())) == whole and len(whole) == 60


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "some words of an item")], "item_id long, text string")
    assert dc.contaminated(documents([]), items).collect() == []
    assert dc.contaminated(documents(ODD), items.filter("false")).collect() == []
    assert dc.clean(documents(ODD), items.filter("false")).count() == len(ODD)


def test_alignment_is_the_full_table():
    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = rng.integers(0, 5, rng.integers(0, 14)), rng.integers(0, 5, rng.integers(0, 9))
        table = np.zeros((len(b) + 1, len(a) + 1), int)
        for i in range(1, len(b) + 1):
            for j in range(1, len(a) + 1):
                table[i, j] = max(0, table[i - 1, j - 1] + (dc.MATCH if a[j - 1] == b[i - 1] else dc.MISMATCH), table[i - 1, j] + dc.GAP, table[i, j - 1] + dc.GAP)
        score, start, stop = dc.align(a, b)
        assert score == table.max() and (score == 0 or start < stop <= len(a))

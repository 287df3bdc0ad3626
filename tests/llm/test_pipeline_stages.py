"""The pipeline's stages against brute force, on small tables written like the given ones."""

import collections
import random

import pytest

import corpus_pipeline
from dayledger.llm import quality, simhash
from edge_cases import documents  # noqa: F401
from test_models import made_up
from test_simhash import groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    from pyspark.sql import functions as F
    path = tmp_path_factory.mktemp("tables")
    docs, labels = made_up(300)
    rng = random.Random(1)
    item = " ".join("".join(rng.choice("klmnop") for _ in range(5)) for _ in range(30))
    docs += [(1000 + i, docs[i][1], "s0") for i in range(40)] + [(2000 + i, f"{docs[i][1]} {item}", "s1") for i in range(30)] + [(3000, None, None), (3001, "", "s2")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    df.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars")).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def joined(first, second):
    """Groups of a table that is grouped in two ways."""
    names = list(range(len(first)))
    for labels in (first, second) * len(first):
        least = {}
        for k, label in enumerate(labels):
            least[label] = min(least.get(label, names[k]), names[k])
        after = [least[label] for label in labels]
        if after == names and labels is second:
            break
        names = after
    return names


def rows_of(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "simhash near-dedup", "benchmark decontamination", "mixing to target weights", "sharding"]
    first, second, third, fourth, last = stages.values()

    good = first(spark, docs, folder)
    assert good.columns == COLUMNS
    scores = {r.doc_id: r.score for r in quality.score(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    assert rows_of(good) == collections.Counter({k: n for k, n in rows_of(docs).items() if scores[k[0]] >= 0.5})

    one = second(spark, good, folder)
    data = sorted(good.collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    prints = simhash.word_prints([r.text for r in data])
    of = joined(groups(prints[:, 0].tolist()), groups(prints[:, 1].tolist()))
    seen: set = set()
    want = [r for r, g in zip(data, of) if not (g in seen or seen.add(g))]
    assert rows_of(one) == collections.Counter(tuple(r) for r in want)

    clean = third(spark, one, folder)
    assert clean.columns == COLUMNS and 0 < one.count() - clean.count()
    assert rows_of(clean) == collections.Counter({k: n for k, n in rows_of(one).items() if k[0] is None or not 2000 <= k[0] < 2030})

    mixed = fourth(spark, clean, folder)
    assert mixed.columns == COLUMNS and set(rows_of(mixed)) <= set(rows_of(clean)) and max(rows_of(mixed).values()) <= 2
    words = lambda df: sum(len((r.text or "").split()) for r in df.collect())
    assert words(mixed) == pytest.approx(1.5 * words(clean), rel=0.1)

    shards = last(spark, mixed, folder)
    assert collections.Counter(r.doc_id for r in shards.collect()) == collections.Counter(r.doc_id for r in mixed.collect())


def test_run_is_the_chain_of_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert rows_of(corpus_pipeline.run(spark, folder)) == rows_of(docs)


def test_stages_take_empty_and_repeated_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).collect() == [], name
    twice = docs.unionByName(docs)
    kept = dict(corpus_pipeline.STAGES)["simhash near-dedup"](spark, twice, folder)
    assert rows_of(kept) == rows_of(dict(corpus_pipeline.STAGES)["simhash near-dedup"](spark, docs, folder))


def test_near_copies_go_and_others_stay(spark, documents):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(150, 400))) for _ in range(60)]
    docs = [(i, t) for i, t in enumerate(texts)]
    for i in range(0, 60, 2):
        words = texts[i].split()
        for k in rng.sample(range(len(words)), max(1, len(words) // 70)):
            words[k] = "changed"
        docs.append((1000 + i, " ".join(words)))
        docs.append((2000 + i, texts[i]))
    left = {r.doc_id for r in simhash.keep_one(documents(docs)).collect()}
    assert set(range(60)) <= left
    assert not left & set(range(2000, 2060)) and len(left & set(range(1000, 1060))) <= 2


def test_word_prints():
    import numpy as np
    from dayledger.llm import textbytes
    texts = ["a b a", "B a A", "", None, "one two  three\nfour", "a b a"]
    got = simhash.word_prints(texts)
    assert got[0].tolist() == got[1].tolist() == got[5].tolist() and not got[2].any() and not got[3].any()
    hashes = textbytes.split(["a b"], ~textbytes.SPACE).hash
    bits = [[1 if int(textbytes.mix(np.array([h]) + np.uint64(1))[0]) >> k & 1 else -1 for k in range(64)] for h in hashes]
    want = sum(1 << k for k in range(64) if 2 ** 0.5 * bits[0][k] + bits[1][k] > 0)
    assert got[0][1] == simhash.signed(want)


def five_word_jaccard(a, b):
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


@pytest.mark.parametrize("heads", [64, 2])
def test_only_texts_that_share_shingles_go(spark, documents, heads, monkeypatch):
    """Shuffled texts have equal fingerprints of words; a chain of edits drifts away from its start."""
    monkeypatch.setattr(simhash, "HEADS", heads)
    monkeypatch.setattr(simhash, "SLICE", 3)
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefghijklm") for _ in range(6)) for _ in range(200)]
    texts = [" ".join(rng.sample(base, len(base))) for _ in range(6)]
    words = list(base)
    for k in range(8):
        words[20 * k], words[20 * k + 1] = words[20 * k + 1], words[20 * k]
        texts.append(" ".join(words))
        texts.append(" ".join(words).upper())
    stay = []
    for k, text in enumerate(texts):
        if not any(five_word_jaccard(text.lower(), texts[j].lower()) >= 0.8 for j in stay):
            stay.append(k)
    assert 7 < len(stay) < len(texts) - 8
    got = simhash.keep_one(documents([(k, t) for k, t in enumerate(texts)])).collect()
    assert sorted(r.doc_id for r in got) == stay

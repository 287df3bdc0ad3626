"""Learned operators: held-out accuracy and the defined cases."""

import random

import numpy as np
import pytest
from edge_cases import ODD, documents  # noqa: F401

from dayledger.llm import quality, toxicity



def held_out_auc(scores, labels, column):
    rows = scores.filter("held_out").join(labels.filter(f"{column} IS NOT NULL"), "doc_id").select("score", column).collect()
    ones, zeros = [r[0] for r in rows if r[1] == 1], [r[0] for r in rows if r[1] == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros]) if ones and zeros else None


def made_up(n, seed=3):
    """Ordinary words; toxic documents hold one of two insults; bad ones shout."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        toxic, good = rng.random() < 0.25, rng.random() < 0.7
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["zorkwit", "zorkhead", "glumpf"])
        text = " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)
        docs.append((i, text, f"s{i % 3}"))
        labels.append((i, int(good), int(toxic)))
    return docs, labels


@pytest.mark.parametrize("score,column", [(quality.score, "quality"), (toxicity.score, "toxic")])
def test_learns(spark, documents, score, column):
    docs, rows = made_up(600)
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    got = score(documents(docs), labels)
    assert held_out_auc(got, labels, column) > 0.95
    assert all(0 <= r.score <= 1 for r in got.collect())


@pytest.mark.parametrize("score,column", [(quality.score, "quality"), (toxicity.score, "toxic")])
def test_odd_rows_get_scores(spark, documents, score, column):
    docs, rows = made_up(120)
    labels = spark.createDataFrame(rows + [(5, None, None), (6, 1, 1), (6, 0, 0), (None, 1, 1), (10 ** 9, 0, 1)], "doc_id long, quality int, toxic int")
    odd = [((d + 10_000) if d else d, t, s) for d, t, s in ODD]
    got = score(documents(docs + odd), labels).collect()
    assert len(got) == len(docs) + len(odd) and all(r.score is not None and 0 <= r.score <= 1 and r.held_out is not None for r in got)
    same = [r.score for r in got if r.doc_id == 10_004]
    assert same[0] == same[1]


@pytest.mark.parametrize("score", [quality.score, toxicity.score])
def test_no_labels_one_kind_and_empty(spark, documents, score):
    schema = "doc_id long, quality int, toxic int"
    none, ones = spark.createDataFrame([], schema), spark.createDataFrame([(4, 1, 1), (8, 1, 1), (1, 1, 1), (2, 1, 1)], schema)
    assert len({r.score for r in score(documents(ODD), none).collect()}) == 1
    assert {r.score for r in score(documents(ODD), ones).collect()} == {1.0}
    assert score(documents([]), none).collect() == []


def test_labels_of_held_out_rows_are_not_read(spark, documents):
    docs, rows = made_up(300)
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    for score, parts, part in ((quality.score, 3, 1), (toxicity.score, 4, 2)):
        from pyspark.sql import functions as F
        turned = labels.withColumns({c: F.when(quality.held_out(F.col("doc_id"), parts, part), 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
        a, b = ({r.doc_id: r.score for r in score(documents(docs), x).collect()} for x in (labels, turned))
        assert a == b


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    x, first, y = rng.normal(size=(9, 4)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    model = {"W": rng.normal(size=(4, 5)), "b": rng.normal(size=5), "V": rng.normal(size=(5, 3)), "U": rng.normal(size=(5, 3)),
             "w": rng.normal(size=3), "c": rng.normal(size=5), "d": np.array(0.3)}
    loss = lambda m: -np.mean(y * np.log(quality.forward(m, x, first)["p"]) + (1 - y) * np.log(1 - quality.forward(m, x, first)["p"]))
    slope = quality.gradients(model, x, first, y)
    for k in model:
        step = rng.normal(size=model[k].shape) * 1e-6
        up, down = loss(model | {k: model[k] + step}), loss(model | {k: model[k] - step})
        assert (up - down) / 2 == pytest.approx(np.sum(slope[k] * step), rel=1e-3, abs=1e-11)


def test_backoff_is_a_distribution(spark, documents):
    docs, _ = made_up(40)
    from pyspark.sql import functions as F
    counts = toxicity.gram_counts(documents(docs).select("text", F.lit(None).cast("double").alias("y"))).cache()
    shared = toxicity.shared_backoff(counts).withColumn("context", F.shiftright("low", 8)).groupBy("context").agg(F.sum("p").alias("p")).collect()
    assert all(0 < r.p < 1 + 1e-9 for r in shared)  # what is left belongs to bytes never seen there


def test_rare_expressions_made_of_ordinary_pieces_are_told_apart(spark, documents):
    """'abcxyz' is toxic; every 5 bytes of it, marks included, are those of ordinary words."""
    docs, _ = made_up(400)
    rng = random.Random(4)
    docs, labels = [(i, t.lower().replace("!!", "") + " abcxyq qbcxyz", s) for i, t, s in docs], []
    for i, (d, text, s) in enumerate(docs):
        toxic = rng.random() < 0.3
        docs[i] = (d, f"{text} abcxyz" if toxic else text, s)
        labels.append((d, 1, int(toxic)))
    got = toxicity.score(documents(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert held_out_auc(got, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "toxic") > 0.95


def test_all_usable_labels_are_counted_and_no_table_is_cut(spark, documents, monkeypatch):
    from pyspark.sql import functions as F
    docs, rows = made_up(200)
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    monkeypatch.setattr(toxicity, "SAMPLE_DOCS", 20)
    monkeypatch.setattr(toxicity, "MAX_GRAMS", 10, raising=False)
    seen = {}
    grams, ratios = toxicity.vocabulary_grams, toxicity.word_ratios

    def counted(words):
        seen["w"] = tuple(words.agg(F.sum("toxic"), F.sum("ordinary")).first())
        return grams(words)

    def weighed(counts):
        out = ratios(counts)
        seen["v"] = out.count()
        return out

    monkeypatch.setattr(toxicity, "vocabulary_grams", counted)
    monkeypatch.setattr(toxicity, "word_ratios", weighed)
    toxicity.train(documents(docs), labels, 4, 2, 20)
    usable = labels.filter(~quality.held_out(F.col("doc_id"), 4, 2) & (F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(toxicity.CALIBRATION)) != 0))
    ids = {r.doc_id: r.toxic for r in usable.collect()}
    words = lambda y: sum(len(t.replace("!!", "").split()) for d, t, _ in docs if ids.get(d) == y)
    assert seen["w"] == (words(1), words(0))
    assert seen["v"] > 200


def naive_ratios(words):
    """{word: summed log ratio} by Kneser-Ney over dictionaries, from {word: (toxic, ordinary)}."""
    from collections import Counter, defaultdict
    from math import log
    order = toxicity.ORDER

    def grams(word):
        padded = [0] * order + [1] + list(word) + [1]
        return [tuple(padded[i - order + 1:i + 1]) for i in range(order + 1, len(padded))]

    counts = {c: Counter() for c in (0, 1)}
    for word, n in words.items():
        for g in grams(word):
            for c in (0, 1):
                counts[c][g] += n[c]
    seen = {order: set(counts[0])}
    for o in range(order - 1, 0, -1):
        seen[o] = {g[1:] for g in seen[o + 1]}
    kinds = {o: Counter(g[1:] for g in seen[o + 1]) for o in range(1, order)}

    def below(g):
        if not g:
            return 1 / 256
        rest = [n for other, n in kinds[len(g)].items() if other[:-1] == g[:-1]]
        return (kinds[len(g)][g] - 0.75) / sum(rest) + 0.75 * len(rest) / sum(rest) * below(g[1:])

    off, total, spare = {}, [defaultdict(int), defaultdict(int)], [defaultdict(float), defaultdict(float)]
    for c in (0, 1):
        d = toxicity.discounts([sum(n == k for n in counts[c].values()) for k in (1, 2, 3, 4)])
        off[c] = lambda n, d=d: 0.0 if n <= 0 else d[min(n, 3) - 1]
        for g, n in counts[c].items():
            total[c][g[:-1]] += n
            spare[c][g[:-1]] += off[c](n)

    def ratio(g):
        sums = [total[c][g[:-1]] for c in (0, 1)]
        if not any(sums):
            return 0.0
        rest = [spare[c][g[:-1]] / sums[c] if sums[c] else 1.0 for c in (0, 1)]
        if not counts[0][g] + counts[1][g]:
            return log(max(rest[0], 1e-4) / max(rest[1], 1e-4))
        p = [((counts[c][g] - off[c](counts[c][g])) / sums[c] if sums[c] else 0.0) + rest[c] * below(g[1:]) for c in (0, 1)]
        return log(p[0] / p[1])

    return {w: sum(ratio(g) for g in grams(w)) for w in words}


@pytest.mark.parametrize("chunk", [1 << 20, 300])
def test_log_ratios_are_those_of_a_naive_model(spark, monkeypatch, chunk):
    rng = random.Random(8)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))).encode(): (rng.choice([0, 0, 1, 4]), rng.choice([0, 0, 1, 2, 3])) for _ in range(250)}
    words |= {b"a" * 700: (1, 0), b"": (0, 2)}
    monkeypatch.setattr(toxicity, "CHUNK", chunk)
    rows = spark.createDataFrame([(bytearray(w), *n) for w, n in words.items()], "word binary, toxic long, ordinary long").repartition(3)
    counts = toxicity.stored(toxicity.vocabulary_grams(rows))
    got = {bytes(r.word): r.ratio for r in toxicity.word_ratios(counts).collect()}
    want = naive_ratios(words)
    assert len(got) > 200 and set(got) >= {w for w, r in want.items() if abs(r) > 1e-3}
    assert all(got.get(w, 0.0) == pytest.approx(r, abs=1e-3) for w, r in want.items())

"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words, all of its text. Each passage is described by
numbers (letters, case, punctuation, symbols, repetition, word lengths), encoded by one hidden layer, and
weighted by gated attention; the score is a logistic function of the weighted mean of the encodings.
Encoder, attention and output are learned together from document labels alone, by Adam, on the driver,
from a bounded sample: about ``SAMPLE_DOCS`` labelled documents by a hash of their id, all passages of each.
Every document is scored.

Defined cases: null and empty texts are one empty passage and get a score too; null labels are left out,
of contradicting labels of one id the larger counts; with labels of one kind only, or none, every score
is the mean label, or 0.5; repeated rows get equal scores; empty tables give no rows. Id, language, source
and label never reach a score; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm import textbytes

PASSAGE = 64
SAMPLE_DOCS = 8_000
HIDDEN, ATTENTION, EPOCHS, BATCH, RATE, DECAY = 16, 8, 40, 256, 0.01, 1e-4

UPPER = textbytes.byte_table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGIT = textbytes.byte_table("0123456789")
#: Bytes counted per passage, as shares of its bytes.
KINDS = [UPPER, DIGIT, textbytes.byte_table("."), textbytes.byte_table(","), textbytes.byte_table("!?"), textbytes.byte_table("|<>{}[]()/\\=+_~^"),
         textbytes.byte_table("*#$%&@"), textbytes.byte_table("\n"), textbytes.byte_table("\"':;-"), np.arange(256) >= 128]
WIDTH = len(KINDS) + 8


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of ``texts``, and the first passage of each text (with the end)."""
    words = textbytes.split(texts, ~textbytes.SPACE)
    count = np.diff(words.first)
    bags = np.maximum(1, -(-count // PASSAGE))
    first = np.r_[0, np.cumsum(bags)]
    out = np.zeros((first[-1], WIDTH))
    doc = np.repeat(np.arange(len(bags)), bags)
    nth = np.arange(first[-1]) - first[doc]
    # Passages of a text are of equal length, give or take a word.
    low = words.first[doc] + nth * count[doc] // bags[doc]
    high = words.first[doc] + (nth + 1) * count[doc] // bags[doc]
    full = np.flatnonzero(high > low)
    low, high = low[full], high[full]
    out[:, -1] = 1.0
    if not len(full):
        return out, first
    out[full, -1] = 0.0
    begin, end, n = words.start[low], words.stop[high - 1], (high - low).astype(float)
    size = (end - begin).astype(float)
    spans = np.stack([begin, end], axis=1).ravel()
    for k, kind in enumerate(KINDS):
        out[full, k] = np.add.reduceat(kind[words.raw], spans, dtype=np.int64)[::2] / size
    length = np.r_[0, np.cumsum(words.stop - words.start)]
    square = np.r_[0, np.cumsum((words.stop - words.start).astype(float) ** 2)]
    mean = (length[high] - length[low]) / n
    same = np.r_[0, np.cumsum(np.r_[False, words.hash[1:] == words.hash[:-1]])]
    which = np.repeat(np.arange(len(full)), (high - low))
    pairs = np.lexsort((words.hash, which))
    new = np.r_[True, (words.hash[pairs][1:] != words.hash[pairs][:-1]) | (which[pairs][1:] != which[pairs][:-1])]
    different = np.bincount(which[pairs][new], minlength=len(full))
    k = len(KINDS)
    out[full, k] = np.log1p(mean)
    out[full, k + 1] = np.log1p(np.sqrt(np.maximum(0, (square[high] - square[low]) / n - mean ** 2)))
    out[full, k + 2] = (same[high] - same[np.minimum(low + 1, high)]) / n
    out[full, k + 3] = different / n
    out[full, k + 4] = np.log1p(n)
    out[full, k + 5] = np.log1p(count[doc[full]])
    out[full, k + 6] = DIGIT[words.raw[begin]] | UPPER[words.raw[begin]]
    return out, first


def forward(model: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """All layers of the network for passages ``x`` of bags that start at ``first``."""
    h = np.tanh(x @ model["W"] + model["b"])
    t, g = np.tanh(h @ model["V"]), 1 / (1 + np.exp(-(h @ model["U"])))
    e = (t * g) @ model["w"]
    bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
    weight = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
    attention = weight / np.add.reduceat(weight, first[:-1])[bag]
    z = np.add.reduceat(attention[:, None] * h, first[:-1], axis=0)
    return {"h": h, "t": t, "g": g, "a": attention, "bag": bag, "z": z, "p": 1 / (1 + np.exp(-(z @ model["c"] + model["d"])))}


def gradients(model: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean logistic loss."""
    f = forward(model, x, first)
    out = (f["p"] - y) / len(y)
    dz = out[:, None] * model["c"]
    dh = f["a"][:, None] * dz[f["bag"]]
    da = (f["h"] * dz[f["bag"]]).sum(axis=1)
    de = f["a"] * (da - np.add.reduceat(f["a"] * da, first[:-1])[f["bag"]])
    dt, dg = de[:, None] * model["w"] * f["g"] * (1 - f["t"] ** 2), de[:, None] * model["w"] * f["t"] * f["g"] * (1 - f["g"])
    dh += dt @ model["V"].T + dg @ model["U"].T
    dh *= 1 - f["h"] ** 2
    return {"W": x.T @ dh, "b": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de,
            "c": f["z"].T @ out, "d": out.sum()}


def fit(x: np.ndarray, sizes: np.ndarray, y: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    """Network for bags of ``sizes`` passages each and their labels."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    model = {"W": rng.normal(0, 0.3, (x.shape[1], HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, 0.3, (HIDDEN, ATTENTION)),
             "U": rng.normal(0, 0.3, (HIDDEN, ATTENTION)), "w": rng.normal(0, 0.3, ATTENTION), "c": rng.normal(0, 0.3, HIDDEN),
             "d": np.array(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))}
    x = np.clip((x - mean) / scale, -6, 6)
    starts = np.r_[0, np.cumsum(sizes)]
    first_moment, second_moment, step = {k: 0.0 for k in model}, {k: 0.0 for k in model}, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for chosen in np.array_split(order, max(1, len(y) // BATCH)):
            step += 1
            rows = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in chosen])
            slope = gradients(model, x[rows], np.r_[0, np.cumsum(sizes[chosen])], y[chosen])
            rate = RATE * (1 - epoch / EPOCHS) + 1e-4
            for k in model:
                first_moment[k] = 0.9 * first_moment[k] + 0.1 * slope[k]
                second_moment[k] = 0.999 * second_moment[k] + 0.001 * slope[k] ** 2
                model[k] = model[k] - rate * (first_moment[k] / (1 - 0.9 ** step) / (np.sqrt(second_moment[k] / (1 - 0.999 ** step)) + 1e-8)
                                              + DECAY * model[k])
    return model | {"mean": mean, "scale": scale}


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text falls to ``part`` of ``parts``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part


def sampled(docs: DataFrame, labels: DataFrame, label: str, usable: Column, size: int) -> DataFrame:
    """``text, y`` of about ``size`` labelled documents: ids by a hash, so at most that many whatever the input."""
    known = labels.select("doc_id", F.col(label).alias("y")).filter(usable & F.col("y").isNotNull() & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.max("y").alias("y"))
    share = min(1.0, size / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1_000_003)) < share * 1_000_003)
    # About ``size`` ids of 12 bytes: the bound of what is broadcast.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("y").cast("double").alias("y"))


def train(docs: DataFrame, labels: DataFrame, parts: int = 3, part: int = 1, sample: int = SAMPLE_DOCS) -> dict | float:
    """The network, or a constant score if the labels are of one kind or missing."""
    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = list(batch["text"])
            for part in textbytes.portions(texts):
                x, first = passages(texts[part])
                yield pd.DataFrame({"x": [x[a:b].astype(np.float32).tobytes() for a, b in zip(first[:-1], first[1:])], "y": batch["y"].iloc[part]})

    rows = sampled(docs, labels, "quality", ~held_out(F.col("doc_id"), parts, part), sample).mapInPandas(describe, "x binary, y double").toArrow().to_pandas()
    if rows["y"].nunique() < 2:
        return float(rows["y"].mean()) if len(rows) else 0.5
    rows = rows.sort_values(["y", "x"], ignore_index=True)  # reruns agree
    bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in rows["x"]]
    return fit(np.concatenate(bags).astype(float), np.array([len(b) for b in bags]), rows["y"].to_numpy())


def scorer(model: dict | float):
    """Column function: score of a whole text."""
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts, out = list(batch), np.full(len(batch), model if isinstance(model, float) else 0.0)
            for part in textbytes.portions(texts) if isinstance(model, dict) else ():
                x, first = passages(texts[part])
                out[part] = forward(model, np.clip((x - model["mean"]) / model["scale"], -6, 6), first)["p"]
            yield pd.Series(out)
    return run


def score(docs: DataFrame, labels: DataFrame, parts: int = 3, part: int = 1) -> DataFrame:
    """``doc_id, held_out, score`` of every document."""
    model = train(docs, labels, parts, part)
    return docs.select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), scorer(model)(F.col("text")).alias("score"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the documents that score below ``threshold``, all columns kept."""
    return docs.filter(scorer(train(docs, labels))(F.col("text")) >= threshold)

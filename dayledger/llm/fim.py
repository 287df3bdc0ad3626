"""Fill-in-the-middle: documents cut in prefix, middle and suffix and put in an order that asks for the middle.

A text is matched once against ``(unit)*`` by a regex library that keeps every repetition of a group. The
ends of these repetitions say how many units the text has and where each cut falls; nothing is iterated.

Cases. Null counts as empty; an empty text, one that holds a mark, one that units cannot tile and the drawn
share stay plain. Cuts depend on the id, so equal rows are cut alike; a null id draws like an empty string.
Any length of text is matched whole (8 bytes or more a unit while it is matched). Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CODE_POINT = r"(?s:.)"


def cuts(unit: str = CODE_POINT):
    """UDF (text, draw, draw) -> units in the text and the code points before the first and the second cut."""
    pattern = regex.compile(f"({unit})*")

    def cut(text: str, one: int, two: int) -> tuple[int, int, int]:
        match = pattern.fullmatch(text)
        ends = [0, *match.ends(1)] if match else [0]
        n = len(ends) - 1
        one, two = one % (n + 1), two % (n + 1)
        return n, ends[min(one, two)], ends[max(one, two)]

    @F.arrow_udf("struct<n: long, first: int, second: int>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, ones, twos in batches:
            found = [cut(t.as_py(), a, b) for t, a, b in zip(texts, ones.to_pylist(), twos.to_pylist())]
            columns = zip(*found) if found else ((), (), ())
            yield pa.StructArray.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int32(), pa.int32()))],
                                             names=["n", "first", "second"])

    return run


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the hash of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1, percent: int = 90,
              percent_spm: int = 20, unit: str = CODE_POINT) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row; ``n`` counts units.

    Of the texts that can be cut about ``percent`` % are, of these ``percent_spm`` % suffix first.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    one, two, three, four = draws(F.col(doc_id), seed)
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text"), cuts(unit)(whole, one, two).alias("cut"),
                       (three % 100).alias("kept"), (four % 100).alias("kind"))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(F.col("text"), F.lit(mark))
    plain = (F.col("cut.n") == 0) | (F.col("kept") >= percent) | marked
    form = F.when(plain, "plain").when(F.col("kind") < percent_spm, "spm").otherwise("psm")
    first, second = F.col("cut.first"), F.col("cut.second")
    prefix = F.concat(F.lit(PREFIX), F.substr("text", F.lit(1), first))
    middle = F.substr("text", first + 1, second - first)
    suffix = F.concat(F.lit(SUFFIX), F.substr("text", second + 1))
    output = (F.when(F.col("form") == "plain", F.col("text"))
              .when(F.col("form") == "psm", F.concat(prefix, suffix, F.lit(MIDDLE), middle))
              .otherwise(F.concat(suffix, prefix, F.lit(MIDDLE), middle)))
    cut_only = F.col("form") != "plain"
    return rows.withColumn("form", form).select(
        "doc_id", F.col("cut.n").alias("n"), "form", F.when(cut_only, first.cast("long")).alias("prefix_chars"),
        F.when(cut_only, (second - first).cast("long")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. A cut text holds no mark, so each mark occurs once."""
    at = {mark: F.locate(mark, output) for mark in (PREFIX, SUFFIX, MIDDLE)}

    def between(mark: str, stop: str) -> Column:
        return F.substr(output, at[mark] + len(mark), at[stop] - at[mark] - len(mark))

    middle = F.substr(output, at[MIDDLE] + len(MIDDLE))
    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX)))
            .otherwise(output))

"""Exact dedup by two-pass Bloom filtering: only rows whose text may repeat are shuffled.

Texts are equal when identical after lowering A-Z; null counts as empty; the row with the largest id
stays (a null id is the smallest; of rows equal in text and id one stays). Empty input gives no rows.
Other columns are not read, so their names may clash with nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm import bloom
from dayledger.llm.common import lower_ascii, stored


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    body = lower_ascii(F.coalesce(F.col(text), F.lit("")))
    sha = F.sha2(body.cast("binary"), 256)
    # Written once: the texts are read and hashed once, and row numbers stay what they are.
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), sha.alias("text_sha256"))
                  .withColumn("h", F.xxhash64("text_sha256")).withColumn("n", F.monotonically_increasing_id()))
    repeated = bloom.build(rows.select("h"), rows.count(), repeated_only=True)
    marked = rows.withColumn("maybe", bloom.might_hold(rows, repeated, F.col("h")))

    alone = marked.filter("NOT maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    shuffled = marked.filter("maybe").select("doc_id", "n", "text_sha256")
    # Counted on both sides of the shuffle: a text that many rows share arrives as one row per task.
    # Written, so that the join below has a plain scan on either side: adaptive execution splits a hot text's
    # rows there, which it may not do beside the aggregate.
    groups = stored(shuffled.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "n")).alias("best")))
    met = shuffled.join(groups, "text_sha256").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("n") == F.col("best.n")).alias("kept"), "text_sha256")
    return alone.unionByName(met)

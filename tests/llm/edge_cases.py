"""Rows and columns every operator on documents must take."""

import pytest

#: Names that the operators use inside or return; input columns may have them too.
CLASHING = {"size": 7, "score": "x", "fp": 1, "key": "k", "shard": 3, "root": 1, "n": 2, "h": 0, "h_": 0, "range": 9, "row_key": 1, "y": 1,
            "taken": 5, "words": 2, "target": 1.0, "kept": True, "maybe": False, "a": 1, "b": 2, "draws": "z", "host": "q", "path": "p", "stretch": 1}


@pytest.fixture
def documents(spark):
    """Builder of a documents table with clashing extra columns."""
    def make(rows, extra=True):
        from pyspark.sql import functions as F
        df = spark.createDataFrame([(r + (None,) * 3)[:3] for r in rows], "doc_id long, text string, source string")
        df = df.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars"))
        return df.withColumns({k: F.lit(v) for k, v in CLASHING.items()}) if extra else df
    return make


#: Edge cases every operator on documents meets.
ODD = [(1, None, "a"), (2, "", "a"), (3, "   \t\n", None), (None, "no id at all here", "b"), (4, "one two three four five six", "b"),
       (4, "one two three four five six", "b"), (5, "ONE two three four five six", None), (6, "word " * 30_000, "c"), (7, "ünïcödé Ñandú x", "c"),
       (8, "single", None)]

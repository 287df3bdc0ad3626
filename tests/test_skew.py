"""A header that holds a third of all lines: the join is split, and nothing is lost."""

from pyspark.sql import functions as F

from dayledger.operators import daily, enrich

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.join.preferSortMergeJoin": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
}


def test_hot_header_is_split(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        n, headers = 300_000, 5_000
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % headers)
        lines = spark.range(n).repartition(8).select(
            hot.cast("bigint").alias("invoice"), (F.col("id") % 11).cast("string").alias("centre"), F.lit(1.25).alias("billed"))
        heads = spark.range(headers).select(
            F.col("id").alias("invoice"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("day"))
        joined = enrich.enrich_lines(lines, heads, "invoice", "day", {"centre": "centre"}, {"billed": "billed"})
        out = daily.count_and_sum(joined, ["jour", "centre"], "n", {"billed": "billed"})
        rows = out.collect()
        assert sum(r.n for r in rows) == n and float(sum(r.billed for r in rows)) == n * 1.25
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)

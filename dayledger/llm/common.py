"""Helpers the operators share: tables, the shared folder, text sizes, distributed running sums."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``. Only a local session, whose
    executors are the driver, may go without: it gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="dayledger-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Whether Spark deletes the shuffle files of a statement when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, partitions: int | None = None, tidy: bool = False) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: lineage ends there, lost
    executors cost nothing, and Spark knows the size before it plans a join. ``tidy`` takes little disk:
    smaller files, and the shuffle files of the write go when it has ended, as nothing reads them again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, str(tidy or before == "true").lower())
    try:
        (df if partitions is None else df.coalesce(partitions)).write.parquet(path, compression="zstd" if tidy else None)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes the folders of ``stored`` tables that no later step reads: what was made of them is stored itself."""
    for df in tables:
        spark, folders = df.sparkSession, {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            if folder.rsplit("/", 1)[-1].startswith("llm-"):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lowered and nothing else changed. Pure ASCII takes the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """Number of words; null counts as no text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_sum(df: DataFrame, value: str, out: str, part: list[str], slice_: str, order: list[Column]) -> DataFrame:
    """Inclusive running sum of ``value`` over ``part`` in the order (``slice_``, ``order``), in two
    levels: totals per slice are summed up first, and each slice is then numbered by its own task.
    ``slice_`` must rise with ``order``. Only slice totals meet in one window."""
    totals = df.groupBy(*part, slice_).agg(F.sum(value).alias("__slice_sum"))
    before = Window.partitionBy(*part).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*part, slice_, F.coalesce(F.sum("__slice_sum").over(before), F.lit(0)).alias("__base"))
    keys = [*part, slice_]
    renamed = base.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__base")
    joined = df.join(renamed, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)], "inner")
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumn(out, F.col("__base") + F.sum(value).over(inside)).drop(
        "__base", *[f"__k{i}" for i in range(len(keys))])

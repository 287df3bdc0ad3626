"""Two kinds of target table, both plain Parquet folders appended to once per micro-batch.

``runs/span=A-B`` holds what the batches A to B add. A batch writes a run of its own, and whenever FAN runs of
one size stand side by side they are merged into one of the next size, up to any size. So a row is rewritten
once for each size, a merge reads and writes no more than the batches it covers, and a read meets fewer
than FAN runs of each size. A retried batch overwrites its own run, so nothing is applied twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.sources.cdc import OP, ORDER
from dayledger.streaming.files import children, has, remove

BUCKET = "_bucket"

#: Runs of one size that make one of the next.
FAN = 8

Span = tuple[int, int]


@dataclass(frozen=True)
class _BatchTable:
    spark: SparkSession
    path: str
    schema: T.StructType

    def _folder(self, span: Span) -> str:
        return f"{self.path}/runs/span={span[0]}-{span[1]}"

    def finished(self) -> list[Span]:
        """Every run whose write ended, whether a longer one holds it or not."""
        names = [n for n in children(self.spark, f"{self.path}/runs") if n.startswith("span=")]
        spans = [tuple(map(int, n.removeprefix("span=").split("-"))) for n in names]
        return sorted(s for s in spans if has(self.spark, f"{self._folder(s)}/_SUCCESS"))

    def runs(self, before: int | None = None) -> list[Span]:
        """The longest finished runs that together hold every batch below ``before`` once."""
        chosen: list[Span] = []
        for first, last in sorted(self.finished(), key=lambda s: (s[0], -s[1])):
            if (before is None or last < before) and (not chosen or first > chosen[-1][1]):
                chosen.append((first, last))
        return chosen

    def delta(self, batch: int) -> DataFrame:
        """What one finished batch added."""
        return self._read([(batch, batch)], self.schema)

    def discard_from(self, batch: int) -> None:
        """Drop what an abandoned run left behind: batches from ``batch`` on, finished or not."""
        for name in children(self.spark, f"{self.path}/runs"):
            if name.startswith("span=") and int(name.rpartition("-")[2]) >= batch:
                remove(self.spark, f"{self.path}/runs/{name}")

    def vacuum(self, before: int | None = None) -> None:
        """Drop runs that a longer finished one below ``before`` holds; plans made on them must have ended."""
        held = [s for s in self.runs(before) if s[0] < s[1]]
        for first, last in self.finished():
            if any(a <= first and last <= b and (first, last) != (a, b) for a, b in held):
                remove(self.spark, self._folder((first, last)))

    def merge_due(self, batch: int) -> None:
        """Merges that follow from ``batch`` being finished. What a merge replaces goes when the next of its
        size is made, so readers that began before still find their files."""
        size = FAN
        while (batch + 1) % size == 0:
            first = batch + 1 - size
            inside = [s for s in self.runs(batch + 1) if s[1] >= first]
            if len(inside) > 1 and inside[0][0] >= first:
                self._merge(inside, (first, batch))
                self.vacuum(first)
            size *= FAN

    def compact(self, upto: int) -> None:
        """One run of all batches below ``upto``, which must not cut a longer run."""
        if any(first < upto <= last for first, last in self.finished()):
            raise ValueError(f"a run goes beyond batch {upto - 1}")
        parts = self.runs(upto)
        if len(parts) > 1:
            self._merge(parts, (0, upto - 1))

    def _merge(self, parts: list[Span], into: Span) -> None:
        raise NotImplementedError

    def _read(self, spans: list[Span], schema: T.StructType) -> DataFrame:
        if not spans:
            return self.spark.createDataFrame([], schema)
        # The folder name is a column for Spark, so all runs are one table to it, whatever lies below them.
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/runs")
        return reader.parquet(*[self._folder(s) for s in spans]).select(*schema.fieldNames())


@dataclass(frozen=True)
class KeyedTable(_BatchTable):
    """Latest row per key. Rows carry an order and an operation; deleted keys keep a tombstone, so
    that a late re-delivery of an older image cannot bring them back.

    ``bucket_key`` is the column other tables look rows up by. Every run is split by its hash, so a lookup
    of a batch's keys opens the buckets of those keys alone; in merged runs a Bloom filter per row group says
    which can hold a key. Columns in ``first`` keep their smallest value over all versions of a row
    (first detection).
    """

    keys: tuple[str, ...] = ()
    bucket_key: str = ""
    buckets: int = 16
    first: tuple[str, ...] = ()

    @property
    def _full(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(self.bucket_key), F.lit(self.buckets)).cast("int"))

    def _write(self, df: DataFrame, span: Span) -> None:
        # Rebalanced by bucket: few files for a small batch, several tasks for a bucket with a hot key.
        rows = df.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *self.keys)
        writer = rows.write.mode("overwrite").partitionBy(BUCKET)
        if span[0] < span[1]:  # the files of one batch are too small to be worth a filter
            writer = writer.option(f"parquet.bloom.filter.enabled#{self.bucket_key}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.parquet(self._folder(span))

    def append(self, df: DataFrame, batch: int) -> None:
        self._write(self._bucketed(df.select(*self.schema.fieldNames())), (batch, batch))

    def _fold(self, df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c not in self.keys and c != ORDER and c not in self.first]
        packed = F.struct(ORDER, *rest)
        aggs = [F.max_by(F.struct(*rest), packed).alias("_row"), F.max(ORDER).alias(ORDER)]
        aggs += [F.min(c).alias(c) for c in self.first]
        return df.groupBy(*self.keys).agg(*aggs).select(*self.keys, "_row.*", ORDER, *self.first)

    def versions(self, before: int | None = None, touched: DataFrame | None = None) -> DataFrame:
        """All runs, restricted to the ``bucket_key`` values in ``touched`` if given."""
        rows = self._read(self.runs(before), self._full)
        if touched is None:
            return rows
        # At most one row per bucket comes back; it prunes the folders the scan opens.
        hit = [r[0] for r in self._bucketed(touched).select(BUCKET).distinct().collect()]
        return rows.where(F.col(BUCKET).isin(hit)).join(touched.select(self.bucket_key), self.bucket_key, "left_semi")

    def read(self, before: int | None = None, touched: DataFrame | None = None) -> DataFrame:
        """Current rows as of the batches below ``before``."""
        live = self._fold(self.versions(before, touched)).where(F.col(OP) != "d")
        return live.select(*[f.name for f in self.schema.fields if f.name not in (OP, ORDER)])

    def _merge(self, parts: list[Span], into: Span) -> None:
        self._write(self._fold(self._read(parts, self._full)).select(*self._full.fieldNames()), into)


@dataclass(frozen=True)
class SumTable(_BatchTable):
    """Additive measures per key, kept as signed contributions: a correction appends the old row
    with a minus sign and the new one with a plus sign. A group whose count is back to zero is gone.
    """

    keys: tuple[str, ...] = ()
    count: str = ""
    measures: tuple[str, ...] = ()
    stamp: str = "maj_le"

    def _sum(self, df: DataFrame) -> DataFrame:
        sums = [F.sum(m).cast(self.schema[m].dataType).alias(m) for m in (self.count, *self.measures)]
        return df.groupBy(*self.keys).agg(*sums, F.max(self.stamp).alias(self.stamp))

    def _moved(self, df: DataFrame) -> DataFrame:
        """Without groups to which nothing is added in the end."""
        moved = F.col(self.count) != 0
        for m in self.measures:
            moved = moved | (F.coalesce(F.col(m), F.lit(0)) != 0)
        return df.where(moved).select(*self.schema.fieldNames())

    def append_signed(self, rows: DataFrame, inputs: dict[str, str], batch: int, sign: str = "_sign") -> None:
        """``rows`` carry +1 / -1 in ``sign``; ``inputs`` is {measure: column}."""
        signed = [F.sum(F.col(c) * F.col(sign)).cast(self.schema[m].dataType).alias(m) for m, c in inputs.items()]
        delta = rows.groupBy(*self.keys).agg(
            F.sum(sign).cast("bigint").alias(self.count), *signed).withColumn(self.stamp, F.current_timestamp())
        self._moved(delta).write.mode("overwrite").parquet(self._folder((batch, batch)))

    def read(self, before: int | None = None) -> DataFrame:
        return self._sum(self._read(self.runs(before), self.schema)).where(F.col(self.count) > 0)

    def _merge(self, parts: list[Span], into: Span) -> None:
        """Ordered by key, so a day range reads few row groups."""
        summed = self._moved(self._sum(self._read(parts, self.schema)))
        summed.repartitionByRange(*self.keys).sortWithinPartitions(*self.keys).write.mode("overwrite").parquet(self._folder(into))


def upsert_by_key(table: KeyedTable, df: DataFrame, batch: int) -> None:
    """Idempotent keyed write of plain rows: the batch number is their order.

    Replaying a batch overwrites what it wrote before. ``df`` may carry a boolean ``_deleted``.
    """
    gone = F.col("_deleted") if "_deleted" in df.columns else F.lit(False)
    order = F.struct(F.lit(batch).cast("bigint").alias("lsn"), F.lit(0).cast("bigint").alias("offset"))
    table.append(df.withColumns({OP: F.when(gone, "d").otherwise("u"), ORDER: order}), batch)

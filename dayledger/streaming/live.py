"""The continuous job with the touched rows in Spark's state store.

``Ledger`` looks up the rows before a batch in its tables; here they are the state of one operator. Events of all
sources are one stream of images, grouped by the key whose rows are judged together (an invoice with its lines,
a prior-approval request with its answer and acts, any other row alone). The operator keeps the current image of
every row and gives out, for a batch, the changed rows as they were (side -1) and as they are (side 1), with the
rows they are joined with. The plan of ``claims`` then runs on these few rows, and what it adds to the tables is
appended: one write for all daily tables, one for the quarantine, one for the images.

A line of an invoice is read and written alone, however many lines the invoice has; only a changed header brings
all its lines along. State lives in RocksDB with changelog checkpoints (``state_options``), so a batch costs
what it touches. The checkpoint belongs to the tables: a new checkpoint starts from an empty state and
therefore from new tables and the earliest offset.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from dayledger.operators.reshape import stack
from dayledger.plans import claims
from dayledger.sources import cdc
from dayledger.sources.specs import SPECS
from dayledger.streaming import files
from dayledger.streaming.pipeline import INVOICE_FAMILY, REQUEST_FAMILY, Ledger, _Part
from dayledger.streaming.tables import FAN, KeyedTable, SumTable

# The operator travels to the executors with the job, so they need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Sources judged together, and of these the header whose change concerns all rows of the key (none: any change does).
FAMILIES: dict[str, tuple[tuple[str, ...], str | None]] = {"invoice": (INVOICE_FAMILY, "invoices"), "request": (REQUEST_FAMILY, None)}
_FAMILY_OF = {source: family for family, (sources, _) in FAMILIES.items() for source in sources}

IMAGE = "source string, pk string, image string, op string, lsn long, position long"
STEP = IMAGE + ", side int, context boolean"


def state_options(spark: SparkSession, partitions: int | None = None) -> None:
    """Session settings the state needs; ``partitions`` is fixed by the first run of a checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    if partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))


def images(raw: DataFrame) -> DataFrame:
    """Change events of all sources as ``family, key`` and ``IMAGE``; events without their key are left out."""
    envelope = F.from_json("value", "before string, after string, op string, source struct<lsn: bigint, ts_ms: bigint>")
    parsed = raw.where(F.col("value").isNotNull()).select("topic", "offset", F.inline(F.array(envelope)))
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    rows = parsed.select("topic", image.alias("image"), "op", "source", "offset").where(F.col("image").isNotNull())

    def by_source(of: Callable[[str], Column]) -> Column:
        return reduce(lambda c, name: c.when(F.col("topic") == SPECS[name].table, of(name)), SPECS, F.when(F.lit(False), F.lit(None)))

    def joined_keys(keys: Iterable[str]) -> Column:
        fields = [F.get_json_object("image", f"$.{k}") for k in keys]
        # Length before each part, so that no two keys read alike; one missing part makes the whole null.
        return F.concat(*[F.concat(F.length(f).cast("string"), F.lit(":"), f) for f in fields])

    keyed = rows.select(
        by_source(lambda n: F.lit(_FAMILY_OF.get(n, n))).alias("family"),
        by_source(lambda n: joined_keys(SPECS[n].keys[:1] if n in _FAMILY_OF else SPECS[n].keys)).alias("key"),
        by_source(F.lit).alias("source"), by_source(lambda n: joined_keys(SPECS[n].keys)).alias("pk"), "image", "op",
        F.coalesce(F.col("source.lsn"), F.col("source.ts_ms"), F.lit(0).cast("long")).alias("lsn"),
        F.coalesce("offset", F.lit(-1).cast("long")).alias("position"))
    return keyed.where(F.col("pk").isNotNull())


class Changes(StatefulProcessor):
    """Current image of every row of a key; gives out what a batch changes, before and after."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getMapState("rows", "source string, pk string", "image string, op string, lsn long, position long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest: dict[tuple[str, str], tuple] = {}
        for r in rows:
            at, event = (r.source, r.pk), (r.lsn, r.position, r.op, r.image)
            if at not in newest or event[:2] > newest[at][:2]:
                newest[at] = event
        changed: dict[tuple[str, str], tuple | None] = {}
        for at, (lsn, position, op, image) in newest.items():
            held = self.rows.getValue(at) if self.rows.containsKey(at) else None
            if held is not None and (held[2], held[3]) >= (lsn, position):
                continue  # delivered again, or older than what is known
            self.rows.updateValue(at, (image, op, lsn, position))
            if held is None or (held[0], held[1] == "d") != (image, op == "d"):
                changed[at] = held
                if held is not None and held[1] != "d":
                    yield self._row(at, held, -1, False)
                yield self._row(at, (image, op, lsn, position), 1, False)
        yield from self._beside(key[0], changed)

    def close(self) -> None:
        pass

    def _row(self, at, held, side: int, context: bool) -> Row:
        return Row(source=at[0], pk=at[1], image=held[0], op=held[1], lsn=held[2], position=held[3], side=side, context=context)

    def _beside(self, family: str, changed: dict) -> Iterator[Row]:
        """Live rows the changed ones are joined with, on both sides, as nothing about them changed."""
        if not changed or family not in FAMILIES:
            return
        header = FAMILIES[family][1]
        if header is None or any(source == header for source, _ in changed):
            beside = self.rows.iterator()
        else:
            at = (header, key_of(next(iter(changed))[1]))
            beside = [(at, self.rows.getValue(at))] if self.rows.containsKey(at) else []
        for at, held in beside:
            if tuple(at) not in changed and held[1] != "d":
                for side in (-1, 1):
                    yield self._row(at, held, side, True)


def key_of(pk: str) -> str:
    """First part of a row's key as ``images`` writes it."""
    length, _, rest = pk.partition(":")
    return f"{length}:{rest[:int(length)]}"


@dataclass
class LiveLedger(Ledger):
    """The tables of ``Ledger``, fed by the state store; the same names and rows, other folders."""

    def current(self) -> KeyedTable:
        """Current images of all sources."""
        schema = T.StructType.fromDDL("source string, pk string, image string, _op string, _order struct<lsn:bigint,offset:bigint>")
        return KeyedTable(self.spark, f"{self.root}/images", schema, ("source", "pk"), "source", 1)

    def source(self, name: str, before: int | None = None, touched: DataFrame | None = None) -> DataFrame:
        if touched is not None:
            raise ValueError("rows before a batch come from the state store")
        return self._typed(name, self.current().read(before).where(F.col("source") == name))

    def _typed(self, name: str, rows: DataFrame) -> DataFrame:
        spec = SPECS[name]
        return spec.with_derived(rows.select(F.inline(F.array(F.from_json("image", spec.schema)))))

    # -- daily tables: one table of signed sums for all ------------------------------------------

    def _plans(self) -> dict[str, tuple[SumTable, dict[str, str]]]:
        return super().sum_tables()

    def daily(self) -> SumTable:
        keys = dict.fromkeys(k for t, _ in self._plans().values() for k in t.keys)
        widest = max(len(t.measures) for t, _ in self._plans().values())
        fields = [T.StructField("tbl", T.StringType()), *[T.StructField(k, T.DateType() if k == "jour" else T.StringType()) for k in keys],
                  T.StructField("nombre", T.LongType()), *[T.StructField(f"m{k}", T.DecimalType(18, 2)) for k in range(widest)],
                  T.StructField("maj_le", T.TimestampType())]
        return SumTable(self.spark, f"{self.root}/kpi", T.StructType(fields), ("tbl", *keys), "nombre", tuple(f"m{k}" for k in range(widest)))

    def _daily_read(self, name: str, table: SumTable, before: int | None) -> DataFrame:
        rows = self.daily().read(before).where(F.col("tbl") == name)
        return rows.select(*table.keys, F.col("nombre").alias(table.count),
                           *[F.col(f"m{k}").cast(table.schema[m].dataType).alias(m) for k, m in enumerate(table.measures)], "maj_le")

    def _sum_rows(self, rows: DataFrame, name: str, wide: SumTable) -> DataFrame:
        table, inputs = self._plans()[name]
        held = {"tbl": F.lit(name)} | {k: F.col(k) for k in table.keys}
        keys = [(held[k] if k in held else F.lit(None)).cast(wide.schema[k].dataType).alias(k) for k in wide.keys]
        sums = [(F.col(inputs[table.measures[k]]) if k < len(table.measures) else F.lit(None)).cast("decimal(18,2)").alias(m)
                for k, m in enumerate(wide.measures)]
        return rows.select(*keys, *sums, "_sign")

    def _sum_writes(self, rows: DataFrame, names: Iterable[str], batch: int) -> list:
        wide = self.daily()
        self._signed_rows += [self._sum_rows(rows, n, wide) for n in names]
        return []

    # -- one micro-batch ---------------------------------------------------------------------------

    def _hold(self, df: DataFrame) -> DataFrame:
        return df  # a batch's rows are a file by now

    def _before_after(self, changes, family, key, batch):
        if not any(n in changes for n in family):
            return None
        empty = self.spark.createDataFrame([], STEP)
        both = {n: changes.get(n, empty) for n in family}
        return tuple({n: self._typed(n, rows.where((F.col("side") == side) & (F.col("op") != "d"))) for n, rows in both.items()} for side in (-1, 1))

    def process(self, changed: DataFrame, batch: int) -> None:
        """Apply what the state operator gives out for one batch. Applying it again changes nothing."""
        if batch < self.committed():
            return
        step = f"{self.root}/step/batch={batch}"
        # The operator runs once: everything below reads this folder.
        changed.write.mode("overwrite").partitionBy("source").parquet(step)
        seen = [n.removeprefix("source=") for n in files.children(self.spark, step) if n.startswith("source=")]
        if seen:
            rows = self.spark.read.schema(STEP).option("basePath", step)
            changes = {n: rows.parquet(f"{step}/source={n}") for n in seen}
            self._signed_rows: list[DataFrame] = []
            with ThreadPoolExecutor(self.parallel_jobs) as pool:
                parts: list[_Part] = [p for p in pool.map(lambda f: f(changes, batch), self._families()) if p]
            writes = self._quarantine_writes([pair for part in parts for pair in part.flagged], batch)
            if self._signed_rows:
                wide = self.daily()
                writes.append(partial(wide.append_signed, stack(self._signed_rows), {m: m for m in wide.measures}, batch))
            now = stack(list(changes.values())).where((F.col("side") == 1) & ~F.col("context"))
            order = F.struct(F.col("lsn"), F.col("position").alias("offset")).alias("_order")
            writes.append(partial(self.current().append, now.select("source", "pk", "image", F.col("op").alias("_op"), order), batch))
            with ThreadPoolExecutor(self.parallel_jobs) as pool:
                list(pool.map(lambda write: write(), writes))
        files.mark(self.spark, f"{self.root}/done/batch={batch}")
        self._tidy(batch)

    def _tidy(self, batch: int) -> None:
        for folder, keep in (("done", 8), ("step", 1)):
            for name in files.children(self.spark, f"{self.root}/{folder}"):
                if name.startswith("batch=") and int(name[6:]) < batch - keep:
                    files.remove(self.spark, f"{self.root}/{folder}/{name}")
        if self.merge and (batch + 1) % FAN == 0:
            for table in self._all():
                table.merge_due(batch)

    def _all(self) -> list[KeyedTable | SumTable]:
        return [self.current(), self.quarantine(), self.daily()]

    def tables(self, before: int | None = None) -> dict[str, DataFrame]:
        before = self.committed() if before is None else before
        out = {n: self._daily_read(n, t, before) for n, (t, _) in self._plans().items()}
        return self._with_rest(out, before)


def run_live(raw: DataFrame, ledger: LiveLedger, checkpoint: str, name: str = "dayledger-live",
             trigger: dict[str, object] | None = None) -> StreamingQuery:
    """Start the continuous job on a raw change stream. Tables and checkpoint belong together: tables that
    another checkpoint has fed are refused."""
    state_options(ledger.spark)

    def start() -> StreamingQuery:
        if ledger.committed() and not files.has(ledger.spark, f"{checkpoint}/metadata"):
            raise ValueError(f"{ledger.root} was fed from another checkpoint; start new tables")
        captured = cdc.allow_tables(raw, [s.table for s in SPECS.values()])
        changed = images(captured).groupBy("family", "key").transformWithState(
            Changes(), outputStructType=STEP, outputMode="Append", timeMode="None")
        writer = changed.writeStream.foreachBatch(ledger.process).option("checkpointLocation", checkpoint).queryName(name)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    return files.claimed(ledger.spark, ledger.root, f"checkpoint {checkpoint}", start)

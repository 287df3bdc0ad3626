"""Change-event sources: read, decode, order and check."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.sources.specs import SourceSpec

ORDER = "_order"
OP = "_op"

RAW_COLUMNS = ("topic", "partition", "offset", "timestamp", "value")


# -- reading -----------------------------------------------------------------------------------


def read_kafka(spark: SparkSession, servers: str, tables: Sequence[str], prefix: str,
               stream: bool = True, options: dict[str, str] | None = None) -> DataFrame:
    """Change topics ``<prefix>.public.<table>`` from the earliest offset (needs the Kafka jar)."""
    reader = (spark.readStream if stream else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", ",".join(f"{prefix}.public.{t}" for t in tables))
    reader = reader.option("startingOffsets", "earliest")
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load().select(
        F.substring_index("topic", ".", -1).alias("topic"), "partition", "offset",
        F.col("timestamp").cast("timestamp"), F.col("value").cast("string").alias("value"),
    )


def read_files(spark: SparkSession, path: str, stream: bool = True, max_files: int | None = None) -> DataFrame:
    """Same columns from JSON-lines files under ``path/topic=<table>/``.

    Files carry no message offset, so ``offset`` is NULL and the source position alone orders.
    """
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("topic", T.StringType())])
    reader = (spark.readStream if stream else spark.read).format("text").schema(schema)
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path).select(
        "topic",
        F.lit(0).alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
        "value",
    )


def allow_tables(raw: DataFrame, tables: Iterable[str]) -> DataFrame:
    """Keep the captured tables only."""
    return raw.where(F.col("topic").isin(list(tables)))


# -- decoding ----------------------------------------------------------------------------------


def envelope_schema(spec: SourceSpec) -> T.StructType:
    source = T.StructType([
        T.StructField("ts_ms", T.LongType()),
        T.StructField("lsn", T.LongType()),
        T.StructField("table", T.StringType()),
    ])
    return T.StructType([
        T.StructField("before", spec.schema),
        T.StructField("after", spec.schema),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("source", source),
    ])


def decode(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Full envelope as columns; tombstones (NULL value) are dropped.

    The generator makes the text parsed once per event: as a plain column it would be copied into
    every later reference and filter.
    """
    parsed = F.inline(F.array(F.from_json("value", envelope_schema(spec))))
    return raw.where(F.col("value").isNotNull()).select("offset", "timestamp", parsed)


def parse_envelope(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """One row per event: the image that carries the key, its operation and its order.

    A delete keeps the before-image (the key is needed to remove the row); every other operation
    (create, snapshot read, update) keeps the after-image. Order is (source position, offset).
    """
    events = decode(raw, spec)
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    order = F.struct(
        F.coalesce(F.col("source.lsn"), F.col("source.ts_ms"), F.lit(0).cast("bigint")).alias("lsn"),
        F.coalesce("offset", F.lit(-1).cast("bigint")).alias("offset"),
    )
    flat = events.select(image.alias("i"), F.col("op").alias(OP), order.alias(ORDER))
    flat = flat.where(F.col("i").isNotNull()).select("i.*", OP, ORDER)
    return flat.where(all_not_null(spec.keys))


def all_not_null(columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(c).isNotNull()
    return condition


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str = ORDER) -> DataFrame:
    """Row with the greatest order per key, as a partially aggregated ``max_by``.

    The map side already keeps one row per key, so a key holding a large share of all events
    reaches its reducer as one row per map task. Equal orders are re-deliveries of one event; the
    rest of the row breaks the tie, so the survivor does not depend on arrival.
    """
    rest = [c for c in df.columns if c not in set(keys) and c != order]
    packed = F.struct(order, *rest)
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), packed).alias("_row"), F.max(order).alias(order))
    return picked.select(*keys, "_row.*", order).select(*df.columns)


def normalize_changelog(events: DataFrame, keys: Sequence[str], keep_deletes: bool = False) -> DataFrame:
    """Current image per key: re-delivered events collapse, deleted keys go."""
    current = latest_per_key(events, keys)
    return current if keep_deletes else current.where(F.col(OP) != "d")


def current_state(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Raw change events of one table to its current rows with derived columns."""
    events = parse_envelope(raw.where(F.col("topic") == spec.table), spec)
    return spec.with_derived(normalize_changelog(events, spec.keys).drop(OP, ORDER))


# -- checks ------------------------------------------------------------------------------------


def updates_without_before(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Updates and deletes that came without their before-image."""
    return decode(raw, spec).where(F.col("op").isin("u", "d") & F.col("before").isNull())


def require_before_images(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """The same events, failing the job on an update that lacks its before-image."""
    missing = F.col("op").isin("u") & F.col("before").isNull()
    message = F.lit(f"update without before-image in {spec.table}")
    checked = F.when(missing, F.raise_error(message).cast("string")).otherwise(F.col("op"))
    return decode(raw, spec).withColumn("op", checked)


def null_column_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, rows, non_null): a declared column that is NULL everywhere is a misspelt name."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in columns])
    return counts.unpivot(["rows"], list(columns), "column_name", "non_null").select(
        "column_name", "rows", "non_null", ((F.col("rows") > 0) & (F.col("non_null") == 0)).alias("suspect"))


def schema_null_guard(df: DataFrame, spec: SourceSpec) -> None:
    """Raise when a declared non-key column is NULL on every row."""
    columns = [c for c in spec.columns if c not in spec.keys]
    if not columns:
        return
    bad = [r.column_name for r in null_column_report(df, columns).where("suspect").collect()]
    if bad:
        raise ValueError(f"{spec.table}: no value ever seen in {bad}; check the column names")


def find_ghost_rows(state: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows still in the target that a fresh source snapshot no longer has (after a truncate)."""
    return state.join(snapshot.select(*keys), list(keys), "left_anti")

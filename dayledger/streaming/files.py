"""Folder checks on whatever file system a path names."""

from __future__ import annotations

from collections.abc import Callable
from threading import Thread

from py4j.protocol import Py4JJavaError
from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none when it does not exist."""
    fs, jpath = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []


def numbered(spark: SparkSession, path: str, label: str) -> list[int]:
    """N of every complete ``label=N`` folder: those whose write job finished."""
    fs, _ = _fs(spark, path)
    done = []
    for name in children(spark, path):
        if name.startswith(f"{label}="):
            if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/_SUCCESS")):
                done.append(int(name.split("=", 1)[1]))
    return sorted(done)


def remove(spark: SparkSession, path: str) -> None:
    """Delete one folder of a target table."""
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def mark(spark: SparkSession, path: str) -> None:
    """A finished, empty ``label=N`` folder, without a Spark job."""
    fs, jpath = _fs(spark, f"{path}/_SUCCESS")
    fs.create(jpath, True).close()


def has(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath))


class WriterBusy(RuntimeError):
    """Another job already writes to the same target tables."""


def acquire(spark: SparkSession, root: str, owner: str) -> None:
    """Claim a target folder for one run.

    Two jobs on the same tables corrupt them, so any other owner is refused. Only the run that holds
    the claim may claim again: a restart from its own checkpoint.
    """
    fs, jpath = _fs(spark, f"{root}/writer.lock")
    while True:
        try:
            stream = fs.create(jpath, False)
            break
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
        holder = _holder(spark, root)
        if holder == owner:
            return
        if holder is not None:
            raise WriterBusy(f"{root} is written by {holder!r}")
        # Given back in between: try again.
    stream.write(bytearray(owner.encode()))
    stream.close()


def _holder(spark: SparkSession, root: str) -> str | None:
    """Who holds the claim; none when the file is gone."""
    fs, jpath = _fs(spark, f"{root}/writer.lock")
    try:
        stream = fs.open(jpath)
    except Py4JJavaError as error:
        if "FileNotFound" in error.java_exception.getClass().getName():
            return None
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def release(spark: SparkSession, root: str, owner: str) -> None:
    """Give a claim back; one that another run holds stays."""
    if _holder(spark, root) == owner:
        remove(spark, f"{root}/writer.lock")


#: Owner and query of the last run per target folder in this process.
_last_runs: dict[str, tuple[str, StreamingQuery]] = {}


def claimed(spark: SparkSession, root: str, owner: str, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Start a query that holds the claim on a target folder until it ends."""
    last = _last_runs.get(root)
    if last and not last[1].isActive:  # ended in this process; its claim may not be given back yet
        release(spark, root, last[0])
    acquire(spark, root, owner)
    try:
        query = start()
    except BaseException:
        release(spark, root, owner)
        raise
    _last_runs[root] = owner, query

    def give_back() -> None:
        try:
            query.awaitTermination()
        except StreamingQueryException:
            pass  # the caller sees it in query.exception()
        release(spark, root, owner)

    Thread(target=give_back, daemon=True).start()
    return query

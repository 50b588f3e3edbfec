"""Tables that cut the lineage: written to a shared folder and read again."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Read from ``spark.checkpoint.dir``. Where that is unset: the warehouse on
    a cluster, a temporary folder in local mode (tests).
    """
    set_by_cluster = spark.conf.get("spark.checkpoint.dir", None)
    if set_by_cluster:
        return set_by_cluster.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    made = tempfile.mkdtemp(prefix="radspark-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def spool(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/spool-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._spooled = path
    return out


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables spooled inside are deleted at the end, but for those given to the function it yields."""
    start, kept = len(_written), set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._spooled)
        return df

    yield keep
    for spark, path in [w for w in _written[start:] if w[1] not in kept]:
        _written.remove((spark, path))
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def release() -> None:
    """Delete the spooled tables; frames that still read them become invalid."""
    while _written:
        spark, path = _written.pop()
        try:
            _delete(spark, path)
        except Exception:  # the session may have ended before the interpreter
            return


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the store that it lies in."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()


def _store(path: str):
    """The pyarrow file system of a path, and the path in it."""
    from pyarrow import fs

    scheme, mark, rest = path.partition(":")
    if not mark or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def can_open(path: str) -> bool:
    """Whether tasks can open the store of ``path`` themselves."""
    try:
        _store(path)
    except Exception:  # unknown scheme, or a client that is not installed
        return False
    return True


def open_read(path: str):
    store, at = _store(path)
    return store.open_input_stream(at)


@contextmanager
def open_write(path: str) -> Iterator:
    """A stream whose bytes appear at ``path`` once it is closed without error; names of attempts never clash."""
    store, at = _store(path)
    folder, _, name = at.rpartition("/")
    store.create_dir(folder, recursive=True)
    tmp = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
    try:
        with store.open_output_stream(tmp) as out:
            yield out
        store.move(tmp, at)
    except BaseException:
        try:
            store.delete_file(tmp)
        except OSError:
            pass
        raise

"""Where jobs keep intermediate and published files."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: Jobs that do not need each other and run side by side.
JOBS_AT_ONCE = 4

_local_folders: dict[str, str] = {}
_made: dict[str, list[str]] = {}
_held: dict[tuple[str, str], tuple[int, str | None]] = {}
_holding = threading.Lock()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A session on one machine without that setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="duesmith-")
    return _local_folders[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Write a table that several branches read and give back the stored copy.

    ``by`` names columns that make folders, for readers that want some of their values only.
    """
    return stored_at(df, new_folder(df.sparkSession, label), by)


def stored_at(df: DataFrame, path: str, by: Sequence[str] = ()) -> DataFrame:
    """The same in a given folder, which ``drop_folder`` can remove before the job ends."""
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def side_by_side(spark: SparkSession, job: Callable, items: Iterable) -> list:
    """``job`` of each item, a few at a time, so that the last tasks of one leave no cores idle.

    The results come in the order of the items; the first failure is raised when none runs any more.
    """
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job), item) for item in items]
        try:
            return [one.result() for one in running]
        except BaseException:
            for one in running:
                one.cancel()
            raise


@contextmanager
def held(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting that holds while jobs run, also side by side; the last to end puts the old value back."""
    key = spark._jsparkSession.sessionUUID(), name
    with _holding:
        users, old = _held.get(key) or (0, spark.conf.get(name, None))
        _held[key] = users + 1, old
        spark.conf.set(name, value)
    try:
        yield
    finally:
        with _holding:
            users, old = _held.pop(key)
            if users > 1:
                _held[key] = users - 1, old
            elif old is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, old)


def clear_work(spark: SparkSession) -> None:
    """Delete what this application has stored so far; nothing lazy may still need it."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        drop_folder(spark, path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a working table that no later step reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

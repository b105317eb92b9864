"""Shared-folder tables, used to fix a result that later steps read twice."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast up to so many rows and so many bytes of strings.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 100 << 20

_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets one scratch
    folder per process. A cluster must name storage that outlives an executor.
    """
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="run-")
    return _local_dir


_written: list[str] = []
_scope = threading.local()


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, removed when the process ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(remove_written)
    _written.append(path)
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    return path


def remove_written() -> None:
    """Remove the folders made so far. Tables read from them are gone after that.

    The JVM outlives its session, so this also works after ``spark.stop()``; file systems
    are then found by their own settings.
    """
    jvm = SparkContext._jvm
    if jvm is None:
        return
    context = SparkContext._active_spark_context
    conf = (
        context._jsc.hadoopConfiguration()
        if context is not None
        else jvm.org.apache.hadoop.conf.Configuration()
    )
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)


#: Spark's setting that removes the shuffle files of a query when it has ended.
_CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def scratch(clean: bool = False) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables that this thread stores inside are removed at the end.

    So nothing that still has to read them may leave: numbers, lists and fitted models may,
    and tables stored by the function this yields, which belong to the scope around. With
    ``clean``, the shuffle files of each table go as soon as it is stored, so a chain of
    large tables needs no more disk than its largest step.
    """
    outer, own = getattr(_scope, "paths", None), []
    cleaned = getattr(_scope, "clean", False)

    def keep(df: DataFrame, label: str) -> DataFrame:
        inner = _scope.paths
        _scope.paths = outer
        try:
            return stored(df, label)
        finally:
            _scope.paths = inner

    _scope.paths, _scope.clean = own, clean or cleaned
    try:
        yield keep
    finally:
        _scope.paths, _scope.clean = outer, cleaned
        context = SparkContext._active_spark_context
        for name in own:
            if name in _written and context is not None:
                path = context._jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
                _written.remove(name)


def in_scope(function: Callable) -> Callable:
    """``function`` for another thread: what it stores belongs to the scope of this one."""
    paths, clean = getattr(_scope, "paths", None), getattr(_scope, "clean", False)

    def run(*args):
        _scope.paths, _scope.clean = paths, clean
        return function(*args)

    return run


def move_parts(spark: SparkSession, folders: Sequence[str], path: str) -> None:
    """Make the part files of several written folders, in order, those of ``path``.

    Only names change. What was at ``path`` is replaced.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(conf)
    system.delete(target, True)
    system.mkdirs(target)
    number = 0
    for folder in folders:
        files = system.listStatus(jvm.org.apache.hadoop.fs.Path(folder))
        names = sorted(f.getPath().getName() for f in files)
        for name in names:
            if name.startswith("part-"):
                moved = jvm.org.apache.hadoop.fs.Path(f"{path}/part-{number:05d}.txt")
                system.rename(jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"), moved)
                number += 1
        system.delete(jvm.org.apache.hadoop.fs.Path(folder), True)
    system.create(jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")).close()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts lineage: the rows survive lost executors, and every reader sees the
    same rows even if ``df`` was not fully determined.
    """
    path = new_path(df.sparkSession, label)
    if getattr(_scope, "clean", False):
        conf = df.sparkSession.conf
        before = conf.get(_CLEAN_SHUFFLES, "false")
        conf.set(_CLEAN_SHUFFLES, "true")
        try:
            df.write.parquet(path)
        finally:
            conf.set(_CLEAN_SHUFFLES, before)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_by_size(
    df: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    label: str,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Inner join with a side whose size is unknown before it is computed.

    The side is stored, its rows counted and the bytes of its strings summed. Up to
    both bounds it is broadcast, so ``df`` is not shuffled; beyond them both sides are
    shuffled by key and adaptive execution splits hot keys. Without the count, a plan
    made from estimates would have started to shuffle ``df`` before the side was known
    to be small.
    """
    small = stored(small, label)
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in small.dtypes if t == "string"]
    width = sum(texts, F.lit(16 * len(small.columns)))
    rows, size = small.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    if rows <= max_rows and size <= max_bytes:
        small = F.broadcast(small)
    return df.join(small, [on] if isinstance(on, str) else list(on))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition an input of fewer splits than half the cores.

    Few splits mean a small or unsplittable input, the only case where moving
    whole texts pays. A large input has more splits than cores and is left as is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 > cores:
        return df
    return df.repartition(cores, *keys)

"""Tables in the folder that the cluster shares: what cuts lineage and survives a lost executor."""

from __future__ import annotations

import contextlib
import contextvars
import re
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Whether Spark deletes the files that a query has shuffled when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own: dict[str, str] = {}
#: Of each session, the writes under way and its own setting of CLEANUP.
_writes: dict[SparkSession, tuple[int, str | None]] = {}
_lock = threading.Lock()
#: Folders of the scratch blocks that this thread is in, the innermost last.
_scratch: contextvars.ContextVar[tuple[str, ...]] = contextvars.ContextVar("scratch", default=())


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder of this application, on one machine only: executors of a
    cluster would each write to their own disk, so there this raises."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    name = spark.sparkContext.applicationId
    if name not in _own:
        _own[name] = tempfile.mkdtemp(prefix="spark-shared-")
    return _own[name]


def shared_path(spark: SparkSession, name: str) -> str:
    return "/".join([shared_dir(spark), *_scratch.get()[-1:], f"{name}-{uuid.uuid4().hex}"])


@contextlib.contextmanager
def _cleaning(spark: SparkSession):
    """CLEANUP is on inside; the last thread of a session that leaves puts back what the first one found."""
    with _lock:
        n, before = _writes.get(spark, (0, None))
        _writes[spark] = n + 1, before if n else spark.conf.get(CLEANUP, None)
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            n, before = _writes.pop(spark)
            if n > 1:
                _writes[spark] = n - 1, before
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


def written(df: DataFrame, path: str) -> None:
    """df written to path. What it has shuffled is deleted with the end of the write, not when the driver's next garbage
    collection happens to find it: until then all steps of an operator would lie on the executors' disks together."""
    with _cleaning(df.sparkSession):
        df.write.parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: its lineage is cut, and any executor may be lost afterwards."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    written(df, path)
    return spark.read.schema(df.schema).parquet(path)


def listed(spark: SparkSession, path: str, prefix: str = "batch=") -> list[int]:
    """The numbers of the folders prefix<number> in path, ascending; none if path is not there."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in hadoop.listStatus(root)] if hadoop.exists(root) else []
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix))


def deleted(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Tables stored inside are deleted at the end: what is to stay must be written to a path made outside."""
    own = f"scratch-{uuid.uuid4().hex}"
    before = _scratch.set((*_scratch.get(), own))
    try:
        yield
    finally:
        _scratch.reset(before)
        deleted(spark, f"{shared_dir(spark)}/{own}")


def settled(spark: SparkSession, name: str, make) -> DataFrame:
    """make() written to the shared folder, and what it has stored on its way deleted."""
    path = shared_path(spark, name)
    with scratch(spark):
        df = make()
        written(df, path)
    return spark.read.schema(df.schema).parquet(path)

"""Intermediate tables in the folder that all executors share.

A written table cuts lineage, so a lost executor costs a re-read and not a
recomputation of everything before it.  Like reliable checkpoints the tables
stay until they are removed; :func:`release` removes those of this process.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_written: list[str] = []
#: With it, a query's shuffle files go when its table is written.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows of an Arrow batch between Spark and Python, where the session does not
#: say otherwise: whole texts in both and in their copies stay a few megabytes.
BATCH_ROWS = 2_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame) -> None:
    """Sets the session's Arrow batches to :data:`BATCH_ROWS` if they are as
    Spark has them by default."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH, "10000") == "10000":
        conf.set(_BATCH, str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Where it is unset, a
    local run gets a temporary one; on a cluster that is an error, as every
    executor would write to its own disk."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="marginalia-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    held = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if held is None else spark.conf.set(_CLEAN, held)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Has the driver's JVM collect now: Spark frees the broadcast tables and
    shuffle files of finished queries only when their handles are collected, and
    the heap is given back."""
    spark._jvm.System.gc()


#: Rows of a few numbers that are broadcast: 24 bytes each, 50 MB at most.
BROADCAST_ROWS = 2_000_000


def few(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A materialised table of numbers, marked for broadcast if its rows are
    counted to be at most so many; else joins shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def written() -> int:
    """How many tables :func:`materialize` has written in this process."""
    return len(_written)


def release(spark: SparkSession, since: int = 0, keep: str | None = None) -> None:
    """Deletes the tables that :func:`materialize` wrote in this process after
    the first ``since``, but for those whose tag is ``keep``.  Whatever still
    reads them must have been written out."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = [p for p in _written[since:] if keep is None or not p.rpartition("/")[2].startswith(f"{keep}-")]
    for name in gone:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    _written[:] = [p for p in _written if p not in set(gone)]

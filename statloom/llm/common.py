"""Helpers shared by the corpus operators: shared-folder tables and Arrow plumbing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import sys
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

ARROW_BYTES = 4 << 20
#: Rows that are broadcast at most (some MB); more are joined by a shuffle.
BROADCAST_ROWS = 200_000
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session leaves it unset on one machine (tests) a temporary folder is made; a cluster without it is an error.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _own_dirs:
        _own_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="statloom-")
    return _own_dirs[sc.applicationId]


def materialise(df: DataFrame, name: str, held: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs no recomputation of what came before. The files go
    when the driver's JVM ends, or with ``discard`` if their path is added to ``held``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/statloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    if held is not None:
        held.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, held: list[str]) -> None:
    """Delete tables that ``materialise`` wrote, once what follows from them is written."""
    for path in held:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    held.clear()


def small(df: DataFrame) -> DataFrame:
    """Broadcast a written table if it has at most ``BROADCAST_ROWS`` rows; else leave the join to a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with Arrow batches of at most ``ARROW_BYTES`` in its session.

    By default a batch goes up to 64 MiB, which each task holds several times over, in and out of Python.
    The setting is read when a query runs, so it stays; a session that has a value of its own keeps that.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH, None) is None:
        conf.set(_BATCH, str(ARROW_BYTES))
    return df


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches small enough for lists of Python objects; gives freed memory back as it goes."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
        del batch
        pa.default_memory_pool().release_unused()
    trim()


def trim() -> None:
    """Give freed memory back, where the C library can, so that a worker's size is what it uses."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def worker_state(owner: str) -> dict:
    """What a Python worker keeps between the tasks of one operator (tokenizers, models, caches of bounded size).

    The state of the operator before is dropped, so that a worker holds one at a time.
    """
    # a worker has one core; each further thread of the tokenizers library would keep buffers of its own
    os.environ.setdefault("RAYON_NUM_THREADS", "2")
    held = sys.modules.setdefault("_statloom_worker", ModuleType("_statloom_worker")).__dict__
    if held.get("owner") != owner:
        held["owner"], held["state"] = owner, {}
        gc.collect()
        trim()
    return held["state"]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

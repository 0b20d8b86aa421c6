"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .._ship import ensure_package
from ..session import ensure_checkpoint_dir, materialize

#: White space of the word rule: U+0020 and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"

#: Sides of at most this many ids are broadcast; larger ones are shuffled.
BROADCAST_IDS = 1_000_000

#: Bytes of an Arrow batch of whole texts.
TEXT_BATCH = 1 << 22

_KEPT: dict[str, dict] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """``df`` written to the shared folder of ``spark.checkpoint.dir`` and read
    back: it is computed once and outlives any executor.  ``batch_bytes`` bounds
    its Arrow batches."""
    return materialize(df, name, batch_bytes)


def trim() -> None:
    """Give freed memory back to the machine: the C library keeps it for its process otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def kept(owner: str) -> dict:
    """What tasks of the operator ``owner`` keep in this Python worker for its next ones.

    Spark gives a worker the tasks of any stage, so what other operators have
    kept there is dropped first."""
    if owner not in _KEPT:
        _KEPT.clear()
        gc.collect()  # an encoder and its chunks refer to each other
        _KEPT[owner] = {}
        trim()
    return _KEPT[owner]


def in_worker(owner: str, run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, without what other operators have kept in the worker; what it frees is given back."""
    def task(batches):
        kept(owner)
        yield from run(batches)
        trim()

    return task


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sieve-{name}-{uuid.uuid4().hex}"


def python_ready(spark: SparkSession) -> None:
    """Make this package importable in the Python workers."""
    ensure_package(spark)


def within(ids: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """``ids`` with a broadcast hint if it has at most ``limit`` rows.

    ``ids`` must be a written table (it is counted here).  Beyond the limit the
    planner shuffles both sides; results are the same."""
    return F.broadcast(ids) if ids.count() <= limit else ids


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_key(id_: Column, text: Column) -> Column:
    """A 64-bit key, never null: rows equal in id and text share it."""
    return F.xxhash64(id_.isNull(), id_, text.isNull(), text)

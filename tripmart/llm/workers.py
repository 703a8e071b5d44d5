"""Running Python over Arrow batches on the executors."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import partial
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


#: Workers outlive their tasks; what a task frees goes back to the system, but for 32 MB, and
#: arrays below 8 MB are not fetched from it and returned one by one, which costs page faults.
FREEING = {
    "ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1",
    "MALLOC_TRIM_THRESHOLD_": str(32 << 20), "MALLOC_MMAP_THRESHOLD_": str(8 << 20),
}

#: Bytes of a batch that are worked on at once; what comes of them goes to the JVM before the next begin.
PART = 4 << 20


def importable(spark: SparkSession) -> None:
    """Let workers import this package from where the driver has it, besides what is installed."""
    own = spark.sparkContext.environment
    if ROOT not in own.get("PYTHONPATH", "").split(":"):
        own["PYTHONPATH"] = ":".join(filter(None, [ROOT, own.get("PYTHONPATH")]))
    own.update({k: v for k, v in FREEING.items() if k not in own})


def free(spark: SparkSession) -> None:
    """Let Spark delete shuffle files, and checkpoints where it may, that no frame refers to any more.

    It does so when the driver collects its garbage, which a driver with little to do rarely does.
    What the driver's Python has freed goes back to the system too.
    """
    give_back()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """What this process has freed goes back to the system, where the C library offers it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


Batches = Iterator[pa.RecordBatch]


#: What tasks of one kind leave in a worker for the next of their kind.
_kept: dict = {}


def kept(make: Callable, *args):
    """``make(*args)`` as this worker's last task left it, else anew."""
    if (make, args) not in _kept:
        _kept.clear()
        _kept[make, args] = make(*args)
    return _kept[make, args]


def _lean(batches: Batches, compute: Callable[[Batches], Batches], keeps: bool) -> Batches:
    if not keeps:
        _kept.clear()
    yield from compute(batches)
    give_back()


def lean(compute: Callable[[Batches], Batches], keeps: bool = False) -> Callable[[Batches], Batches]:
    """``compute`` over a partition, after which its worker, idle or at other work then, holds none of its memory.

    ``keeps``: what it has ``kept`` stays for tasks of its kind, until one that keeps nothing begins.
    """
    return partial(_lean, compute=compute, keeps=keeps)


def slices(batches: Batches) -> Batches:
    """The batches in slices of about ``PART`` bytes, as many rows in each slice of a batch."""
    for batch in batches:
        rows = max(1, batch.num_rows * PART // max(1, batch.nbytes))
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def map_batches(
    rows: DataFrame, compute: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """``compute`` over the Arrow batches of ``rows``, a part at a time; what it keeps is one part's."""
    importable(rows.sparkSession)

    def run(batches: Batches) -> Batches:
        for part in slices(batches):
            yield compute(part)

    return rows.mapInArrow(lean(run), schema)


def columns(**values) -> pa.RecordBatch:
    """A batch from lists or arrays of Arrow type, in the order given."""
    return pa.RecordBatch.from_pydict(values)


def texts(column: pa.Array) -> Iterator[str]:
    """The strings of a column, one Python string at a time; null is the empty text."""
    for value in column:
        yield value.as_py() or ""

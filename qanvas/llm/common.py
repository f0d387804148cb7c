"""What several operators of this subpackage share: the shared folder, eager checkpoints, Arrow plumbing, model numerics."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed by the contracts: upper-case letters are lowered in A-Z only.
LOWER_AZ = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
#: Bytes of UTF-8 text to words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after lowering: anything else becomes a space.
ALNUM = bytes(
    b + 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only in local mode, where there is but one
    machine, an unset one is set; on a cluster that raises."""
    at = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = os.environ.get("QANVAS_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="checkpoints-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(at)
    return at


#: Shuffle files of a finished write go at once instead of when the driver next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: One plan at all sizes: only what is marked for it, after a check of its size, is broadcast.
_PLAN = {_CLEANUP: "true", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def cut(df: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Write df to the shared folder as Parquet and go on from the files: survives lost executors, ends the lineage, and
    lets the planner see true sizes. The table stays until `scratch`, if one is given, is told to drop it."""
    spark = df.sparkSession
    path = fresh_path(spark, "table")
    was = {k: spark.conf.get(k, None) for k in _PLAN}
    for k, v in _PLAN.items():
        spark.conf.set(k, v)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    if scratch is not None:
        scratch.paths[id(out)] = (out, path)
    elif _stages:
        _stages[-1].append(path)
    return out


#: Paths of the tables that stages under way have written and nobody drops before.
_stages: list[list[str]] = []


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def tables_dropped(spark: SparkSession) -> Iterator[None]:
    """Tables that are written inside and not dropped there go at the end: results must have been written by then."""
    _stages.append([])
    try:
        yield
    finally:
        for path in _stages.pop():
            delete(spark, path)


class Scratch:
    """Written tables that a job drops as soon as nothing reads them any more."""

    def __init__(self) -> None:
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def cut(self, df: DataFrame) -> DataFrame:
        return cut(df, self)

    def drop(self, *tables: DataFrame) -> None:
        """Delete the files of these tables; others (not of this scratch) are left alone."""
        for table in tables:
            if id(table) in self.paths:
                delete(table.sparkSession, self.paths.pop(id(table))[1])

    def drop_all(self, but: tuple[DataFrame, ...] = ()) -> None:
        keep = {id(t) for t in but}
        self.drop(*[t for i, (t, _) in list(self.paths.items()) if i not in keep])


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def map_arrow(
    df: DataFrame, columns: Iterable[str], per_task: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str
) -> DataFrame:
    """mapInArrow over the named columns only. per_task yields column dicts, which become batches of `schema`."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in per_task(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], type=f.type) if not isinstance(out[f.name], pa.Array) else out[f.name].cast(f.type) for f in target],
                schema=target,
            )
        release()

    return df.select(*columns).mapInArrow(run, schema)


def release() -> None:
    """Give memory that a task has freed back to the system, since Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def lots(batch: pa.RecordBatch, size: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `size` bytes of text each (one row at least)."""
    n = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
    edges = np.cumsum(n)
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(edges, (edges[at - 1] if at else 0) + size)))
        yield batch.slice(at, stop - at)
        at = stop


def shielded(docs: DataFrame, needed: Iterable[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """work(docs), which keeps docs' columns, with all columns but the needed ones under names that work does not use."""
    aside = {c: f"own_{i}" for i, c in enumerate(docs.columns) if c not in set(needed)}
    apart = docs.withColumnsRenamed(aside)
    return work(apart).select(*[f"`{c}`" for c in apart.columns]).withColumnsRenamed({v: k for k, v in aside.items()})


def remainder(column: str, modulus: int):
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % F.lit(modulus)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))

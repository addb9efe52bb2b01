"""Small Spark helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir).

    Where it is unset, a local session gets a temporary folder of its own; on a
    cluster that is an error, because executors don't see each other's disks.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="hustings-"))
        found = context.getCheckpointDir()
    return found


_made: ContextVar[list[DataFrame] | None] = ContextVar("made", default=None)


@contextmanager
def scratch() -> Iterator[None]:
    """Deletes the tables that operators stage inside it at its end, for callers that have written by then what reads them."""
    made: list[DataFrame] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for df in made:
            drop_table(df)


def stage_table(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/hustings-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._hustings_path = path
    if (made := _made.get()) is not None:
        made.append(staged)
    return staged


def drop_table(df: DataFrame) -> None:
    """Delete a table made by stage_table once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._hustings_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def map_arrow(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply function to every Arrow batch of df."""

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = function(batch) if batch.num_rows else None
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(over, schema)


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of consecutive rows with the same keys; the rows come sorted by them, and one group is held at a time."""
    held: list[pa.RecordBatch] = []
    current: tuple | None = None
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        start = 0
        rows = list(zip(*columns, strict=True))
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i] != rows[start]:
                if current is not None and rows[start] != current:
                    yield current, pa.Table.from_batches(held)
                    held = []
                current = rows[start]
                held.append(batch.slice(start, i - start))
                start = i
    if current is not None:
        yield current, pa.Table.from_batches(held)

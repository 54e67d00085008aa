"""What the operators share: reading tables, Arrow batches, stored steps."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType

from repotide.session import materialize

__all__ = ["by_batch", "chunks", "materialize", "prepare", "table", "tokenizer_path"]

# A batch of whole texts must fit a Python worker, however long they are.
BATCH_ROWS = 512


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package, and send them few rows at a time.

    The number is the same for every operator, whichever plan was built last.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the installed package of public vocabularies keeps ``name``."""
    import public_tokenizers

    return public_tokenizers.path(name)


def unused(columns: list[str], name: str) -> str:
    """``name``, or with underscores behind it, so that no column is called like it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def by_batch(
    step: Callable[[pa.RecordBatch], pa.RecordBatch],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Apply ``step`` to each batch that has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return run


def add_column(
    df: DataFrame,
    name: str,
    kind: str,
    values: Callable[[list], pa.Array],
    text: str = "text",
) -> DataFrame:
    """``df`` with column ``name`` computed from whole texts, batch by batch.

    All other columns pass through; a column of that name is replaced.
    """
    prepare(df.sparkSession)
    kept = [c for c in df.columns if c != name]
    at = kept.index(text)
    schema = df.select(*kept).schema.add(name, DataType.fromDDL(kind))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = values(batch.column(at).to_pylist())
        return pa.RecordBatch.from_arrays([*batch.columns, found], names=[*kept, name])

    return df.select(*kept).mapInArrow(by_batch(step), schema)


def chunks(batches: Iterator[pa.RecordBatch], keys: int, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows equal in the first ``keys`` columns, in pieces of at most ``size`` rows.

    The rows must come sorted by those columns; a run may span batches.
    """
    waiting: list[pa.RecordBatch] = []
    rows, at = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        changed = np.zeros(batch.num_rows - 1, bool)
        for column in columns:
            changed |= column[1:] != column[:-1]
        edges = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            here = tuple(column[start] for column in columns)
            if waiting and here != at:
                yield pa.concat_batches(waiting)
                waiting, rows = [], 0
            at = here
            while start < end:
                take = min(end - start, size - rows)
                waiting.append(batch.slice(start, take))
                start, rows = start + take, rows + take
                if rows == size:
                    yield pa.concat_batches(waiting)
                    waiting, rows = [], 0
    if waiting:
        yield pa.concat_batches(waiting)

"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's own removal of an execution's shuffle files once it has ended
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: rows of an Arrow batch; texts and sets of shingles are long, and both sides hold a whole batch
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


def stash(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Cuts the lineage at a table every executor can reach, so a lost executor
    never makes two readers see two versions of it. What was shuffled for the
    table is of no more use once it is written, so Spark is told, for this job, to free
    those files then instead of at the driver's next garbage collection.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    rows = min(int(spark.conf.get(ARROW_ROWS)), BATCH_ROWS)
    with _settings(spark, {SHUFFLE_CLEANUP: "true", ARROW_ROWS: str(rows)}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session options for the time of one job; the caller's come back after it."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def record_batches(batches: Iterator[pa.RecordBatch], column: str,
                   limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Re-slice Arrow batches so that the texts of one slice hold about ``limit`` bytes;
    ``column`` holds the texts, or their sizes.

    A single longer text makes a slice of its own; nothing is cut.
    """
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column(column)
        if not pa.types.is_integer(sizes.type):
            sizes = pc.binary_length(sizes)
        sizes = pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes.astype(np.int64))
        lo = 0
        while lo < batch.num_rows:
            base = total[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, base + limit, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi

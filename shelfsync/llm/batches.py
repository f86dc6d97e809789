"""Helpers shared by the operators: Arrow batches in tasks, shared folders, uniform numbers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from ..plans.base import ready

Rows = Callable[[dict[str, list]], dict[str, list]]


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder that the cluster names; a local session gets one."""
    ready(spark)
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """`df` written to the shared folder and read again: lineage ends in files that outlive executors."""
    folder = shared_folder(df.sparkSession, name)
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def map_columns(df: DataFrame, schema: str, start: Callable[[], Rows]) -> DataFrame:
    """Rows by Arrow batch: `start` runs once in each task and returns a function from columns to columns.

    Batches are cut by characters as well as by rows, so a task holds a few megabytes of text whatever
    the length of single rows.
    """
    kind: StructType = _parse_datatype_string(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = start()
        for batch in batches:
            for part in pieces(batch):
                out = rows({n: c.to_pylist() for n, c in zip(part.schema.names, part.columns)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, kind)


def pieces(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about `most` bytes each, at least one row."""
    step = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    return (F.xxhash64(F.lit(seed), key).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))).cast("double")


def remainder(key: Column, by: int) -> Column:
    """crc32 of the key as text, modulo `by`; null keys count as remainder 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % F.lit(by), F.lit(0).cast("long"))

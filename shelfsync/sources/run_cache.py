"""Frames of one run that several of its steps read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..plans.base import ready


class RunCache:
    """Frames computed once, written to the shared folder and read again from there until the run ends.

    As a context it is released at the end, whether the run succeeds or fails.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.folder = f"{(root or spark.conf.get('spark.checkpoint.dir', None) or ready(spark)).rstrip('/')}/run-{uuid.uuid4().hex}"
        self._frames: dict[str, DataFrame] = {}

    def __enter__(self) -> RunCache:
        return self

    def __exit__(self, *_) -> None:
        self.release()

    def keep(self, df: DataFrame, name: str | None = None) -> DataFrame:
        """``df`` as written. A second call with the same name gets the same frame and computes nothing."""
        name = name or f"frame {len(self._frames)}"
        if name not in self._frames:
            path = f"{self.folder}/{len(self._frames):04d}"
            void = {f.name: F.col(f.name).cast("string") for f in df.schema.fields if isinstance(f.dataType, T.NullType)}
            df = df.withColumns(void) if void else df
            df.write.parquet(path)
            self._frames[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._frames[name]

    def release(self) -> None:
        """Delete what was kept. Frames of the run must not be read after it."""
        self._frames.clear()
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

"""Target tables as parquet snapshots.

A table is a folder of numbered snapshot folders. The newest one that Spark has marked complete
is the table; a job that fails or loses its driver leaves the one before in place. Readers of an
older snapshot are not disturbed by a new one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

_PREFIX = "snapshot="
_CLAIMS = "_claims"


class _Tables(Mapping):
    def __init__(self, store: SnapshotStore):
        self._store = store

    def __getitem__(self, name: str) -> DataFrame:
        if not self._store.exists(name):
            raise KeyError(name)
        return self._store.read(name)

    def __iter__(self):
        return iter(self._store.names())

    def __len__(self) -> int:
        return len(self._store.names())


class SnapshotStore:
    """Tables below one root folder, which all executors must be able to reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _list(self, *parts: str) -> list[str]:
        path = self._path(*parts)
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []

    def _numbers(self, name: str, complete: bool) -> list[int]:
        path = self._path(name)
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [int(n[len(_PREFIX):]) for n in self._list(name) if n.startswith(_PREFIX)]
        done = lambda n: system.exists(self._path(name, f"{_PREFIX}{n:08d}", "_SUCCESS"))
        return sorted(n for n in found if not complete or done(n))

    def names(self) -> list[str]:
        return sorted(n for n in self._list() if self._numbers(n, complete=True))

    def exists(self, name: str) -> bool:
        return bool(self._numbers(name, complete=True))

    def read(self, name: str) -> DataFrame:
        """Current content of a table."""
        current = self._numbers(name, complete=True)[-1]
        df = self.spark.read.parquet(f"{self.root}/{name}/{_PREFIX}{current:08d}")
        return df.drop(*[c for c in df.columns if c.startswith("__")])

    def _claim(self, name: str) -> int:
        """A number for a new snapshot that no other writer has. Claims are files that are created exclusively."""
        number = max(self._numbers(name, complete=False), default=0) + 1
        while True:
            path = self._path(name, _CLAIMS, f"{number:08d}")
            system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            try:
                system.create(path, False).close()
                return number
            except Exception:
                if not system.exists(path):
                    raise
                number += 1

    def write(self, name: str, df: DataFrame, drop_on_read: Sequence[str] = ()) -> DataFrame:
        """Write a new snapshot and return it as written.

        Columns in ``drop_on_read`` are stored with the snapshot but are not part of the table.
        """
        number = self._claim(name)
        path = f"{self.root}/{name}/{_PREFIX}{number:08d}"
        df.withColumnsRenamed({c: f"__{c}" for c in drop_on_read}).write.mode("error").parquet(path)
        return self.spark.read.parquet(path).withColumnsRenamed({f"__{c}": c for c in drop_on_read})

    def drop_old(self, name: str, keep: int = 2) -> int:
        """Delete all but the newest complete snapshots, and the incomplete ones older than those; returns how many went."""
        complete = self._numbers(name, complete=True)
        stay = complete[-max(1, keep) :]
        old = [n for n in self._numbers(name, complete=False) if stay and n < stay[-1] and n not in stay]
        for number in old:
            path = self._path(name, f"{_PREFIX}{number:08d}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return len(old)

    def tables(self) -> Mapping[str, DataFrame]:
        """All tables by name; each is opened when it is asked for."""
        return _Tables(self)

    def truncate_all(self, names: Sequence[str] | None = None) -> DataFrame:
        """Empty the tables; the result reports the rows removed from each."""
        from ..operators.schema import table_counts

        old: Mapping[str, DataFrame] = {n: self.read(n) for n in (names or self.names())}
        counts = table_counts(old).select("table", F.col("rows").alias("removed"))
        for name, df in old.items():
            self.write(name, df.limit(0))
        return counts

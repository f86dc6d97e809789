"""Tables in key buckets, and commits over several tables.

A commit is one small file that names the current state of every table; the newest complete one counts, so the tables of
a transaction change together or not at all. The rows of a table are files of key buckets, listed in a manifest (a parquet
table). A change writes the buckets it touches and a manifest in which all other files are carried over. Blind changes are
added as files of their own, sorted by key, which readers merge until they are compacted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.ordering import last_wins

MANIFEST = "bucket int, seq bigint, path string, rows bigint"
BUCKET, SEQ = "__bucket", "__seq"


class CommitConflict(RuntimeError):
    """Another writer has changed a table of this transaction."""


@dataclass(frozen=True)
class TableState:
    """What a commit says of a table. ``deltas`` maps a sequence number to the columns its rows set."""

    schema: str
    manifest: str
    buckets: int
    keys: tuple[str, ...] = ()
    by: tuple[str, ...] = ()
    seq: int = 0
    deltas: Mapping[str, Sequence[str]] = field(default_factory=dict)
    drop: tuple[str, ...] = ()

    def fields(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def shown(self) -> T.StructType:
        return T.StructType([f for f in self.fields() if f.name not in self.drop])

    def bucket(self, prefix: str = "") -> Column:
        """Number of the bucket of a row whose columns have the types of the table."""
        kinds = self.fields()
        parts = [F.col(f"{prefix}{c}").cast(kinds[c].dataType) for c in self.by]
        return F.pmod(F.xxhash64(*parts), F.lit(self.buckets)).cast("int") if parts else F.lit(0)


class TableStore:
    """Tables below one root folder that all executors can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- commits ---

    def _system(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _commits(self) -> list[int]:
        system, path = self._system(f"{self.root}/_commits")
        names = [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _commit_file(self, number: int) -> str:
        return f"{self.root}/_commits/{number:08d}.json"

    def _load(self, number: int) -> dict[str, TableState] | None:
        system, path = self._system(self._commit_file(number))
        stream = system.open(path)
        try:
            content = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            tables = json.loads(content)
        except ValueError:
            return None  # its writer died within the write
        tuples = ("keys", "by", "drop")
        return {n: TableState(**{k: tuple(v) if k in tuples else v for k, v in s.items()}) for n, s in tables.items()}

    def current(self) -> tuple[int, dict[str, TableState]]:
        """Number and content of the newest complete commit."""
        for number in reversed(self._commits()):
            tables = self._load(number)
            if tables is not None:
                return number, tables
        return 0, {}

    def _publish(self, based_on: Mapping[str, TableState], changed: Mapping[str, TableState]) -> int:
        """Write the commit file. It is created exclusively, so of two writers one has to look at the other's commit first."""
        while True:
            _, now = self.current()
            lost = [n for n in changed if now.get(n) != based_on.get(n)]
            if lost:
                raise CommitConflict(f"changed by another writer: {', '.join(sorted(lost))}")
            number = max(self._commits(), default=0) + 1
            system, path = self._system(self._commit_file(number))
            try:
                stream = system.create(path, False)
            except Exception as error:
                if system.exists(path):
                    continue
                raise error
            content = json.dumps({n: asdict(s) for n, s in {**now, **changed}.items()})
            stream.write(bytearray(content.encode()))
            stream.close()
            return number

    def begin(self) -> Transaction:
        return Transaction(self)

    # --- reading ---

    def names(self) -> list[str]:
        return sorted(self.current()[1])

    def exists(self, name: str) -> bool:
        return name in self.current()[1]

    def state(self, name: str) -> TableState:
        tables = self.current()[1]
        if name not in tables:
            raise KeyError(name)
        return tables[name]

    def files(self, name: str, state: TableState | None = None) -> DataFrame:
        """The manifest of a table: bucket, seq (0 for merged rows), path, rows."""
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/{(state or self.state(name)).manifest}")

    def read(self, name: str, buckets: Iterable[int] | None = None, state: TableState | None = None) -> DataFrame:
        """Rows of a table, or of some of its buckets only. Files added blindly are merged in their buckets."""
        state = state or self.state(name)
        kinds = state.shown()
        manifest = self.files(name, state)
        if buckets is not None:
            manifest = manifest.where(F.col("bucket").isin([int(b) for b in buckets]))
        rows = manifest.select("bucket", "seq", "path").collect()
        late = {r["bucket"] for r in rows if r["seq"]}
        plain = self._rows([r["path"] for r in rows if r["bucket"] not in late], kinds)
        if not late:
            return plain
        base = self._rows([r["path"] for r in rows if r["bucket"] in late and not r["seq"]], kinds)
        frames = [_marked(base, 0, base.columns)]
        for seq in sorted({r["seq"] for r in rows if r["seq"]}):
            found = self._rows([r["path"] for r in rows if r["seq"] == seq], kinds)
            frames.append(_marked(found, seq, state.deltas[str(seq)]))
        return plain.unionByName(_merged(reduce(DataFrame.unionByName, frames), kinds.names, state.keys))

    def _rows(self, paths: Sequence[str], kinds: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], kinds)
        return self.spark.read.schema(kinds).parquet(*[f"{self.root}/{p}" for p in paths])

    def tables(self) -> Mapping[str, DataFrame]:
        """All tables of the commit that is current now; each is opened when it is asked for."""
        return _Tables(self, self.current()[1])

    # --- single changes, each a commit of its own ---

    def create(self, name: str, df: DataFrame, keys: Sequence[str], buckets: int, by: Sequence[str] | None = None) -> DataFrame:
        with self.begin() as change:
            return change.create(name, df, keys, buckets, by)

    def write(self, name: str, df: DataFrame, drop_on_read: Sequence[str] = ()) -> DataFrame:
        with self.begin() as change:
            return change.write(name, df, drop_on_read)

    def append_delta(self, name: str, changes: DataFrame, order: Sequence[str] = ()) -> None:
        with self.begin() as change:
            change.append_delta(name, changes, order)

    def compact(self, name: str, most: int = 0) -> int:
        """Merge the added files of buckets that have more than ``most`` of them; returns the number of buckets rewritten."""
        with self.begin() as change:
            return change.compact(name, most)

    def drop_old(self, keep: int = 2) -> int:
        """Delete files that none of the newest ``keep`` commits names; returns how many folders went."""
        numbers = [n for n in self._commits() if self._load(n) is not None][-max(1, keep) :]
        states = [s for n in numbers for s in self._load(n).values()]
        used = {s.manifest.split("/")[-1] for s in states}
        for manifest in {s.manifest for s in states}:
            paths = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/{manifest}")
            used |= {r[0] for r in paths.select(F.element_at(F.split("path", "/"), 2)).distinct().collect()}
        gone = 0
        system, root = self._system(self.root)
        for table in system.listStatus(root):
            name = table.getPath().getName()
            if name.startswith("_"):
                continue
            for entry in system.listStatus(table.getPath()):
                if entry.getPath().getName() not in used:
                    system.delete(entry.getPath(), True)
                    gone += 1
        for number in self._commits():
            if numbers and number < numbers[0]:
                system.delete(self._system(self._commit_file(number))[1], False)
        return gone


class _Tables(Mapping):
    def __init__(self, store: TableStore, states: Mapping[str, TableState]):
        self._store, self._states = store, states

    def __getitem__(self, name: str) -> DataFrame:
        return self._store.read(name, state=self._states[name])

    def __iter__(self):
        return iter(sorted(self._states))

    def __len__(self) -> int:
        return len(self._states)


class Transaction:
    """Changes to several tables that become visible together. It reads its own changes.

    As a context it commits at the end, unless an error leaves it: then nothing of it is ever seen.
    """

    def __init__(self, store: TableStore):
        self.store, self.spark = store, store.spark
        self.before = store.current()[1]
        self.changed: dict[str, TableState] = {}

    def __enter__(self) -> Transaction:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.commit()

    def commit(self) -> int | None:
        return self.store._publish(self.before, self.changed) if self.changed else None

    def state(self, name: str) -> TableState:
        return self.changed[name] if name in self.changed else self.before[name]

    def exists(self, name: str) -> bool:
        return name in self.changed or name in self.before

    def read(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        return self.store.read(name, buckets, self.state(name))

    def tables(self) -> Mapping[str, DataFrame]:
        return _Tables(self.store, {**self.before, **self.changed})

    def create(self, name: str, df: DataFrame, keys: Sequence[str], buckets: int, by: Sequence[str] | None = None) -> DataFrame:
        """A table in buckets by its key, or by some columns of the key."""
        by = tuple(keys if by is None else by)
        if not set(by) <= set(keys) or not by or buckets < 1:
            raise ValueError("buckets go by columns of the key")
        state = TableState(df.schema.json(), "", buckets, tuple(keys), by)
        return self._put(name, state, df, [], None)

    def write(self, name: str, df: DataFrame, drop_on_read: Sequence[str] = ()) -> DataFrame:
        """New content of a whole table; one that is in buckets stays so. Columns in ``drop_on_read`` are stored only."""
        old = self.state(name) if self.exists(name) else TableState("", "", 1)
        state = replace(old, schema=df.schema.json(), drop=tuple(drop_on_read), deltas={}, seq=0)
        return self._put(name, state, df, [], None)

    def replace_buckets(self, name: str, df: DataFrame, buckets: Sequence[int], drop_on_read: Sequence[str] = ()) -> DataFrame:
        """New content of some buckets; the files of all others are carried over. Returns what was written."""
        old = self.state(name)
        kinds = {f.name: f.dataType for f in old.shown()}
        rows = df.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()], *drop_on_read)
        wide = T.StructType([*old.shown(), *(f for f in rows.schema if f.name in drop_on_read)])
        kept = self.store.files(name, old).where(~F.col("bucket").isin([int(b) for b in buckets]))
        return self._put(name, replace(old, schema=wide.json(), drop=tuple(drop_on_read)), rows, [kept], None)

    def append_delta(self, name: str, changes: DataFrame, order: Sequence[str] = ()) -> None:
        """Rows by key that readers merge over what is stored; the stored rows are not looked at.

        Of changes with one key the last in ``order`` counts. Columns the changes lack keep their values.
        """
        state = self.state(name)
        kinds = {f.name: f.dataType for f in state.shown()}
        columns = [c for c in changes.columns if c in kinds]
        if not state.keys or not set(state.keys) <= set(columns):
            raise ValueError("the table has no key, or the changes lack it")
        filled = [F.col(k).isNotNull() for k in state.keys]
        rows = last_wins(changes.where(reduce(Column.__and__, filled)), list(state.keys), order)
        rows = rows.select(*[F.col(c).cast(kinds[c]).alias(c) for c in columns])
        seq = state.seq + 1
        grown = replace(state, seq=seq, deltas={**state.deltas, str(seq): columns})
        self._put(name, grown, rows, [self.store.files(name, state)], seq)

    def compact(self, name: str, most: int = 0) -> int:
        state = self.state(name)
        files = self.store.files(name, state)
        late = files.groupBy("bucket").agg(F.countDistinct(F.when(F.col("seq") > 0, F.col("seq"))).alias("n")).where(F.col("n") > most)
        buckets = [r[0] for r in late.select("bucket").collect()]
        if buckets:
            self.replace_buckets(name, self.read(name, buckets), buckets)
            left = {str(r[0]) for r in self.store.files(name, self.state(name)).select("seq").distinct().collect()}
            now = self.changed[name]
            self.changed[name] = replace(now, deltas={k: v for k, v in now.deltas.items() if k in left})
        return len(buckets)

    def _put(self, name: str, state: TableState, rows: DataFrame, kept: Sequence[DataFrame], seq: int | None) -> DataFrame:
        """Write rows by bucket, sorted by key, then the manifest with the files that are kept."""
        folder = f"{name}/data-{uuid.uuid4().hex}"
        order = [k for k in state.keys if k in rows.columns]
        placed = rows.withColumn(BUCKET, state.bucket())
        if state.buckets > 1:
            placed = placed.hint("rebalance", F.col(BUCKET))  # a large bucket is written by several tasks, as several files
        placed = placed.sortWithinPartitions(BUCKET, *order) if order else placed
        placed.write.partitionBy(BUCKET).parquet(f"{self.store.root}/{folder}")
        kinds = T.StructType([*rows.schema, T.StructField(BUCKET, T.IntegerType())])
        written = self.spark.read.schema(kinds).parquet(f"{self.store.root}/{folder}")
        files = written.groupBy(F.col(BUCKET).alias("bucket"), F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
        path = F.regexp_extract("file", f"({folder}/.*)$", 1).alias("path")
        files = files.select("bucket", F.lit(seq or 0).cast("bigint").alias("seq"), path, "rows")
        manifest = f"{name}/manifest-{uuid.uuid4().hex}"
        reduce(DataFrame.unionByName, [files, *kept]).write.parquet(f"{self.store.root}/{manifest}")
        self.changed[name] = replace(state, manifest=manifest)
        return written.drop(BUCKET)


def _marked(rows: DataFrame, seq: int, columns: Sequence[str]) -> DataFrame:
    return rows.withColumn(SEQ, F.lit(seq).cast("bigint")).withColumns(
        {f"__set_{c}": F.lit(seq if c in columns else None).cast("bigint") for c in rows.columns if not c.startswith("__")}
    )


def _merged(rows: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row for each key: every column from the newest row that sets it. Rows without a whole key stay as they are."""
    values = [F.max_by(c, f"__set_{c}").alias(c) for c in columns if c not in keys]
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    merged = rows.where(whole).groupBy(*keys).agg(*(values or [F.count("*").alias("__n")])).select(*columns)
    return merged.unionByName(rows.where(~whole).select(*columns))

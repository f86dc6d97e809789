"""Folders as tables: file inventories, and records kept as folders of text files."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.numbers import iso_time
from ..functions.paths import ext, mime_from_ext, relative_path, stem


def _bare_path() -> Column:
    """Path without a scheme for local files, as the caller wrote it."""
    return F.regexp_replace("path", "^file:/*", "/")


def _files(spark: SparkSession, path: str, recursive: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    return reader.load(path)


def scan_files(spark: SparkSession, path: str, include_ext: Sequence[str] = (), recursive: bool = True) -> DataFrame:
    """Inventory with one row per file; contents are not read."""
    base = path if "://" in path else "/" + path.removeprefix("file:").lstrip("/")
    name = F.substring_index(F.col("path"), "/", -1)
    rows = _files(spark, path, recursive).select(
        _bare_path().alias("path"), name.alias("file_name"), F.col("length").alias("size"), "modificationTime"
    )
    extension = ext(F.col("file_name"))
    if include_ext:
        rows = rows.where(extension.isin(*[e.lower() for e in include_ext]))
    return rows.select(
        "path",
        relative_path(F.col("path"), base).alias("relative_path"),
        F.regexp_replace("path", "/[^/]*$", "").alias("dir"),
        "file_name",
        stem(F.col("file_name")).alias("name_stem"),
        extension.alias("ext"),
        "size",
        iso_time(F.date_trunc("second", "modificationTime")).alias("mtime"),
        mime_from_ext(extension).alias("mime"),
    )


@dataclass(frozen=True)
class FolderTable:
    """Table kept as ``<base>/<folder>/<key>/<field>.txt``. Two or more keys share the folder name."""

    folder: str
    keys: Sequence[str]
    fields: Sequence[str] = ()
    separator: str = "__"
    extension: str = ".txt"
    encoding: str = "utf-8"
    filename_case: str = "preserve"
    sanitize: bool = False

    def field_file(self, name: str) -> str:
        safe = re.sub(r"[^A-Za-z0-9_\-]", "_", name) if self.sanitize else name
        cased = {"lower": safe.lower(), "upper": safe.upper()}.get(self.filename_case, safe)
        return cased + self.extension

    def in_case(self, c: Column) -> Column:
        return {"lower": F.lower(c), "upper": F.upper(c)}.get(self.filename_case, c)


def subfolders(path: str, size: int = 10_000) -> Iterator[list[str]]:
    """Names of the folders directly below one, in lists of at most ``size``. A local listing is read as it goes on."""
    if path.startswith("/") or path.startswith("file:"):
        with os.scandir("/" + path.removeprefix("file:").lstrip("/")) as entries:
            names = (e.name for e in entries if e.is_dir())
            while part := list(islice(names, size)):
                yield part
        return
    system, at = fs.FileSystem.from_uri(path)
    found = [f.base_name for f in system.get_file_info(fs.FileSelector(at)) if f.type == fs.FileType.Directory]
    yield from (found[i : i + size] for i in range(0, len(found), size))


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for above, path in zip(*(c.to_pylist() for c in batch.columns)):
            for names in subfolders(path):
                paths = [f"{path}/{n}" for n in names]
                inner = [f"{above}/{n}" if above else n for n in names]
                yield pa.RecordBatch.from_arrays([pa.array(inner, pa.string()), pa.array(paths, pa.string())], names=["folder", "path"])


def list_folders(spark: SparkSession, base: str, depth: int = 1) -> DataFrame:
    """All folders down to a depth, with and without files: folder (relative to ``base``), path and level.

    Every level is listed by tasks, over which the folders found on the level before are spread; the names never pass
    through the driver.
    """
    level = spark.createDataFrame([("", base.rstrip("/"))], "folder string, path string")
    levels = []
    for n in range(1, depth + 1):
        level = level if n == 1 else level.repartition(F.col("path"))
        level = level.mapInArrow(_listed, "folder string, path string")
        levels.append(level.withColumn("level", F.lit(n)))
    return reduce(DataFrame.unionByName, levels)


def _task_readable(base: str) -> bool:
    """Whether tasks can list the folder themselves. Stores that only Spark's own readers know are listed by the driver."""
    if base.startswith("/") or base.startswith("file:"):
        return True
    try:
        fs.FileSystem.from_uri(base)
    except (OSError, ValueError):
        return False
    return True


#: Bytes of contents after which a task hands on the records it has read.
BATCH_BYTES = 8 << 20


def _seen(name: str) -> bool:
    """Whether Spark's file sources would read a file of this name."""
    if name.startswith(("_common_metadata", "_metadata")):
        return True
    return not (name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"))


def _file_names(path: str) -> list[str]:
    """Names of the files directly below a folder."""
    if path.startswith("/") or path.startswith("file:"):
        with os.scandir("/" + path.removeprefix("file:").lstrip("/")) as entries:
            return [e.name for e in entries if _seen(e.name) and e.is_file()]
    system, at = fs.FileSystem.from_uri(path)
    return [f.base_name for f in system.get_file_info(fs.FileSelector(at)) if f.type == fs.FileType.File and _seen(f.base_name)]


def _content(path: str) -> bytes:
    if path.startswith("/") or path.startswith("file:"):
        with open("/" + path.removeprefix("file:").lstrip("/"), "rb") as file:
            return file.read()
    system, at = fs.FileSystem.from_uri(path)
    with system.open_input_stream(at) as stream:
        return stream.read()


def _stem(name: str) -> str:
    return name.rpartition(".")[0] if "." in name else name


def _reading(pick: Callable[[list[str]], list[str | None] | None], width: int):
    """Records with the contents of the files that ``pick`` finds for their columns among the names in their folder.

    Names that come with a record are not listed again.
    """
    schema = pa.schema([("record", pa.string()), *((f"v{i}", pa.binary()) for i in range(width))])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for part in batches:
            for record, path, *names in zip(*(c.to_pylist() for c in part.columns)):
                chosen = pick(names[0] if names else _file_names(path))
                if chosen is None:
                    continue
                rows.append((record, *[None if n is None else _content(f"{path}/{n}") for n in chosen]))
                size += 100 + sum(len(v) for v in rows[-1][1:] if v is not None)
                if size >= BATCH_BYTES:
                    yield batch(rows)
                    rows, size = [], 0
        if rows:
            yield batch(rows)

    return read


def _with_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = pa.array([_file_names(path) for path in batch.column(1).to_pylist()], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([*batch.columns, names], names=["folder", "path", "names"])


def _names_found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = {_stem(n) for found in batch.column(0).to_pylist() for n in found}
        yield pa.RecordBatch.from_arrays([pa.array(sorted(names), pa.string())], names=["name"])


def _spread(spark: SparkSession, root: str) -> DataFrame:
    """The record folders (name and path), dealt over tasks that look into them."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return list_folders(spark, root).select("folder", "path").repartition(parts, "path")


def _read_records(folders: DataFrame, spec: FolderTable, pick, columns: Sequence[str]) -> DataFrame:
    """One row per record folder: record and the decoded texts. Tasks read the files, and list folders that come without names."""
    schema = ", ".join(["record string", *(f"v{i} binary" for i in range(len(columns)))])
    rows = folders.mapInArrow(_reading(pick, len(columns)), schema)
    return rows.select("record", *[_text(F.col(f"v{i}"), spec).alias(c) for i, c in enumerate(columns)])


def _text(content: Column, spec: FolderTable) -> Column:
    return F.rtrim(F.decode(content, spec.encoding), F.lit("\r\n"))


def _record_files(spark: SparkSession, root: str, spec: FolderTable, pattern: str) -> DataFrame:
    """Files directly below a record folder as Spark's reader finds them: record, file and decoded text."""
    parts = F.split("path", "/")
    rows = spark.read.format("binaryFile").load(f"{root}/*/{pattern}")
    return rows.select(
        F.element_at(parts, -2).alias("record"), F.element_at(parts, -1).alias("file"), _text(F.col("content"), spec).alias("text")
    )


def _record_folders(spark: SparkSession, root: str) -> DataFrame:
    """Names of the record folders, also those without files, as the driver lists them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    names = [(s.getPath().getName(),) for s in found if s.isDirectory()]
    return spark.createDataFrame(names, "record string")


def _keys(rows: DataFrame, spec: FolderTable) -> tuple[DataFrame, list[Column]]:
    rows = rows.where(~F.col("record").startswith("."))
    if len(spec.keys) == 1:
        return rows, [spec.in_case(F.col("record")).alias(spec.keys[0])]
    parts = F.split("record", re.escape(spec.separator))
    return rows.where(F.size(parts) == len(spec.keys)), [
        spec.in_case(F.get(parts, F.lit(i))).alias(k) for i, k in enumerate(spec.keys)
    ]


def scan_folder_table(spark: SparkSession, base: str, spec: FolderTable, empty_folders: bool = True) -> DataFrame:
    """One row per record folder; a missing file is null.

    Folders are listed and files are read by tasks, each record whole by one of them, so neither names nor texts pass
    through the driver or a shuffle. Only of stores that nothing but Spark's own readers knows the driver lists the files.
    Folders without files are left out with ``empty_folders=False``.
    """
    if not spec.keys:
        raise ValueError(f"folder table {spec.folder} needs at least one key")
    root = f"{base.rstrip('/')}/{spec.folder}"
    wanted, extension = [spec.field_file(f) for f in spec.fields], spec.extension

    def pick(names: list[str]) -> list[str | None] | None:
        if not empty_folders and not any(n.endswith(extension) for n in names):
            return None
        return [w if w in names else None for w in wanted]

    if _task_readable(root):
        rows = _read_records(_spread(spark, root), spec, pick, spec.fields)
    else:
        files = _record_files(spark, root, spec, f"*{extension}")
        if empty_folders:
            files = files.unionByName(_record_folders(spark, root), allowMissingColumns=True)
        values = [F.max(F.when(F.col("file") == spec.field_file(f), F.col("text"))).alias(f) for f in spec.fields]
        rows = files.groupBy("record").agg(*values) if values else files.select("record").distinct()
    rows, keys = _keys(rows, spec)
    return rows.select(*keys, *spec.fields)


#: Columns that a folder table read without a declaration may have.
MOST_FIELDS = 5000


def scan_folder_table_dynamic(
    spark: SparkSession, base: str, spec: FolderTable, names: Sequence[str] | None = None, empty_folders: bool = True
) -> DataFrame:
    """Every record folder, with one column per file name found anywhere in the table.

    A column is named like its files without their extension, whatever that is; of two files with one name the last
    by extension counts. Declare ``names`` to fix the columns and save the pass that looks for them; without them
    more than MOST_FIELDS different names are refused. That pass lists every folder once and keeps the names in the checkpoint
    folder; the rows are those of its listing.
    """
    root = f"{base.rstrip('/')}/{spec.folder}"
    in_tasks = _task_readable(root)
    folders = _spread(spark, root) if in_tasks else None
    files = None if in_tasks else _record_files(spark, root, spec, "*").withColumn("name", stem(F.col("file")))
    if names is None:
        if in_tasks:
            folders = folders.mapInArrow(_with_names, "folder string, path string, names array<string>").checkpoint()
            every = folders.select("names").mapInArrow(_names_found, "name string")
        else:
            every = files.select("name")
        found = every.distinct().orderBy("name").limit(MOST_FIELDS + 1).collect()
        if len(found) > MOST_FIELDS:
            raise ValueError(f"folder table {spec.folder} has more than {MOST_FIELDS} different file names")
        names = [r["name"] for r in found]
    columns = list(names)

    def pick(present: list[str]) -> list[str | None] | None:
        if not empty_folders and not present:
            return None
        last = {_stem(n): n for n in sorted(present)}
        return [last.get(c) for c in columns]

    if in_tasks:
        rows = _read_records(folders, spec, pick, columns)
    else:
        if empty_folders:
            files = files.unionByName(_record_folders(spark, root), allowMissingColumns=True)
        values = [F.max_by(F.when(F.col("name") == n, F.col("text")), F.when(F.col("name") == n, F.col("file"))).alias(n) for n in columns]
        rows = files.groupBy("record").agg(*values) if values else files.select("record").distinct()
    rows, keys = _keys(rows, spec)
    return rows.select(*keys, *[F.col(f"`{n}`") for n in columns])

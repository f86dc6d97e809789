"""Queries for file inventories, copy plans, folder tables and the upload queue."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from ..functions import paths, text
from ..operators import inventory, sync, work_queue
from ..operators.work_queue import QueueSpec
from ..sources.files import FolderTable, scan_files, scan_folder_table, scan_folder_table_dynamic
from . import catalog as cat
from .base import query, scratch, table

NOW = "2024-06-01T00:00:00+00:00"
_MTIME = "2024-01-02T03:04:05+00:00"
_NAME = r"regexp_extract(replace(path, '\', '/'), '([^/]*)/*$', 1)"
_EXT = "CASE WHEN contains({0}, '.') THEN lower(regexp_extract({0}, '([^.]*)$', 1)) ELSE '' END"


def _inventory(spark, d):
    """The media files as an inventory; names repeat, as they do in folders."""
    path = text.forward_slashes(F.col("path"))
    name = text.basename(F.col("path"))
    return cat.media(spark, d).select(
        path.alias("path"), path.alias("relative_path"), F.lit("srcFiles").alias("dir"), name.alias("file_name"),
        paths.stem(name).alias("name_stem"), paths.ext(name).alias("ext"), "size", F.lit(_MTIME).alias("mtime"),
        paths.mime_from_ext(paths.ext(name)).alias("mime"), "quality", "media_id",
    )


_VAULT_SQL = rf"""
v AS (SELECT {_NAME} AS file_name, max('{_MTIME}' || '|' || (size - CASE WHEN quality = 0 THEN 1 ELSE 0 END)) AS checksum,
             max(size - CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS size, CAST(1 AS INTEGER) AS change, 'before' AS stored_at
      FROM m WHERE quality IS NOT NULL GROUP BY 1)"""


def _vault(spark, d):
    size = F.col("size") - F.when(F.col("quality") == 0, 1).otherwise(0)
    rows = _inventory(spark, d).where("quality is not null").groupBy("file_name").agg(
        F.max(F.concat(F.lit(_MTIME + "|"), size.cast("string"))).alias("checksum"), F.max(size).alias("size")
    )
    known = ("file_name", "checksum", "size")
    empty = {n: F.lit(None).cast("string").alias(n) for n in inventory.VAULT_COLUMNS}
    ext = paths.ext(F.col("file_name"))
    own = {
        "mime": paths.mime_from_ext(ext).alias("mime"), "change": F.lit(1).alias("change"), "stored_at": F.lit("before").alias("stored_at"),
    }
    return rows.select(*[F.col(n) if n in known else own.get(n, empty[n]) for n in inventory.VAULT_COLUMNS])


@query("file_sync", rf"""
WITH m AS ({cat.MEDIA}), {_VAULT_SQL},
i AS (SELECT {_NAME} AS file_name, replace(path, '\', '/') AS source_path, size, '{_MTIME}' || '|' || size AS checksum FROM m),
w AS (SELECT *, lag(checksum) OVER (PARTITION BY file_name ORDER BY source_path) AS before, row_number() OVER (PARTITION BY file_name ORDER BY source_path DESC) AS r FROM i),
j AS (SELECT coalesce(w.file_name, v.file_name) AS file_name, w.file_name IS NOT NULL AS is_new, v.file_name IS NOT NULL AS is_old, source_path,
             CASE WHEN w.file_name IS NOT NULL THEN w.checksum ELSE v.checksum END AS checksum, w.checksum AS new_sum, v.checksum AS old_sum, before FROM (SELECT * FROM w WHERE r = 1) w FULL JOIN v ON w.file_name = v.file_name),
a AS (SELECT *, CASE WHEN NOT is_new THEN 'kept' WHEN before IS NOT NULL THEN CASE WHEN before <> new_sum THEN 'update' ELSE 'unchanged' END
                     WHEN NOT is_old THEN 'insert' WHEN new_sum <> old_sum THEN 'update' ELSE 'unchanged' END AS action FROM j)
SELECT file_name, checksum, source_path, trim(regexp_replace(file_name, '[^A-Za-z0-9._-]+', '_', 'g'), ' ._-') AS stored_file,
       CAST(CASE action WHEN 'unchanged' THEN 0 ELSE 1 END AS INTEGER) AS change,
       CASE action WHEN 'unchanged' THEN NULL ELSE '{NOW}' END AS stored_at, action FROM a WHERE is_new""")
def file_sync(spark, d):
    rows = sync.classify_entity(inventory.file_entity("vault", NOW), _inventory(spark, d), _vault(spark, d))
    return rows.where(F.col("action") != sync.KEPT).select(
        "file_name", "checksum", "source_path", "stored_file", "change", "stored_at", "action"
    )


@query("copy_plan", """
SELECT 'src/' || doc_id AS source, 'vault/' || doc_id AS target FROM documents LEFT JOIN labels USING (doc_id)
WHERE n_chars > 2000 OR quality IS NULL""")
def copy_plan(spark, d):
    doc = F.col("doc_id").cast("string")
    files = table(spark, d, "documents").select(
        F.concat(F.lit("src/"), doc).alias("source"), F.concat(F.lit("vault/"), doc).alias("target"), (F.col("n_chars") > 2000).alias("changed")
    )
    present = table(spark, d, "labels").select(F.concat(F.lit("vault/"), doc).alias("target"))
    return work_queue.file_copy_plan(files, present)


@query("copy_size_guard", """
SELECT 'plan' AS part, CASE WHEN n_chars > 1500 THEN 'too_large' ELSE 'copied' END AS outcome, CAST(count(*) AS BIGINT) AS files, CAST(sum(n_chars) AS BIGINT) AS bytes
FROM documents GROUP BY 2
UNION ALL SELECT 'summary', 'errors ' || count(*) FILTER (n_chars > 1500), CAST(count(*) FILTER (n_chars <= 1500) AS BIGINT),
       CAST(sum(n_chars) FILTER (n_chars <= 1500) AS BIGINT) FROM documents""")
def copy_size_guard(spark, d):
    doc = F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"))
    files = table(spark, d, "documents").select(
        F.concat(F.lit("/in/"), doc).alias("path"), doc.alias("relative_path"), F.col("n_chars").alias("size")
    )
    plan = work_queue.tree_copy_plan(files, "/out/", max_size=1500)
    groups = plan.groupBy("outcome").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
    total = work_queue.tree_copy_summary(plan).select(
        F.lit("summary").alias("part"), F.concat(F.lit("errors "), F.col("errors").cast("string")).alias("outcome"), "files", "bytes"
    )
    return groups.select(F.lit("plan").alias("part"), "outcome", "files", "bytes").unionByName(total)


_QUEUE_SQL = f"""
q AS (SELECT media_id, CASE WHEN size > 3000 THEN '' ELSE source || '-' || media_id END AS file_name, CASE WHEN toxic = 0 THEN '' WHEN toxic = 1 THEN 'st-' || media_id END AS stored_file,
             CASE WHEN lang = 'de' THEN '/' || source || '/' WHEN lang = 'fr' THEN NULL ELSE '' END AS stored_path, md5(path) AS hash, 'T' || media_id AS title,
             CAST(coalesce(quality, 1) AS INTEGER) AS upload, kind FROM ({cat.MEDIA}))"""


def _queue(spark, d):
    doc, lang = F.col("media_id").cast("string"), F.col("lang")
    return cat.media(spark, d).select(
        "media_id",
        F.when(F.col("size") > 3000, "").otherwise(F.concat("source", F.lit("-"), doc)).alias("file_name"),
        F.when(F.col("toxic") == 0, "").when(F.col("toxic") == 1, F.concat(F.lit("st-"), doc)).alias("stored_file"),
        F.when(lang == "de", F.concat(F.lit("/"), "source", F.lit("/"))).when(lang != "fr", "").alias("stored_path"),
        F.md5("path").alias("hash"), F.concat(F.lit("T"), doc).alias("title"), F.coalesce("quality", F.lit(1)).cast("int").alias("upload"), "kind",
    )


_IMAGES = QueueSpec(kind_value="image")
_DOCUMENTS = QueueSpec(kind_value="document", title="title")

_PENDING_SQL = f"""{_QUEUE_SQL},
p AS (SELECT media_id AS id, kind, file_name AS filename, CASE WHEN stored_file <> '' THEN stored_file WHEN file_name <> '' THEN file_name WHEN kind = 'document' THEN title ELSE '' END AS stored_file,
             coalesce(stored_path, '') AS stored_path, hash FROM q WHERE upload = 1)"""


@query("pending_uploads", f"WITH {_PENDING_SQL} SELECT * FROM p")
def pending_uploads(spark, d):
    queue = _queue(spark, d)
    images = work_queue.pending(queue, _IMAGES).withColumn("kind", F.lit("image"))
    documents = work_queue.pending(queue, _DOCUMENTS).withColumn("kind", F.lit("document")).drop("title")
    return images.unionByName(documents)


@query("mark_uploaded", f"""
WITH {_QUEUE_SQL} SELECT media_id, CAST(CASE WHEN media_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 0 ELSE upload END AS INTEGER) AS upload,
       CAST(CASE WHEN media_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 1 ELSE upload END AS INTEGER) AS uploaded FROM q""")
def mark_uploaded(spark, d):
    queue = _queue(spark, d).select("media_id", "upload", F.col("upload").alias("uploaded"))
    done = table(spark, d, "labels").where("quality = 1").select("doc_id")
    return work_queue.mark_done(work_queue.mark_done(queue, done, QueueSpec()), done, QueueSpec(flag="uploaded"))


_OUTCOME_SQL = f"""{_PENDING_SQL},
o AS (SELECT p.id, filename, CASE WHEN trim(stored_path, '/') <> '' THEN trim(stored_path, '/') || '/' ELSE '' END || stored_file AS relative_path FROM p WHERE kind = 'document'),
f AS (SELECT CASE WHEN lang = 'de' THEN source || '/' ELSE '' END || source || '-' || doc_id AS relative_path, n_chars AS size FROM documents),
t AS (SELECT o.*, f.size, CASE WHEN f.relative_path IS NULL THEN 'missing' WHEN f.size > 800 THEN 'too_large' ELSE 'copied' END AS outcome
      FROM o LEFT JOIN f ON o.relative_path = f.relative_path)"""


def _outcomes(spark, d):
    rows = work_queue.pending(_queue(spark, d), _DOCUMENTS)
    name = F.concat_ws("", F.when(F.col("lang") == "de", F.concat("source", F.lit("/"))), "source", F.lit("-"), F.col("doc_id").cast("string"))
    files = table(spark, d, "documents").select(name.alias("relative_path"), F.col("n_chars").alias("size"))
    return work_queue.classify_transfer(rows, files, max_size=800)


@query("transfer_outcome", f"WITH {_OUTCOME_SQL} SELECT id, filename, relative_path, size, outcome FROM t")
def transfer_outcome(spark, d):
    return _outcomes(spark, d).select("id", "filename", "relative_path", "size", "outcome")


@query("transfer_summary", f"""
WITH {_OUTCOME_SQL},
e AS (SELECT array_to_string(list(relative_path ORDER BY relative_path), ', ') AS examples FROM (SELECT relative_path FROM t WHERE outcome = 'copied' ORDER BY relative_path LIMIT 5))
SELECT 'summary' AS part, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (outcome = 'copied') AS BIGINT) AS transferred,
       CAST(count(*) FILTER (outcome <> 'copied') AS BIGINT) AS failed, CAST(0 AS BIGINT) AS skipped, CAST(coalesce(sum(size) FILTER (outcome = 'copied'), 0) AS BIGINT) AS bytes,
       (SELECT examples FROM e) AS detail FROM t
UNION ALL SELECT 'error', NULL, NULL, NULL, NULL, NULL, id || ' ' || outcome FROM t WHERE outcome <> 'copied'""")
def transfer_summary(spark, d):
    outcomes = _outcomes(spark, d)
    copied = outcomes.where(F.col("outcome") == work_queue.COPIED)
    examples = work_queue.example_paths(copied, "relative_path").select(F.array_join("examples", ", ").alias("detail"), F.lit(1).alias("__one"))
    total = work_queue.queue_summary(outcomes).withColumn("__one", F.lit(1)).join(examples, "__one").drop("__one")
    errors = work_queue.transfer_errors(outcomes).select(
        F.lit("error").alias("part"), F.concat_ws(" ", F.col("id").cast("string"), "error").alias("detail")
    )
    return total.select(F.lit("summary").alias("part"), "*").unionByName(errors, allowMissingColumns=True)


@query("file_inventory", """
SELECT DISTINCT 'lang=' || lang || '/source=' || source AS folder, 'parquet' AS ext, 'application/octet-stream' AS mime, CAST(1 AS INTEGER) AS filled FROM documents""")
def file_inventory(spark, d):
    """Inventory of the documents, written as one folder per language and source."""
    root = scratch(spark, "inventory")
    table(spark, d, "documents").repartition("lang", "source").write.partitionBy("lang", "source").parquet(root)
    files = scan_files(spark, root, include_ext=["PARQUET"])
    folder = F.regexp_replace("relative_path", "/[^/]*$", "")
    return files.select(folder.alias("folder"), "ext", "mime", (F.col("size") > 0).cast("int").alias("filled")).distinct()


def _write_records(root: str, folder: str, fields: list[str]):
    """Write rows as record folders: one folder per ``record``, one text file per field."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root.removeprefix("file:"))
        local = isinstance(system, fs.LocalFileSystem)
        for batch in batches:
            for row in batch.to_dict("records"):
                path = f"{base}/{folder}/{row['record']}"
                if local:
                    os.makedirs(path, exist_ok=True)
                else:
                    system.create_dir(path, recursive=True)
                for name in fields:
                    if row[name] is not None:
                        file = f"{path}/{name}.txt"
                        with open(file, "wb") if local else system.open_output_stream(file) as out:
                            out.write(row[name].encode())
            yield batch[["record"]]

    return write


_FOLDER_FIELDS = ["Meta_Title", "Meta_Description"]


def _folder_root(spark, d) -> str:
    root = scratch(spark, "folders")
    docs = table(spark, d, "documents").select(
        F.concat_ws("__", "lang", F.col("doc_id").cast("string")).alias("record"),
        F.when(F.col("n_chars") < 2000, F.concat("source", F.lit("\r\n"))).alias("Meta_Title"),
        F.when(F.col("lang") != "es", F.col("text")).alias("Meta_Description"),
    )
    docs.mapInPandas(_write_records(root, "Documents", _FOLDER_FIELDS), "record string").write.format("noop").mode("overwrite").save()
    return root


@query("folder_table", r"""
SELECT lang, CAST(doc_id AS VARCHAR) AS doc, CASE WHEN n_chars < 2000 THEN source END AS Meta_Title,
       md5(CASE WHEN lang <> 'es' THEN regexp_replace(text, '[\r\n]+$', '') END) AS description FROM documents""")
def folder_table(spark, d):
    """The documents as record folders, read back as a table; some folders hold no file."""
    spec = FolderTable("Documents", ["lang", "doc"], _FOLDER_FIELDS)
    rows = scan_folder_table(spark, _folder_root(spark, d), spec)
    return rows.select("lang", "doc", "Meta_Title", F.md5("Meta_Description").alias("description"))


@query("folder_table_dynamic", r"""
SELECT lang || '__' || doc_id AS record, CASE WHEN n_chars < 2000 THEN source END AS Meta_Title,
       md5(CASE WHEN lang <> 'es' THEN regexp_replace(text, '[\r\n]+$', '') END) AS description FROM documents""")
def folder_table_dynamic(spark, d):
    rows = scan_folder_table_dynamic(spark, _folder_root(spark, d), FolderTable("Documents", ["record"]))
    return rows.select("record", "Meta_Title", F.md5("Meta_Description").alias("description"))

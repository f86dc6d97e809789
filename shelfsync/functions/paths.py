"""File names, vault names and MIME types."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .text import is_blank, trim

# MIME type by file extension.
MIME_TYPES = {
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "png": "image/png",
    "gif": "image/gif",
    "webp": "image/webp",
    "pdf": "application/pdf",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "xls": "application/vnd.ms-excel",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
}
MIME_OTHER = "application/octet-stream"


def ext(name: Column) -> Column:
    """Lower-case extension without the dot, empty when there is none."""
    return F.when(F.contains(name, F.lit(".")), F.lower(F.substring_index(name, ".", -1))).otherwise("")


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*\z", "")


def relative_path(path: Column, base: str) -> Column:
    """Path below the base folder; a path outside stays as it is."""
    root = base.rstrip("/") + "/"
    return F.when(path.startswith(root), F.substr(path, F.lit(len(root) + 1))).otherwise(path)


def mime_from_ext(extension: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in MIME_TYPES.items() for x in pair])
    return F.coalesce(known[extension], F.lit(MIME_OTHER))


def sanitize_filename(c: Column) -> Column:
    flat = F.regexp_replace(F.regexp_replace(c, r"[\\/]+", "_"), r"[^A-Za-z0-9._-]+", "_")
    return F.trim(flat, F.lit(" ._-"))


def vault_name(pattern: str, columns: dict[str, Column], extension: Column) -> Column:
    """File name from a ``{field}`` pattern, made safe, with its extension ensured."""
    parts: list[Column] = []
    for piece in re.split(r"(\{[^}]+\})", pattern):
        field = columns.get(piece[1:-1]) if piece.startswith("{") else None
        parts.append(F.lit(piece) if field is None else F.coalesce(field.cast("string"), F.lit(piece)))
    name = sanitize_filename(F.concat(*parts))
    suffix = F.concat(F.lit("."), extension)
    complete = is_blank(extension) | F.endswith(F.lower(name), F.lower(suffix))
    return F.when(complete, name).otherwise(F.concat(name, suffix))


def vault_path(base: str, folder: Column, file: Column) -> Column:
    root = F.lit(base.rstrip("/"))
    below = F.ltrim(trim(folder), F.lit("/"))
    return F.concat_ws("/", root, F.when(~is_blank(folder), below), file)

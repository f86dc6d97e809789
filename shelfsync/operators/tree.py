"""Paths of a category tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import slugify, trim


def _path(segments: Column) -> Column:
    """Segments joined by slashes; empty ones at the root leave no trace."""
    start = F.array_position(F.transform(segments, lambda s: s != ""), F.lit(True))
    kept = F.slice(segments, F.greatest(start, F.lit(1)).cast("int"), F.size(segments))
    return F.when(start > 0, F.array_join(kept, "/")).otherwise("")


def category_paths(
    tree: DataFrame, id_column: str = "id", parent_column: str = "parent", name_column: str = "name"
) -> DataFrame:
    """Columns id, path (null within a cycle) and depth for every node.

    Each round joins the open nodes with the chain above them and so doubles the known
    height: a tree of depth d takes log2(d) joins. A node without a parent, or with one that
    is not in the table, is a root. While open nodes hang from a root, each round closes some;
    once a round closes none, the rest lie in or below a cycle and come back with a null path.
    """
    node = F.col(id_column).cast("string")
    parent = trim(F.col(parent_column).cast("string"))
    nodes = tree.where(node != "").select(
        node.alias("id"),
        F.when((parent != "") & (parent != "0"), parent).alias("up"),
        F.array(slugify(F.col(name_column))).alias("segments"),
    )
    nodes = nodes.groupBy("id").agg(F.max(F.struct("up", "segments")).alias("__n")).select("id", "__n.up", "__n.segments")
    known = nodes.select(F.col("id").alias("__known"))
    chains = nodes.join(known, nodes["up"] == known["__known"], "left").select(
        "id", F.col("__known").alias("up"), "segments"
    )
    chains = chains.checkpoint()
    open_nodes, before = chains.where("up is not null").count(), None
    while open_nodes and open_nodes != before:
        above = chains.select(
            F.col("id").alias("__id"), F.col("up").alias("__up"), F.col("segments").alias("__segments")
        )
        lengthened = chains.where("up is not null").join(above, F.col("up") == F.col("__id")).select(
            "id", F.col("__up").alias("up"), F.concat("__segments", "segments").alias("segments")
        )
        chains = chains.where("up is null").unionByName(lengthened).checkpoint()
        open_nodes, before = chains.where("up is not null").count(), open_nodes
    closed = F.col("up").isNull()
    return chains.select(
        "id",
        F.when(closed, _path(F.col("segments"))).alias("path"),
        F.when(closed, F.size("segments")).cast("bigint").alias("depth"),
    )


def _with_path(df: DataFrame, column: str, paths: DataFrame, into: str, prefix: str) -> DataFrame:
    known = paths.where("path is not null").select(F.col("id").alias("__id"), F.col("path").alias("__path"))
    node = trim(df[column].cast("string"))
    value = F.when(node != "", F.concat(F.lit(prefix), F.coalesce("__path", node)))
    return df.join(known, node == known["__id"], "left").select(
        *[df[c] for c in df.columns if c != into], value.alias(into)
    )


def category_path(df: DataFrame, column: str, paths: DataFrame, into: str = "category_path") -> DataFrame:
    """Path of the category in ``column``; an unknown id stands for itself."""
    return _with_path(df, column, paths, into, "")


def category_slug(df: DataFrame, column: str, paths: DataFrame, into: str = "seo_slug", root: str = "de/") -> DataFrame:
    """Path below the language folder."""
    return _with_path(df, column, paths, into, root)

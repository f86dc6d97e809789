"""Registry of queries, and SQL spellings shared by their oracles."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def ready(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names. A local session without one gets its own."""
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)  # a local session's own
    spark.sparkContext.setCheckpointDir(named)
    return named


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, root: str) -> DataFrame:
            ready(spark)
            return fn(spark, root)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """Fresh folder below the shared checkpoint folder of the cluster."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or ready(spark)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# SQL spellings used by several oracles
WHITE = "chr(32) || chr(9) || chr(10) || chr(13) || chr(11)"
NUMERIC = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def sql_trim(x: str) -> str:
    return f"trim({x}, {WHITE})"


def sql_slug(x: str, sep: str = "-", words: bool = True, accents: bool = True) -> str:
    for letter, spelling in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("Ä", "ae"), ("Ö", "oe"), ("Ü", "ue")):
        x = f"replace({x}, '{letter}', '{spelling}')"
    x = f"lower({x})"
    if words:
        x = f"replace({x}, '&', ' und ')"
    if accents:
        x = f"strip_accents({x})"
    return f"trim(regexp_replace({x}, '[^a-z0-9]+', '{sep}', 'g'), '{sep}')"


def sql_iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || '+00:00'"


def sql_number(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{NUMERIC}') THEN TRY_CAST(trim({x}) AS DOUBLE) END"

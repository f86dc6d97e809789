"""A corpus pipeline over `documents`: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfsync.llm import decontamination, mixing, near_duplicates, secret_scan, toxicity
from shelfsync.llm.batches import stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity score reaches 0.3. Learns from labelled documents of the same table."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs.select(*COLUMNS), model, threshold=0.3)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (five words, similarity 0.8): the one with the smallest id."""
    return near_duplicates.representatives(docs.select(*COLUMNS), size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold ten consecutive words of a benchmark item, or a whole shorter item."""
    found = decontamination.search(docs, table(spark, sf_dir, "benchmark"), window=10, carry=COLUMNS[2:], with_text=True)
    return found.filter("NOT contaminated").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced in their texts."""
    return secret_scan.redact(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the mixture, with their tokens, topic, weight and probability."""
    found = mixing.weigh(docs, mixing.Mix(share=0.5), carry=COLUMNS[1:])
    return found.filter("drawn").select(*COLUMNS, "n_tokens", "topic", "weight", "probability")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: The model of the first stage is not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again."""
    at = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        at = stored(stage(spark, at, sf_dir), f"stage-{name}")
    return at

"""The pipeline: every stage against a plain version of it, on the smallest tables and on a small fixture."""

import os
import random

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from shelfsync.llm import secret_scan, toxicity
from tests.llm.test_models import labelled, prose
from tests.llm.test_search import brute_groups, brute_hits, topic_of

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()]


def test_stages_in_order(spark, tmp_path):
    draw = random.Random(12)
    texts, marks = labelled(240)
    items = [(1, prose(draw, 25)), (2, "tiny passage")]
    texts += [texts[1], texts[1] + " end", prose(draw, 40) + " " + items[0][1] + " " + prose(draw, 10), prose(draw, 30) + " Tiny, passage", prose(draw, 30) + " password=hunter2222 " + prose(draw, 9), "", None, " "]
    rows = [(i, t, draw.choice(("en", "de", None)), draw.choice("aab"), len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[2], (None, prose(draw, 20), "en", "a", 3)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, KIND).withColumn("key", F.lit(1)).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, m) for i, m in enumerate(marks)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    at, seen = docs, []
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, at, folder)
        path = os.path.join(folder, f"stage-{k}")
        out.write.parquet(path)
        out = spark.read.parquet(path)
        seen.append((name, rows_of(at), rows_of(out)))
        if k < len(pipeline.STAGES) - 1:
            assert out.columns == list(pipeline.COLUMNS)
        at = out
    _, before, after = seen[0]
    model = toxicity.learn(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = model.scores([(r[1] or "").encode() for r in before])
    assert sorted(after, key=str) == sorted((r for r, s in zip(before, scores) if s < 0.3), key=str)
    toxic = {i for i, m in enumerate(marks) if m}
    assert len(toxic & {r[0] for r in after}) < 0.1 * len(toxic) and len({r[0] for r in before} - toxic - {r[0] for r in after}) < 8
    _, before, after = seen[1]
    kept = {(r[0], r[1]) for r, g in zip(before, brute_groups([(r[0], r[1]) for r in before], 5, 80)) if g[3]}
    assert {(r[0], r[1]) for r in after} == kept and len(after) == len(kept)
    _, before, after = seen[2]
    assert sorted(after, key=str) == sorted((r for r in before if not brute_hits(r[1], items)[4]), key=str) and len(after) <= len(before) - 2
    _, before, after = seen[3]
    assert len(before) == len(after) and sum("<secret>" in (r[1] or "") for r in after) == sum(bool(secret_scan.spans(r[1] or "")[1]) for r in before) > 0
    _, before, after = seen[4]
    assert {r for r in after} <= {r for r in before} and 0.2 * len(before) < len(after) < 0.9 * len(before)
    assert all(topic_of(r["text"]) == r["topic"] and r["n_tokens"] == len(r["text"].split()) for r in at.collect())
    assert sorted(rows_of(pipeline.run(spark, folder)), key=str) == sorted(seen[4][2], key=str)


def test_empty_documents(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], KIND).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert pipeline.run(spark, folder).count() == 0

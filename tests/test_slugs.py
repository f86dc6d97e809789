"""Unique slugs against the rule applied row by row."""

import random

import pytest

from shelfsync.operators.slugs import unique_slugs


def one_by_one(rows, taken):
    held, given = set(taken), {}
    for key, base, _ in sorted(rows, key=lambda r: r[2]):
        slug, n = base, 0
        while slug in held:
            n += 1
            slug = f"{base}-{n}"
        held.add(slug)
        given[key] = slug
    return given


def spread(spark, rows, taken, block, scan=4096):
    changes = spark.createDataFrame(rows, "key int, seo_slug string, ordinal long")
    slugs = spark.createDataFrame([(t,) for t in taken], "seo_slug string")
    result = unique_slugs(changes, slugs, ["key"], block=block, scan=scan).collect()
    assert len(result) == len(rows)
    return {r["key"]: r["seo_slug"] for r in result}


@pytest.mark.parametrize("seed,block", [(1, 1 << 20), (2, 3), (3, 2), (4, 1 << 20)])
def test_numbered_names_meet(spark, seed, block):
    draw = random.Random(seed)
    names = ["x", "x-1", "x-2", "x-1-1", "x-1-2", "x-2-1", "x-1-1-1", "x-03", "y", "y-1", "de/z", "x-12"]
    rows = [(i, draw.choice(names), i * 7 + draw.randrange(7)) for i in range(60)]
    draw.shuffle(rows)
    rows = [(k, b, o) for k, b, o in rows]
    taken = draw.sample(["x", "x-1-3", "x-4", "x-5", "x-7", "y-2", "y-1-1", "x-2-1", "other", "x-999999999999999999999"], 5)
    assert spread(spark, rows, taken, block) == one_by_one(rows, taken)
    assert spread(spark, rows, taken, block, scan=2) == one_by_one(rows, taken)


def chain(n):
    """A base with n contested slots, each with a contested slot of its own below."""
    rows = [(i, "c", 5 * i) for i in range(n)] + [(n + i, f"c-{i + 1}", 3 * i + 1) for i in range(n)] + [(2 * n + i, f"c-{i + 1}-1", 7 * i + 2) for i in range(n)]
    order = {o: k for k, o in enumerate(sorted({(o, k) for k, _, o in rows}))}
    return [(k, b, order[o, k]) for k, b, o in rows]


def test_the_number_of_jobs_does_not_grow_with_the_slots(spark):
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for n in (16, 64, 256):
        rows = chain(n)
        spark.sparkContext.setJobGroup(f"slugs-{n}", "slugs")
        found = spread(spark, rows, [], 1 << 20, scan=32)
        jobs.append(len(tracker.getJobIdsForGroup(f"slugs-{n}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert found == one_by_one(rows, [])
    assert len(set(jobs)) == 1, jobs


@pytest.mark.parametrize("depth", [5, 12])
def test_names_in_names(spark, depth):
    draw = random.Random(depth)
    names = ["-".join(["n"] + ["1"] * i) for i in range(depth)]
    rows = [(i, draw.choice(names), i) for i in range(4 * depth)]
    assert spread(spark, rows, ["n-1-1-2"], 1 << 20) == one_by_one(rows, ["n-1-1-2"])


def test_one_hot_base(spark):
    rows = [(i, "hot" if i % 3 else f"hot-{i}", i) for i in range(120)]
    taken = [f"hot-{i}" for i in range(5, 40)] + ["hot-120", "hot-100"]
    assert spread(spark, rows, taken, 16) == one_by_one(rows, taken)


def test_children_before_and_after_parent(spark):
    rows = [(0, "a-1", 0), (1, "a-2", 50), (2, "a", 10), (3, "a", 20), (4, "a", 30), (5, "a-1", 40), (6, "a-3", 60)]
    assert spread(spark, rows, [], 1 << 20) == one_by_one(rows, [])


def test_blank_slug_is_not_written(spark):
    changes = spark.createDataFrame([(1, " ", 1), (2, None, 2), (3, "a", 3)], "key int, seo_slug string, ordinal long")
    taken = spark.createDataFrame([], "seo_slug string")
    assert [tuple(r) for r in unique_slugs(changes, taken, ["key"]).collect()] == [(3, "a")]

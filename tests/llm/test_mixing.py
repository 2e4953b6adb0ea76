import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from entityflow.llm import mixing

WEIGHTS, SHARE, CAP = [3.0, 1.0, 2.0], 1.5, 2.0


def water_fill(sizes):
    names = sorted((k for k in sizes if k is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {k: WEIGHTS[i % 3] for i, k in enumerate(names)}
    capped, total = set(), SHARE * sum(sizes.values())
    while True:
        free = [k for k in names if k not in capped]
        level = (total - sum(CAP * sizes[k] for k in capped)) / max(1e-9, sum(weight[k] for k in free))
        over = {k for k in free if level * weight[k] > CAP * sizes[k]}
        if not over:
            return {k: CAP * sizes[k] if k in capped else level * weight[k] for k in names}
        capped |= over


def collect(plan):
    return plan.select("row.doc_id", "row.source", "row.text", "size", "source_size", "target", "shards").collect()


def check(rows):
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert len(r.shards) <= 2
        sizes[r.source] += r.size
        taken[r.source] += r.size * len(r.shards)
    want = water_fill(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-6)
    return sizes, taken, want


def test_targets_and_reruns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = collect(mixing.plan_mix(docs, WEIGHTS, SHARE, CAP, shard_words=5000))
    sizes, taken, want = check(rows)
    assert len(rows) == docs.count()
    for k in sizes:
        assert taken[k] == pytest.approx(want[k], rel=0.03)
    again = collect(mixing.plan_mix(docs.repartition(5), WEIGHTS, SHARE, CAP, shard_words=5000))
    assert {r.doc_id: r.shards for r in rows} == {r.doc_id: r.shards for r in again}
    mixed = mixing.mix(docs, WEIGHTS, SHARE, CAP, shard_words=5000)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: len(r.shards) for r in rows if r.shards})


def test_uneven_sources(documents):
    rows = [(i, "w " * (1 + i % 7), None, "big") for i in range(3000)] + [(5000 + i, "a b", None, f"s{i % 4}") for i in range(40)]
    rows += [(9000, None, None, "s0"), (9001, "", None, "empty"), (9002, "x y z", None, None), (9003, "x y z", None, None), (9003, "x y z", None, None), (None, "q", None, "big")]
    docs = documents(rows).withColumnRenamed("lang", "size").withColumnRenamed("n_chars", "block")
    found = collect(mixing.plan_mix(docs, WEIGHTS, SHARE, CAP, shard_words=500))
    sizes, taken, want = check(found)
    assert len(found) == len(rows)
    for k in ("big", "s0", "s1", "s2", "s3"):
        assert abs(taken[k] - want[k]) <= max(3, 0.01 * want[k])
    shards = defaultdict(int)
    for r in found:
        for s in r.shards:
            shards[s] += r.size
    assert len(shards) > 5
    assert mixing.plan_mix(docs.limit(0), WEIGHTS, SHARE, CAP).count() == 0


def test_splitting_tree_keeps_quotas(spark):
    quotas = spark.createDataFrame([(0, 500), (1, 7), (2, 0), (3, 93)], "idx long, draws long")
    rows = mixing.split_quotas(quotas, 6, 3).collect()
    by_source, by_shard = Counter(), Counter()
    for r in rows:
        assert r.quota >= 0
        by_source[r.idx] += r.quota
        by_shard[r.shard] += r.quota
    assert by_source == {0: 500, 1: 7, 2: 0, 3: 93}
    assert set(by_shard.values()) == {100}


def test_hypergeometric_distribution(spark):
    n = 4000
    got = spark.range(n).select(mixing.hypergeometric(F.lit(60), F.lit(20), F.lit(15), (F.col("id") + 0.5) / n).alias("k")).collect()
    counts = Counter(r.k for r in got)
    from math import comb
    for k in range(16):
        assert counts[k] / n == pytest.approx(comb(20, k) * comb(40, 15 - k) / comb(60, 15), abs=1e-3)

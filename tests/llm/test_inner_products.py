import math
import random

import pytest

from entityflow.llm import inner_products


def brute(rows, k):
    ints = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints.setdefault((i, tuple(math.floor(64 * x) for x in v)), None)
    out = []
    for qi, q in ints:
        if qi % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c)), ci) for ci, c in ints if ci != qi and len(c) == len(q))
            out += [(qi, n + 1, ci, -s) for n, (s, ci) in enumerate(scored[:k])]
    return sorted(out)


def search(spark, rows, k, **sizes):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "vec_id AS score", "1 AS size").repartition(3)
    found = inner_products.top_inner_products(df, lambda i: i % 20 == 0, k, **sizes)
    return sorted((r.query_id, r["rank"], r.id, r.score) for r in found.collect())


@pytest.mark.parametrize("blocks", [(7, 11), (512, 8192)])
def test_random_vectors_with_ties(spark, blocks):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) * (1 + i % 3) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]
    assert search(spark, rows, 5, query_block=blocks[0], candidate_block=blocks[1]) == brute(rows, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [0.5, 0.5]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, None), (4, [None, 1.0]), (None, [1.0, 1.0]),
            (5, [3.0]), (40, [1.0]), (6, []), (60, []), (7, [-1.0, 0.01]), (8, [1e6, 1e6]), (9, [0.0, 0.0])]
    assert search(spark, rows, 20) == brute(rows, 20)
    assert search(spark, [(1, [1.0]), (2, [2.0])], 3) == []
    assert search(spark, [], 3) == []


def test_whole_table_against_brute_force(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    found = inner_products.top_inner_products(df, lambda i: i % 20 == 0, 20, query_block=8, candidate_block=64)
    assert sorted((r.query_id, r["rank"], r.id, r.score) for r in found.collect()) == brute(rows, 20)

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from entityflow.operators import graph, graph_state


def state(spark, path, batch_id):
    return {tuple(r) for r in graph_state.nodes(spark, path, batch_id).collect()}, {tuple(r) for r in graph_state.edges(spark, path, batch_id).collect()}


def rebuilt(spark, startups, products, papers):
    frames = (
        spark.createDataFrame([(s,) for s in startups], "entityName string"),
        spark.createDataFrame([(s, u) for u, s in products.items()], "startupName string, url string"),
        spark.createDataFrame([(u, a) for u, a in papers.items()], "paper_url string, authors array<string>"),
    )
    return [{tuple(r) for r in f(*frames).collect()} for f in (graph.graph_nodes, graph.graph_edges)]


def test_batches_equal_a_rebuild(spark, tmp_path):
    rng = random.Random(2)
    path, startups, products, papers = str(tmp_path), set(), {}, {}
    for batch in range(5):  # the fourth batch merges
        at = F.lit(batch)
        new_startups = {f"s{rng.randrange(6)}" for _ in range(2)} - startups
        lost = {s for s in startups if rng.random() < 0.3}
        some_products = {f"u{rng.randrange(9)}": rng.choice(["s0", "s1", "s2", "s3", None, ""]) for _ in range(4)}
        some_papers = {f"p{rng.randrange(9)}": rng.choices(["Ann", "Bob", "Cid", "Dan", None, "Ann"], k=rng.randrange(4)) for _ in range(4)}
        gone = [u for u in papers if u not in some_papers and rng.random() < 0.3]
        changes = graph_state.startup_changes(spark.createDataFrame([(s,) for s in new_startups], "entityName string"), at)
        changes = changes.unionByName(graph_state.removals(graph_state.startup_changes(spark.createDataFrame([(s,) for s in lost], "entityName string"), at)))
        changes = changes.unionByName(graph_state.product_changes(spark.createDataFrame([(s, u) for u, s in some_products.items()], "startupName string, url string"), at))
        changes = changes.unionByName(graph_state.paper_changes(spark.createDataFrame(list(some_papers.items()), "paper_url string, authors array<string>"), at))
        changes = changes.unionByName(graph_state.removals(graph_state.paper_changes(spark.createDataFrame([(u, []) for u in gone], "paper_url string, authors array<string>"), at)))
        startups = (startups | new_startups) - lost
        products |= some_products
        papers = {u: a for u, a in (papers | some_papers).items() if u not in gone}
        for _ in range(1 + batch % 2):  # a repeated batch replaces its own output
            graph_state.apply_changes(changes, path, batch)
        got, want = state(spark, path, batch), rebuilt(spark, startups, products, {u: [a for a in names if a] for u, names in papers.items()})
        assert list(got) == want
    assert len(graph_state._generations(spark, path, 4)) == 2


def test_support_and_late_versions(spark, tmp_path):
    path = str(tmp_path)
    rows = lambda *r: spark.createDataFrame(list(r), "paper_url string, authors array<string>, version long")
    changes = lambda *r: graph_state.paper_changes(rows(*r), F.col("version"))
    graph_state.apply_changes(changes(("p", ["Ann", "Ann"], 5), ("q", ["Ann"], 5), (None, ["Eve"], 5), ("", ["Eve"], 5), ("r", None, 5), ("p", ["Old"], 4)), path, 0)
    counts = lambda b: Counter({r.a: r.n for r in graph_state.support(spark, path, b).where("kind = 'node'").collect()})
    assert counts(0) == {"p": 1, "q": 1, "r": 1, "Ann": 2}
    graph_state.apply_changes(changes(("p", ["Bob"], 5), ("q", ["Cid"], 3)), path, 1)  # none is above what is stored
    assert counts(1) == counts(0)
    # Rows without a change write no delta; the change of one paper alters its own items alone.
    graph_state.apply_changes(changes(("q", ["Ann", "Bob"], 6)), path, 2)
    assert {(r.kind, r.a, r.b, r.n) for r in spark.read.parquet(f"{path}/support/batch-2").collect()} == {("node", "Bob", "", 1), ("edge", "Bob", "q", 1)}
    graph_state.apply_changes(graph_state.removals(changes(("p", None, 7), ("q", None, 7))), path, 3)
    assert counts(3) == {"r": 1}
    graph_state.apply_changes(changes().limit(0), path, 4)
    assert counts(4) == {"r": 1} and state(spark, path, 4)[1] == set()
    with pytest.raises(ValueError):
        graph_state.apply_changes(changes(), path, 9)

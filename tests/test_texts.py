import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityflow.functions.text import collapse_whitespace
from entityflow.operators import chunks, graph, replies, vector_index, vectors


def check_packing(cleaned, chunks_, limit):
    """What any greedy packing must satisfy, whatever code made it."""
    if len(cleaned) <= limit:
        assert chunks_ == [cleaned]
        return
    assert all(0 < len(c) <= limit for c in chunks_)
    # Nothing lost, nothing reordered: only the breaks between chunks and empty paragraphs vanish.
    squeeze = lambda t: t.replace("\n\n", "")
    assert squeeze("".join(chunks_)) == squeeze(cleaned)
    paras = [p for p in cleaned.split("\n\n") if p]
    long_pieces = {p[i : i + limit] for p in paras if len(p) > limit for i in range(0, len(p), limit)}
    for left, right in zip(chunks_, chunks_[1:]):
        if left in long_pieces or right in long_pieces:
            continue
        # The next paragraph, with its break, did not fit any more.
        assert len(left) + 2 + len(right.split("\n\n")[0]) > limit


def test_chunks_pack_greedily(spark):
    rng = random.Random(4)
    texts = ["", "a\n\nbb\n\nccc", "é" * 13, "\n\n\n"] + [
        "".join(rng.choice(["a", "bé", " ", "  ", "\n\n", "\n\n\n\n", "c" * 9]) for _ in range(rng.randint(0, 25))) for _ in range(200)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    cleaned = {r[0]: r[1] for r in df.select("doc_id", collapse_whitespace("text")).collect()}
    got = {}
    for r in chunks.chunk_text(df, max_chars=6).orderBy("doc_id", "chunk_no").collect():
        got.setdefault(r["doc_id"], []).append(r["chunk"])
    for i in range(len(texts)):
        check_packing(cleaned[i], got.get(i, []), 6)
    assert got[0] == [""] and got[1] == ["a\n\nbb", "ccc"] and got[2] == ["é" * 6, "é" * 6, "é"]


def test_chunks_do_not_shuffle(spark, sf, capsys):
    chunks.with_prompt(chunks.chunk_text(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")), "{}").explain()
    assert "Exchange" not in capsys.readouterr().out


SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False), T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType()),
    T.StructField("ok", T.BooleanType()), T.StructField("when", T.TimestampType()), T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("data", T.StructType([T.StructField("count", T.IntegerType())])),
])

REPLIES = [
    ('{"name":"a"}', True), ('{"name":"a","extra":[1]}', True), ("not json", False), ("", False), (None, False), ("[1]", False),
    ('{"n":1}', False), ('{"name":null}', False), ('{"name":5}', False),
    ('{"name":"a","n":"12"}', True), ('{"name":"a","n":12.0}', True), ('{"name":"a","n":12.5}', False), ('{"name":"a","n":"x"}', False),
    ('{"name":"a","n":true}', True), ('{"name":"a","n":null}', True), ('{"name":"a","n":99999999999}', False),
    ('{"name":"a","x":"1.5"}', True), ('{"name":"a","x":{}}', False), ('{"name":"a","ok":"yes"}', True), ('{"name":"a","ok":2}', False),
    ('{"name":"a","when":"2024-01-02T03:04:05Z"}', True), ('{"name":"a","when":"soon"}', False),
    ('{"name":"a","tags":["b","c"]}', True), ('{"name":"a","tags":["b",1]}', False), ('{"name":"a","tags":"b"}', False),
    ('{"name":"a","data":{"count":3}}', True), ('{"name":"a","data":{"count":"z"}}', False), ('{"name":"a","data":4}', False),
]


def test_reply_validation(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(REPLIES)], "i int, raw string")
    rows = replies.validate_json(df, SCHEMA).orderBy("i").collect()
    assert [(REPLIES[r["i"]][0], r["is_valid"]) for r in rows] == REPLIES
    by_text = {r["raw"]: r["parsed"] for r in rows}
    assert by_text['{"name":"a","n":"12"}']["n"] == 12 and by_text['{"name":"a","data":{"count":3}}']["data"]["count"] == 3
    assert by_text['{"name":"a","tags":["b","c"]}']["tags"] == ["b", "c"] and by_text["not json"] is None
    assert replies.validate_json(df, SCHEMA, required=["name", "n"]).filter("is_valid").count() == 3
    assert replies.validate_json(df, SCHEMA, enums={"name": ["b"]}).filter("is_valid").count() == 0


def test_first_valid(spark):
    rows = [(1, 0, 0, "bad"), (1, 0, 1, '{"name":"second"}'), (1, 1, 0, '{"name":"late"}'), (2, 0, 0, "bad")]
    df = spark.createDataFrame(rows, "doc_id int, chunk_no int, provider_rank int, raw string")
    schema = T.StructType([T.StructField("name", T.StringType(), False)])
    got = replies.first_valid(replies.validate_json(df, schema)).collect()
    assert [tuple(r) for r in got] == [(1, 0, 1, "second")]


def test_graph(spark):
    startups = spark.createDataFrame([(1, "Acme"), (2, "Zed"), (3, "Acme")], "row_id int, entityName string")
    products = spark.createDataFrame([("Acme", "u1"), ("Acme", "u2"), ("Acme", "u1"), ("Solo", "u3")], "startupName string, url string")
    papers = spark.createDataFrame([("p1", ["Ann", "Bob"]), ("p2", ["Ann"])], "paper_url string, authors array<string>")
    founded = spark.createDataFrame([("Ann", "Zed")], "person string, entityName string")
    nodes = graph.graph_nodes(startups, products, papers)
    assert {(r["node_type"], r["name"]) for r in nodes.collect()} == {
        ("Startup", "Acme"), ("Startup", "Zed"), ("Product", "u1"), ("Product", "u2"), ("Product", "u3"),
        ("Paper", "p1"), ("Paper", "p2"), ("Person", "Ann"), ("Person", "Bob"),
    }
    edges = graph.graph_edges(startups, products, papers, founded)
    assert {r["edge_type"]: r["count"] for r in edges.groupBy("edge_type").count().collect()} == {"AUTHORED": 3, "PUBLISHES": 2, "FOUNDED": 1}
    # Every end of an edge is a node.
    ends = edges.select(F.col("src").alias("id")).union(edges.select("dst"))
    assert ends.join(nodes, "id", "left_anti").count() == 0
    assert {tuple(r) for r in graph.same_parent(products).collect()} == {("Acme", "u1", 2), ("Acme", "u2", 2)}
    assert graph.products_of_startup(products, startups).count() == 2
    people = spark.createDataFrame([("Bob",), ("Bob",), ("Cy",)], "person string")
    assert [r["person"] for r in graph.people_in_both(papers, people).collect()] == ["Bob"]
    links = spark.createDataFrame([(2, "p1"), (1, "gone")], "row_id int, paper_url string")
    assert [tuple(r) for r in graph.startups_from_papers(startups, papers, links).collect()] == [("Zed", "p1")]


def vector_table(spark, matrix):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(matrix)], "vec_id bigint, embedding array<double>")


def clustered(seed, n=240, dim=16, copies=80):
    """Tight clusters, and one vector that makes up a third of all rows."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, dim))
    points = centers[rng.integers(0, 12, n)] + rng.normal(scale=0.15, size=(n, dim))
    points[rng.choice(n, copies, replace=False)] = centers[0]
    return points


@pytest.mark.parametrize("min_cos, pivots, block_rows", [
    (0.97, None, 2000), (0.999, 40, 10), (0.97, 7, 30), (0.97, 40, 10), (0.8, 40, 10), (0.2, 7, 30),
])
def test_near_duplicates_equal_brute_force(spark, min_cos, pivots, block_rows):
    points = clustered(3)
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    cos = unit @ unit.T
    want = {}
    for j in range(len(points)):
        earlier = [i for i in range(j) if cos[i, j] >= min_cos]
        if earlier:
            want[j] = earlier[0]
    got = vectors.near_duplicates(vector_table(spark, points), min_cos, pivots=pivots, block_rows=block_rows)
    assert {r["vec_id"]: r["dup_of"] for r in got.collect()} == want


def test_near_duplicates_carry_a_vector_once_per_group(spark, monkeypatch):
    """However many cells a vector must be compared with, it is written once, and early ids settle what they match."""
    rng = np.random.default_rng(4)
    points = rng.normal(size=(400, 16))
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    cos, written, settle = unit @ unit.T, {}, vectors.settle

    def counted(df, label, *more, **options):
        out = settle(df, label, *more, **options)
        written[label] = out.count()
        return out

    monkeypatch.setattr(vectors, "settle", counted)
    got = vectors.near_duplicates(vector_table(spark, points), 0.5, pivots=40, block_rows=10)
    first = {j: int(np.argmax(cos[:j, j] >= 0.5)) for j in range(1, 400) if (cos[:j, j] >= 0.5).any()}
    assert {r["vec_id"]: r["dup_of"] for r in got.collect()} == first
    assert written["vector-cells"] == 400 and written["vector-blocks"] <= 400 and written["open-vectors"] < 361


def test_similar(spark, monkeypatch):
    points = clustered(5)
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    emb = vector_table(spark, points).repartition(5)
    queries = emb.filter("vec_id in (0, 17)").withColumnRenamed("vec_id", "query_id")
    rows = vectors.similar(emb, queries, k=6).collect()
    for q in (0, 17):
        scores = np.round(unit @ unit[q], 6)
        want = sorted(range(len(points)), key=lambda i: (-scores[i], i))[:6]
        assert [r["vec_id"] for r in sorted((r for r in rows if r["query_id"] == q), key=lambda r: r["rank"])] == want
    assert vectors.similar(emb, queries.filter("query_id < 0")).count() == 0
    # Any number of queries: here each in a block of its own.
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 1)
    apart = vectors.similar(emb, queries, k=6).collect()
    assert sorted(map(tuple, apart)) == sorted(map(tuple, rows))


def test_banded_near_duplicates_recall_and_work(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(400, 48))
    copies = base[:200] * rng.uniform(0.5, 2, (200, 1)) + rng.normal(size=(200, 48)) * 0.06
    points = np.concatenate([base, copies, base[:20]])
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    near = np.tril(unit @ unit.T >= 0.98, -1)
    want = {int(i) for i in np.flatnonzero(near.any(1))}
    got = {r.vec_id: r.dup_of for r in vectors.near_duplicates_banded(vector_table(spark, points), 0.98).collect()}
    assert all(near[i, j] for i, j in got.items())
    assert len(want & set(got)) >= 0.98 * len(want)
    # Candidates per vector stay far below the number of vectors: bands * (pairs that share a random key).
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(list(base))], ["id", "vec"])
    sizes = Counter((b, k) for part in vectors._band_keys(24, 12, 1, 48)(iter([batch])) for b, k in zip(*(part.column(c).to_pylist() for c in range(2))))
    assert sum(n * (n - 1) for n in sizes.values()) / 400 < 8
    crowd = np.tile(base[0], (900, 1)) + rng.normal(size=(900, 48)) * 1e-4
    found = vectors.near_duplicates_banded(vector_table(spark, crowd), 0.99).collect()
    assert {r.vec_id for r in found} == set(range(1, 900)) and {r.dup_of for r in found} == {0}
    # The same crowd in keys that must be cut: each row but the first has an earlier match.
    found = vectors.near_duplicates_banded(vector_table(spark, crowd), 0.99, bands=6, bucket_rows=64).collect()
    assert len(found) >= 0.99 * 899 and all(r.dup_of < r.vec_id for r in found)
    assert vectors.near_duplicates_banded(vector_table(spark, points).limit(0), 0.9).count() == 0


def test_banded_recall_in_a_crowded_cone(spark):
    """All vectors share nearly all keys; copies of some, far apart in id, are found all the same."""
    rng, n, dims = np.random.default_rng(3), 20_000, 64
    middle = rng.normal(size=dims)
    points = middle / np.linalg.norm(middle) + rng.normal(size=(n, dims)) * 0.0174
    copied = rng.choice(n // 2, 200, replace=False)
    points[n - 200:] = points[copied] + rng.normal(size=(200, dims)) * 0.0047
    found = {r.vec_id: r.dup_of for r in vectors.near_duplicates_banded(vector_table(spark, points), 0.995, bands=6).collect()}
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    assert np.mean(np.sum(unit[:2000] * unit[2000:4000], axis=1)) < 0.985
    assert all(unit[i] @ unit[j] >= 0.995 - 1e-12 and j < i for i, j in found.items())
    assert np.mean([found.get(n - 200 + k) == c for k, c in enumerate(copied)]) >= 0.98


def test_banded_same_direction_and_what_no_plane_cuts(spark, monkeypatch):
    """Multiples of one vector are one direction; keys that stay too large are compared block by block."""
    rng = np.random.default_rng(4)
    points = np.concatenate([np.outer(rng.uniform(0.1, 9, 300), rng.normal(size=16)), np.zeros((3, 16)), rng.normal(size=(200, 16))])
    points = np.concatenate([points, points[303:] + 1e-3])
    table = vector_table(spark, points).unionByName(spark.createDataFrame([(9999, None)], "vec_id long, embedding array<double>"))
    unit = points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-300)
    near = np.tril(unit @ unit.T >= 0.99, -1)
    near[:303, :303] = np.tril(np.ones((303, 303), bool), -1)
    near[300:303, :300] = False  # zero vectors only match each other
    want = {int(i): int(near[i].argmax()) for i in np.flatnonzero(near.any(axis=1))}
    got = {r.vec_id: r.dup_of for r in vectors.near_duplicates_banded(table, 0.99).collect()}
    assert got == want
    monkeypatch.setattr(vectors, "CUT_ROUNDS", 0)
    got = {r.vec_id: r.dup_of for r in vectors.near_duplicates_banded(table, 0.99, bits=2, bucket_rows=16).collect()}
    assert got == want


@pytest.mark.parametrize("kind", ["gathered", "spread"])
def test_vector_index_recall(spark, kind):
    rng = np.random.default_rng(8)
    if kind == "gathered":
        points = rng.normal(size=(60, 32))[rng.integers(0, 60, 6000)] + rng.normal(size=(6000, 32)) * 0.3
    else:
        points = rng.normal(size=(3000, 10))
    table = vector_table(spark, points).unionByName(spark.createDataFrame([(99_999, None)], "vec_id long, embedding array<double>"))
    asked = table.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    index = vector_index.build_index(table)
    assert index.lists.select(F.sum(F.size("ids"))).first()[0] == len(points)  # every vector is indexed
    want = {(r.query_id, r.vec_id): r.score for r in vectors.similar(table, asked, 10).collect()}
    got = vector_index.search(index, table, asked, 10, probes=16).collect()
    assert np.mean([(r.query_id, r.vec_id) in want for r in got]) >= 0.95 and len(got) == len(want)
    assert all(abs(want[r.query_id, r.vec_id] - r.score) < 2e-6 for r in got if (r.query_id, r.vec_id) in want)
    # All cells and all candidates: the exact result.
    every = vector_index.search(index, table, asked, 10, probes=len(index.cells), keep=len(points)).collect()
    assert {(r.query_id, r.vec_id) for r in every} == set(want)


def test_vector_index_small_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(1, [1.0, 0.0, 0.0])], "query_id long, embedding array<double>")
    assert vector_index.search(vector_index.build_index(none), none, asked.limit(0)).count() == 0
    one = spark.createDataFrame([(5, [2.0, 0.0, 0.0]), (6, [0.0, 0.0, 0.0])], "vec_id long, embedding array<double>")
    found = vector_index.search(vector_index.build_index(one), one, asked, 3).orderBy("rank").collect()
    assert [(r.vec_id, r.score, r["rank"]) for r in found] == [(5, 1.0, 1), (6, 0.0, 2)]
    assert vectors.similar(none, asked).count() == vectors.similar(one, asked.limit(0)).count() == 0


def test_similar_has_no_driver_step(spark):
    """Queries of several blocks, against one product of all."""
    rng = np.random.default_rng(2)
    points = rng.normal(size=(900, 6))
    table = vector_table(spark, points)
    asked = table.withColumnRenamed("vec_id", "query_id")
    monkey, vectors.QUERY_BLOCK = vectors.QUERY_BLOCK, 100
    try:
        got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in vectors.similar(table, asked, 4).collect()}
    finally:
        vectors.QUERY_BLOCK = monkey
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    scores = np.round(unit @ unit.T, 6)
    order = np.lexsort((np.broadcast_to(np.arange(900), scores.shape), -scores), axis=1)[:, :4]
    assert got == {(q, n + 1): (int(v), float(scores[q, v])) for q in range(900) for n, v in enumerate(order[q])}

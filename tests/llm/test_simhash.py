import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from xxhash import xxh64_intdigest

from entityflow.llm import hamming, simhash
from entityflow.llm.components import components


def plain_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(fps, ids, bits=4):
    label = list(range(len(fps)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                label[top(i)] = top(j)
    least = {}
    for i, k in enumerate(ids):
        if k is not None:
            least[top(i)] = min(least.get(top(i), k), k)
    return [least.get(top(i)) for i in range(len(fps))]


def test_documents_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = simhash.near_duplicates(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.id: r.fp % 2**64 for r in rows} == {i: plain_fingerprint(t) for i, t in texts.items()}
    assert [r.component for r in rows] == plain_classes([r.fp for r in rows], [r.id for r in rows])
    kept = sorted(r.doc_id for r in simhash.one_per_class(docs).collect())
    assert kept == sorted({r.component for r in rows})


def test_odd_rows(documents):
    rows = [(9, None), (8, ""), (7, " \n"), (5, "ÀB É"), (5, "ÀB É"), (4, "Àb É"), (None, "only here"), (None, ""), (3, "w " * 50_000)]
    docs = documents(rows).withColumnRenamed("n_chars", "component").withColumnRenamed("lang", "fp")
    got = Counter((r.id, r.fp, r.component) for r in simhash.near_duplicates(docs).collect())
    assert sum(got.values()) == len(rows)
    assert got[(9, 0, 7)] == got[(8, 0, 7)] == got[(7, 0, 7)] == got[(None, 0, 7)] == 1
    assert sum(k[2] == 4 for k in got.elements()) == 3
    kept = sorted((r.doc_id for r in simhash.one_per_class(docs).collect()), key=repr)
    assert kept == sorted([7, 4, None, None, 3], key=repr)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.one_per_class(documents([(1, "a b c d e"), (1, "a b c d e")])).count() == 1


@pytest.mark.parametrize("limit", [8, 1 << 16])
def test_links_of_clustered_fingerprints(spark, limit):
    rng = random.Random(3)
    fps = set()
    for _ in range(25):
        center = rng.getrandbits(64)
        for _ in range(40):
            fp = center
            for b in rng.sample(range(64), rng.randint(0, 5)):
                fp ^= 1 << b
            fps.add(fp)
    fps = sorted(fps)
    signed = [fp - 2**64 if fp >= 2**63 else fp for fp in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    links = hamming.hamming_links(df, 4, group_rows=limit)
    for r in links.collect():
        assert bin((r.a ^ r.b) % 2**64).count("1") >= 1
    label = {r.node: r.label for r in components(links).collect()}
    got = [label.get(s, s) for s in signed]
    want = plain_classes(fps, list(range(len(fps))))
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_gray_order():
    values = np.array([0, 1, 3, 2, 6, 7, 5, 4], np.uint64)  # consecutive Gray codes
    assert hamming.gray_rank(values, 0).tolist() == list(range(8))


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (300, 300), (7, None)]
    label = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert label == {**{i: 0 for i in range(1, 61)}, 200: 100}


def test_large_group_is_streamed():
    fps = np.arange(100, dtype=np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(100, np.int64)), pa.array(np.zeros(100, np.int64)), pa.array(fps), pa.array(fps)], ["mask", "value", "rank", "fp"])
    out = list(hamming.link_groups(4, 30)(iter([batch.slice(0, 20), batch.slice(20, 50), batch.slice(70)])))
    marked = [a for b in out for a, m in zip(b.column(0).to_pylist(), b.column(2).to_pylist()) if m is not None]
    assert sorted(marked) == fps.tolist()

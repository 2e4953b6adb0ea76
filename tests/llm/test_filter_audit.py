import random
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from entityflow.llm import filter_audit


def plain_masks(rows):
    """(doc_id, part, mask) of each row, every pair of rows compared."""
    out = []
    for i, text, _, source in rows:
        text = text or ""
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
        capitals = sum("A" <= c <= "Z" for c in text)
        failed = (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * capitals > 5 * len(text), any(c in "#$%&*|" for c in text),
                  any(j is not None and i is not None and j < i and (t or "") == text for j, t, _, _ in rows))
        out.append((i, source or "", sum(1 << k for k, f in enumerate(failed) if f)))
    return out


def plain_audit(masks, good, toxic):
    """Every order applied row by row."""
    out = {}
    for part in {p for _, p, _ in masks}:
        rows, total = [(i, m) for i, p, m in masks if p == part], Counter()
        for order in permutations(range(5)):
            left = rows
            for step, k in enumerate(order, 1):
                gone = [(i, m) for i, m in left if m >> k & 1]
                before, left = left, [(i, m) for i, m in left if not m >> k & 1]
                fails = sum(m >> k & 1 for _, m in rows)
                out[part, "".join("ABCDE"[j] for j in order), step] = [
                    len(left), len(gone), fails - len(gone), sum(m == 1 << k for _, m in rows),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
                total[k] += len(gone)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total["ABCDE".index(order[step - 1])])
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["alpha", "Beta", "c#", "dd", "ee|", "ümlaut"]) + (str(rng.randrange(60)) if rng.random() < 0.8 else "")
                      for _ in range(rng.choice([3, 48, 49, 50, 51, 90]))) for _ in range(60)]
    texts += ["", None, " \t\n", "a\x85b\xa0c " * 50, "word " * 49 + "last", "One " * 20 + "small " * 200, "Ab" * 10]
    out = [(i, rng.choice(texts), None, rng.choice(["hot", "hot", "s1", None, ""])) for i in range(300)]
    out += [(None, texts[0], None, "hot"), (None, "only here", None, "s1"), (7, texts[0], None, "hot"), (7, texts[0], None, "hot"), (8, "a new text", None, "s2")]
    out += [(-4, texts[1], None, "hot"), (900, "w" * 2_500_000 + " x" * 400_000, None, "s2"), (901, "w" * 2_500_000 + " x" * 400_000, None, "s2")]
    return out


@pytest.mark.parametrize("hashed", [F.xxhash64, lambda c: F.length(c) % 5])
def test_masks_against_plain(spark, documents, rows, hashed):
    docs = documents(rows).withColumn("part", F.lit("x")).withColumn("mask", F.lit(1)).withColumn("h", F.lit(2)).repartition(5)
    got = filter_audit.audit_rows(docs, hashed=hashed).collect()
    assert Counter(tuple(r) for r in got) == Counter(plain_masks(rows))


def test_audit_against_every_order(spark, documents, rows):
    labels = spark.createDataFrame([(i, i % 2, int(i % 7 == 0)) for i in range(0, 300, 2)] + [(4, 1, 0), (5, 1, None), (None, 1, 1), (12345, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    good, toxic = {r.doc_id for r in labels.collect() if r.quality == 1}, {r.doc_id for r in labels.collect() if r.toxic == 1}
    found = filter_audit.interactions(filter_audit.mask_counts(filter_audit.audit_rows(documents(rows)), labels)).collect()
    want = plain_audit(plain_masks(rows), good - {None}, toxic - {None})
    assert {(r.part, r.filter_order, r.step): list(r[3:]) for r in found} == want
    assert len(found) == len(want) == 600 * 4


def test_sketch_clears_unique_texts_and_keeps_repeats(spark):
    hashes = spark.range(40_000).select(F.xxhash64(F.pmod("id", F.lit(39_000))).alias("h"))
    hashes = hashes.unionByName(spark.range(20_000).select(F.xxhash64(F.lit(-1)).alias("h")))
    left = {r.h for r in filter_audit.repeat_candidates(hashes).collect()}
    repeated = {r.h for r in hashes.groupBy("h").count().where("count > 1").collect()}
    assert len(repeated) == 1001 and repeated <= left and len(left - repeated) < 0.01 * 39_000


def test_empty_tables(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents([(1, "a b"), (2, "a b")])
    assert filter_audit.interactions(filter_audit.mask_counts(filter_audit.audit_rows(docs.limit(0)), labels)).count() == 0
    found = filter_audit.interactions(filter_audit.mask_counts(filter_audit.audit_rows(docs), labels)).where("filter_order = 'EABCD'").orderBy("step").collect()
    assert [(r.kept, r.removed, r.redundant, r.good_lost) for r in found] == [(1, 1, 0, 0), (0, 1, 1, 0), (0, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0)]

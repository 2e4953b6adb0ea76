import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from entityflow.llm import personal_data as pd_

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                  "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


HARD = [
    None, "", "a@b.co_x@d.ef g@h", "x@y..z a.b@c.d.e.", "@@a@b.c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3", "9" * 50 + ".1.2.3",
    "4111 1111 1111 1111", "4111-1111-1111-1111 5", "4111  1111", "41111111111111111111111", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "+1 (555) 555-1234 +1", "+12", "+1-2", "call +44 20 7946 0958.", "++1 800 555 0199-", "é😀 mé@x.yé +1 800 555 0199 ü 10.0.0.1",
    "a" * 20_000, "1" * 20_000, "1 " * 20_000, "." * 5000 + "@" * 5000, "+" + "1 " * 9000, "a.b@c.d " * 900,
]


def test_base_spans_against_plain_matching(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(HARD)], "i long, text string").withColumn("text", F.coalesce("text", F.lit("")))
    got = {r.i: [tuple(s) for s in r.b] for r in df.select("i", pd_.base_spans(F.col("text")).alias("b")).collect()}
    for i, t in enumerate(HARD):
        assert got[i] == plain_base(t), t


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pd_.personal_data(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        base, spans = [tuple(s) for s in r.base], [tuple(s) for s in r.spans]
        assert base == plain_base(texts[r.id])
        assert set(base) <= set(spans) and spans == sorted(spans)
        more = [s for s in spans if s not in base]
        assert all(a[2] <= b[0] or b[2] <= a[0] for i, a in enumerate(more) for b in [*base, *more[:i]])


def test_added_spans_and_odd_rows(spark, documents):
    rows = [(i, f"some words here. call +1 (9{i % 10}2) 555-{1000 + i} soon. write me{i}@mail.example.com now") for i in range(400)]
    rows += [(900, "some words here. call 1 (972) 555-4312 soon. write me (at) mail.example.com now"), (901, None), (902, ""), (None, "x 10.0.0.1"), (902, ""),
             (903, "12345 67890 123 456 " * 2000)]
    docs = documents(rows).withColumnRenamed("lang", "base").withColumnRenamed("n_chars", "fold")
    got = pd_.personal_data(docs, precision=0.5).collect()
    assert Counter(r.id for r in got) == Counter(r[0] for r in rows)
    assert [tuple(s) for r in got if r.id is None for s in r.base] == [(2, 1, 10)]
    assert all(set(map(tuple, r.base)) <= set(map(tuple, r.spans)) for r in got)
    assert all(len(r.base) == 2 for r in got if r.id is not None and r.id < 400)
    assert pd_.personal_data(docs.limit(0)).count() == 0


def test_trees_find_a_rule():
    rng = np.random.default_rng(0)
    x = np.stack([rng.integers(0, n, 600) for n in pd_.FEATURES.values()], 1)
    total = rng.integers(1, 5, 600).astype(float)
    rule = (x[:, 1] > 8) & (x[:, 2] == 1)
    trees, bias = pd_.boost(x, total * rule, total)
    names = list(pd_.FEATURES)

    def value(node, row):
        while isinstance(node, tuple):
            node = node[2] if row[names.index(node[0])] <= node[1] else node[3]
        return node

    z = np.array([bias + sum(value(t, r) for t in trees) for r in x])
    assert ((z > 0) == rule).mean() > 0.97
    a, b = pd_.calibrate(z * 2, total * rule, total)
    assert np.isfinite(a) and np.isfinite(b) and a > 0


def test_expression_equals_the_model(spark):
    model = pd_.Model([("digits", 3, ("plus", 0, -1.0, 0.5), 2.0)], bias=0.25, slope=2.0, shift=-0.5)
    f = {k: 0 for k in pd_.FEATURES}
    for d, plus, z in ((2, 0, -0.75), (2, 1, 0.75), (4, 0, 2.25)):
        row = spark.range(1).select(F.struct(*[F.lit({**f, "digits": d, "plus": plus}[k]).alias(k) for k in f]).alias("f"))
        assert row.select(model.probability(F.col("f"))).first()[0] == pytest.approx(1 / (1 + np.exp(-(2 * z - 0.5))))


def test_redact_and_join(spark):
    row = spark.createDataFrame([("é a@b.co, 10.0.0.1!",)], "text string")
    spans = pd_.base_spans(F.col("text"))
    r = row.select(pd_.redact(F.col("text"), spans).alias("t"), pd_.join_spans(spans).alias("s"), F.sha2(pd_.join_spans(spans), 256).alias("h")).first()
    assert r.t == "é <email>, <ip>!" and r.s == "email:2:8,ip:10:18"
    assert r.h == hashlib.sha256(r.s.encode()).hexdigest()


def test_base_cards_with_every_digit_apart(spark):
    texts = ["4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "pay 4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1 now", "4 1-1 11 1 1-1 1 1 11 1 1 1", "4 1 1 1 1 1 1  1 1 1 1 1 1 1 1 1"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = {r.i: [tuple(s) for s in r.b] for r in df.select("i", pd_.base_spans(F.col("text")).alias("b")).collect()}
    assert [got[i] for i in range(len(texts))] == [plain_base(t) for t in texts]
    assert got[0] == [(0, 2, 31)] and got[1] == [(4, 2, 35)] and got[3] == []

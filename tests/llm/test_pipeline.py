import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from entityflow.llm import decontamination, toxicity
from entityflow.llm.queries import toxicity_model

from test_decontamination import plain_found, stretches
from test_mixing import water_fill
from test_simhash import plain_classes, plain_fingerprint


def test_registered():
    names = queries()
    assert {f"op{n}_" for n in range(1, 14)} <= {re.match(r"op\d+_|", k).group() for k in names}
    assert "pipeline" in names and set(oracle_sql()) <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "decontamination", "mixing", "token ids"]


def test_stages_against_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, out = docs.columns, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        if number < 4:
            assert docs.columns == columns
        out.append((before.collect(), docs.collect()))

    given, kept = out[0]
    model = toxicity_model(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    reader = toxicity.Reader(model.language)
    weight = dict(zip(model.forms, model.weights.tolist()))
    def z(text):
        words = reader.words_of(toxicity.lowered(pa.array([text])))[0]
        return model.bias + sum(weight.get(f, 0.0) for f in toxicity.forms(words))
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in given if z(r.text) < 0)

    given, kept = out[1]
    label = plain_classes([plain_fingerprint(r.text) for r in given], [r.doc_id for r in given])
    assert sorted(r.doc_id for r in kept) == sorted(set(label))

    given, kept = out[2]
    gone = {r.doc_id for r in given} - {r.doc_id for r in kept}
    items = {r.item_id: decontamination.folded(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    index = decontamination.Index(list(items.items()))
    parts = [w for item in items.values() for w, _ in stretches(item)[::50]]
    for r in given:
        text = decontamination.folded(r.text)
        if r.doc_id in gone:
            found = decontamination.find([r.text], index)[0]
            assert found and (len(text) > 3000 or all(plain_found(items[k], text) for k in found))
        else:
            assert not any(w in f" {text} " for w in parts)

    given, mixed = out[3]
    size, taken = Counter(), Counter()
    words = {r.doc_id: len(r.text.split()) for r in given}
    for r in given:
        size[r.source] += words[r.doc_id]
    for r in mixed:
        taken[r.source] += words[r.doc_id]
    for k, want in water_fill(size).items():
        assert abs(taken[k] - want) <= 0.05 * want
    assert max(Counter(r.doc_id for r in mixed).values()) <= 2

    given, coded = out[4]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at, by_id = 0, defaultdict(list)
    for r in given:
        ids = library.encode(r.text, add_special_tokens=False).ids + [1]
        by_id[r.doc_id].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = sorted(coded, key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in given)
    for r in got:
        assert r.start == at
        by_id[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        at += r.n_tokens


def test_odd_documents_pass_through(spark, documents, tmp_path):
    rows = [(i, f"plain words of text number {i} and some more of them {i * 7}", "en", f"s{i % 3}") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "long " * 30_000), (102, "long " * 30_000), (None, "no id", "en", "s1"), (103, "x", None, None)]
    docs = documents(rows).withColumn("size", F.lit(1)).withColumn("text2", F.lit("y"))
    for part in (docs, docs.limit(0)):
        got = part
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            place = str(tmp_path / f"{part is docs}-{number}")
            stage(spark, got, "/root/testdata/sf0.001").write.parquet(place)
            got = spark.read.parquet(place)
        assert (got.count() > 0) == (part is docs)

import numpy as np

from entityflow.llm import language_id
from entityflow.llm.common import crc_mod


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs.where(crc_mod("doc_id", 3) != 1))
    held = docs.where(crc_mod("doc_id", 3) == 1)
    truth = {r.doc_id: r.lang for r in held.collect()}
    got = language_id.identify(held, model).collect()
    assert len(got) == len(truth)
    assert np.mean([truth[r.id] == r.lang_pred for r in got]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)
    assert (model.weights == 0).mean() > 0.5
    again = language_id.train(docs.where(crc_mod("doc_id", 3) != 1).repartition(3))
    assert np.allclose(again.weights, model.weights) and again.temperature == model.temperature


def test_odd_rows(spark, documents):
    rows = [(i, t, k) for i, (t, k) in enumerate([("the cat sat on the mat with that hat", "aa"), ("der hund und die katze sind im haus", "bb")] * 30)]
    rows += [(100, None, "aa"), (101, "", "bb"), (102, "123 !?", "aa"), (103, "und", None), (104, "the cat " * 200_000, "aa")]
    docs = documents(rows).withColumnRenamed("n_chars", "score").withColumnRenamed("source", "lang_pred")
    model = language_id.train(docs)
    assert model.languages == ["aa", "bb"]
    got = {r.id: (r.lang_pred, r.score) for r in language_id.identify(docs, model).collect()}
    assert got[0][0] == "aa" and got[1][0] == "bb" and got[104][0] == "aa" and got[103][0] == "bb"
    assert got[100] == got[101] == got[102] == ("und", 0.0)
    empty = language_id.train(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs, empty).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).count() == 0


def test_elastic_net_leader_separates():
    leader = language_id.Leader(2)
    rng = np.random.default_rng(0)
    for _ in range(400):
        k = int(rng.integers(2))
        leader.step(np.array([k, 5]), np.array([1.0, 0.01]), k)
    w = leader.weights(slice(None))
    assert w[0, 0] > 0.5 > w[0, 1] and w[1, 1] > 0.5 > w[1, 0]
    assert (w[5] == 0).all() and (w[6:-1] == 0).all()


def test_temperature():
    rng = np.random.default_rng(0)
    logits = rng.normal(size=(4000, 3)) * 2
    p = language_id.softmax(logits)
    labels = np.array([rng.choice(3, p=r) for r in p])
    assert abs(language_id.fit_temperature(logits * 3, labels) - 3) < 0.4

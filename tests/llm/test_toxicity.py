import random

import numpy as np
import pyarrow as pa
import pytest

from entityflow.llm import toxicity
from entityflow.llm.common import crc_mod


@pytest.fixture(scope="module")
def model(spark):
    sf = "/root/testdata/sf0.1"  # the smaller tables have some insults in too few documents
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    return toxicity.train(docs, labels.where(crc_mod("doc_id", 5) != 0))


def test_restores_obfuscated_words(model):
    for written, meant in {"1d10t": "idiot", "s.t.u.p.i.d": "stupid", "stuuuupid": "stupid", "m0r0n": "moron", "l0ser": "loser", "$cum": "scum"}.items():
        assert toxicity.restore(written, model.language) == meant


def words_of(model, text):
    return toxicity.Reader(model.language).words_of(toxicity.lowered(pa.array([text])))[0]


def test_spacing_doubling_and_substitution_together(model):
    for written, meant in {"i d 1 o t": "idiot", "m 0 r o n": "moron", "s  t  u  p  i  d": "stupid", "what d i e now": "die", "stuupid": "stupid",
                           "ssttuuppiidd": "stupid", "y o u a r e s c u m": "scum", "S T U P I D": "stupid", "s.t.u.p.i.d": "stupid", "i-d-i-o-t": "idiot",
                           "a s t u p i d man": "stupid", "$ t u p 1 d !": "stupid", "m o\tr\no n": "moron", "x" * 60 + "-m0r0n": "moron"}.items():
        assert meant in words_of(model, written), written
    assert words_of(model, "1 2 3") == set()


def obfuscated(rng, word):
    """One way to hide a word: signs for letters, blanks or signs between all letters, letters repeated, or two of these."""
    signs = {r: [c for c, used in toxicity.LEET.items() if r in used and c.isascii()] for r in word}
    letters = list(word)
    if rng.random() < 0.5:
        may = [k for k, r in enumerate(word) if signs[r]]
        for k in rng.sample(may, min(len(may), rng.randint(1, 2))):
            letters[k] = rng.choice(signs[word[k]])
    kind = rng.choice(["as it is", "apart", "parted", "repeated"])
    if kind == "repeated":
        k = rng.randrange(len(letters))
        letters[k] *= rng.randint(2, 5)
    return rng.choice([" ", "  "]).join(letters) if kind == "apart" else rng.choice(".-_*").join(letters) if kind == "parted" else "".join(letters)


def test_planted_forms_are_restored(model):
    rng = random.Random(11)
    planted = [(w, obfuscated(rng, w)) for w in ["idiot", "stupid", "moron", "loser", "pathetic", "worthless", "disgusting"] for _ in range(60)]
    plain = toxicity.forms(words_of(model, "the house on the hill"))
    found = [bool(toxicity.forms({w}) & toxicity.forms(words_of(model, f"the house {hidden} on the hill")) - plain) for w, hidden in planted]
    whole = [w in words_of(model, f"the house {hidden} on the hill") for w, hidden in planted]
    assert np.mean(found) >= 0.95  # the word or its beginning, both are features
    assert np.mean(whole) >= 0.85  # the double s of one word is merged whenever it is read


def test_scores_read_all_that_matters(model):
    """The patterns and lookups that spare reading lose nothing: every text scores as if all of it were read."""
    rng = random.Random(12)
    parts = ["idiot", "stupid", "moro", "the", "house", "scum", "loser", "1d", "10t", "s", "t", "u", "p", "$", "!", ".", "-", "€", "£", "é", "óo", "ll", "  ", " ", "\n", "_", "ß", "7", "worthles"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(1500)]
    texts += [" ".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(1500)]
    texts += [obfuscated(rng, f.rstrip("*")) for f in model.forms for _ in range(5)]
    scorer, reader = toxicity.Scorer(model), toxicity.Reader(model.language)
    column = pa.array([*texts, None])
    want = [scorer.of_words(words) for words in reader.words_of(toxicity.lowered(column))]
    assert scorer.scores(column).to_pylist() == want
    assert len(set(want)) > 20


def test_viterbi_finds_the_cheapest_reading(model):
    """Against all readings of a short stretch, one by one."""
    def readings(text, apart, out="", price=0.0, fresh=False):
        if not text:
            yield out, price
            return
        c = text[0]
        if apart and out and not out.endswith(" ") and not fresh:
            yield from readings(text, apart, out + " ", price, True)
        for r, p in ([(c, 0.0)] if c.isalpha() else [(r, toxicity.COST_LEET) for r in toxicity.LEET.get(c, "")]):
            yield from readings(text[1:], apart, out + r, price + p)
            if out[-1:] == r:
                yield from readings(text[1:], apart, out, price + p + toxicity.COST_MERGE)
        if not c.isalpha():
            lost = toxicity.COST_LOSE_LEET if c in toxicity.LEET else toxicity.COST_DROP
            yield from readings(text[1:], apart, out, price + lost)
            if out and not out.endswith(" "):
                yield from readings(text[1:], apart, out + " ", price + lost)

    def total(out, price):
        state = (0,) * (toxicity.ORDER - 1)
        for s in [*toxicity.symbols(out).tolist(), *([] if out.endswith(" ") or not out else [0])]:
            price += model.language.cost(state, s)
            state = (*state[1:], s)
        return price

    for text in ["t1l!", "aa-b0", "5o$$", "hee3", "1.1x", "a.b"]:
        for apart in (False, True):
            want = min((round(total(o, p), 5), o.strip()) for o, p in readings(text, apart))
            assert toxicity.restore(text, model.language, apart) == want[1]


def test_language_model_sums_to_one(model):
    p = np.exp(-model.language.costs.reshape(-1, toxicity.ALPHABET).astype(float)).sum(1)
    assert np.allclose(p, 1, atol=1e-3)


def test_held_out_rows(spark, model):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    score = {r.id: r.score for r in toxicity.score(docs, model).collect()}
    held = labels.where(crc_mod("doc_id", 5) == 0).collect()
    wrong = [r.doc_id for r in held if not r.toxic and score[r.doc_id] >= 0.5]
    english = {r.doc_id for r in docs.where("lang = 'en'").collect()}
    # In this table, the toxic labels of junk rows and of other languages go with nothing in the text.
    toxic = [score[r.doc_id] for r in held if r.toxic and r.quality and r.doc_id in english]
    assert len(wrong) <= 0.005 * len(held)
    assert np.mean(np.array(toxic) >= 0.5) >= 0.9


def test_obfuscated_texts(documents, model):
    rows = [(1, "you are an 1d10t , really"), (2, "what a s t u p i d thing"), (3, "the house is on the hill"), (4, None), (5, ""), (6, "loooser"),
            (7, "the house " * 20_000 + " moron"), (3, "the house is on the hill"), (None, "scum")]
    docs = documents(rows).withColumnRenamed("n_chars", "score").withColumnRenamed("lang", "id")
    got = [(r.id, r.score) for r in toxicity.score(docs, model).collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s in got)
    score = dict(got)
    for clean in (3, 4, 5):
        for bad in (1, 2, 6, 7, None):
            assert score[clean] < score[bad]
    kept = toxicity.reject(docs, model, (score[3] + score[1]) / 2)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id in (3, 4, 5)) == [3, 3, 4, 5]
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_no_usable_labels(spark, documents):
    docs = documents([(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    for labels in (none, one):
        assert all(r.score < 0.01 for r in toxicity.score(docs, toxicity.train(docs, labels)).collect())


def test_labels_of_other_documents(spark, documents):
    """Labels of both kinds, but none of a row at hand, or of one kind at hand: no score is NaN and no row is dropped."""
    docs = documents([(i, f"plain words {i}") for i in range(10)])
    both = spark.createDataFrame([(1000 + i, i % 2) for i in range(50)], "doc_id long, toxic int")
    for labels in (both, both.unionByName(spark.createDataFrame([(i, 1) for i in range(10)], "doc_id long, toxic int"))):
        model = toxicity.train(docs, labels)
        assert all(0 <= r.score < 0.01 for r in toxicity.score(docs, model).collect())
        assert toxicity.reject(docs, model).count() == 10


def test_words_of_columns(model):
    reader = toxicity.Reader(model.language)
    column = pa.array(["skip", "ab ab, ab", None, "", "ab cd"]).slice(1)
    assert reader.words_of(toxicity.lowered(column)) == [{"ab"}, set(), set(), {"ab", "cd"}]
    assert reader.words_of(toxicity.lowered(pa.array([], pa.string()))) == []
    assert toxicity.forms({"ab", "abcdef"}) == {"ab", "abcdef", "abcd*", "abcde*"}


def test_reject_cuts_batches_like_the_scores(documents, model):
    """Batches of many megabytes are cut into steps; each step's decisions meet its own rows."""
    docs = documents([(i, ("moron " if i % 2 else "") + "house on the hill " * 40_000) for i in range(24)]).coalesce(1)
    clean, bad = toxicity.Scorer(model).scores(pa.array(["house", "moron house"])).to_pylist()
    assert sorted(r.doc_id for r in toxicity.reject(docs, model, (clean + bad) / 2).collect()) == [i for i in range(24) if i % 2 == 0]

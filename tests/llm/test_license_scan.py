import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from entityflow.llm import license_scan
from entityflow.llm.license_scan import PHRASES, TEMPLATES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_matches(text, templates=TEMPLATES, phrases=PHRASES, share=0.9):
    """Every block of every template, every place of every phrase."""
    words, out = plain_words(text), []
    for label, template in templates:
        tokens = set(plain_words(template))
        stride = 1
        while stride < len(plain_words(template)):
            stride *= 2
        for start in range(0, len(words), stride) if tokens else ():
            shared = len(tokens & set(words[start:start + 2 * stride]))
            if shared >= math.ceil(share * len(tokens)):
                out.append((label, False, start, shared / len(tokens)))
    for label, phrase in phrases:
        p = plain_words(phrase)
        out += [(label, True, i, 1.0) for i in range(len(words)) if p and words[i:i + len(p)] == p]
    return Counter(out)


def compare(spark, documents, rows, **more):
    docs = documents(rows).withColumn("matches", F.lit(1)).withColumn("n_words", F.lit(2)).repartition(3)
    got = license_scan.scan(docs, **more)
    assert got.columns == ["id", "n_words", "matches"]
    plain_args = {k: more[k] for k in ("templates", "phrases") if k in more} | ({"share": more["containment"]} if "containment" in more else {})
    found = sorted(((r.id is None, r.id, r.n_words, sorted(Counter(tuple(m) for m in r.matches).items())) for r in got.collect()), key=str)
    want = sorted(((i is None, i, len(plain_words(t)), sorted(plain_matches(t, **plain_args).items())) for i, t in rows), key=str)
    assert found == want
    return found


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    fill = ["the", "license", "of", "under", "gnu", "mit", "by", "ümlaut", "Öl", "x1", "software", "is", "this", "copy"]
    pool = [w for _, t in [*TEMPLATES, *PHRASES] for w in t.split()]
    out = []
    for i in range(250):
        words = [rng.choice(fill if rng.random() < 0.5 else pool) for _ in range(rng.randrange(120))]
        if rng.random() < 0.7:
            notice = rng.choice([*TEMPLATES, *PHRASES])[1].split()
            for _ in range(rng.randrange(4)):
                notice[rng.randrange(len(notice))] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = notice
        out.append((i, rng.choice([" ", "\n", "-", " | "]).join(words)))
    out += [(900, None), (901, ""), (902, "...\x7f\x00"), (903, "MIT license"), (903, "MIT license"), (None, "CC-BY 4.0"), (904, "MİT LICENSE mit\xa0license"),
            (905, "mit license " * 3000 + "apache"), (906, "w " * 600_000 + "gnu general public license" + " w" * 600_000), (907, "gnu " * 40_000)]
    return out


def test_scan_against_every_block(spark, documents, rows):
    found = compare(spark, documents, rows)
    assert sum(bool(m) for _, _, _, m in found) > 100


def test_other_templates_and_shares(spark, documents, rows):
    more = {"templates": [("a", "of the license under x1"), ("a", "gnu"), ("b", ""), ("c", "this software is the copy of this software x1 by mit")],
            "phrases": [("p", "the the"), ("q", "by"), ("r", "  ")]}
    compare(spark, documents, rows, containment=0.6, **more)
    compare(spark, documents, rows, containment=1.0, **more)


def test_phrase_across_blocks_and_pieces(spark, documents, monkeypatch):
    rows = [(k, " ".join(["w"] * k + ["gnu general public license"] + ["w"] * 5)) for k in range(40)]
    compare(spark, documents, rows)
    monkeypatch.setattr(license_scan, "PIECE_BYTES", 7)
    for _, text in rows:
        assert license_scan.words_of(text) == plain_words(text)


def test_empty_table_and_bound(spark, documents, monkeypatch):
    docs = documents([(1, "mit license")])
    assert license_scan.scan(docs.limit(0)).count() == 0
    monkeypatch.setattr(license_scan, "MOST_TEMPLATE_WORDS", 20)
    with pytest.raises(ValueError):
        license_scan.scan(docs)

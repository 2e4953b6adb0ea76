import hashlib
import random
import re

from pyspark.sql import functions as F

from entityflow.llm import fill_in_middle as fim

PLAIN_UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) from the rules, unit by unit."""
    text, hexed = text or "", hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[8 * k:8 * k + 8], 16) for k in range(4))
    units = PLAIN_UNITS.findall(text)
    n = len(units)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    prefix, middle, suffix = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_units_need_no_way_back():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(" \t\n\x0b\x0c\rab\x1c\x85 é😀") for _ in range(rng.randrange(14)))
        assert fim.UNITS.fullmatch(text).ends(1) == [m.end() for m in PLAIN_UNITS.finditer(text)]


def test_odd_rows_against_plain(spark, documents):
    rng = random.Random(2)
    alphabet = ["a", "B ", " ", "\n", "é", "😀", "<", ">", "<P", "S>", "<M", "ß\t"]
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(30)))) for i in range(600)]
    rows += [(1000 + i, f"some words {m} and more <") for i, m in enumerate(["<P>", "<S>", "<M>", "<p>", "< P>"] * 8)]
    rows += [(None, None), (None, "no id here"), (2000, None), (2001, ""), (2001, ""), (2002, " \n\t "), (-5, "a minus id")]
    rows += [(3000 + i, "x" * 300_000 + " y" * 60_000 + "\n") for i in range(4)]
    docs = documents(rows).withColumn("n", F.lit(7)).withColumn("form", F.lit("?"))
    found = fim.fill_in_middle(docs)
    assert found.columns == ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = found.withColumn("restored", fim.restore(F.col("output"), F.col("form"))).collect()
    order = lambda r: tuple((v is None, v) for v in r)
    assert sorted(((r.id, *r[1:6]) for r in got), key=order) == sorted(((i, *plain(i, t)) for i, t in rows), key=order)
    assert sorted(((r.id, r.restored) for r in got), key=order) == sorted(((i, t or "") for i, t in rows), key=order)
    assert {r.form for r in got} == {"plain", "spm", "psm"}


def test_parameters_and_empty_table(spark, documents):
    docs = documents([(i, f"one two three {i}") for i in range(200)])
    assert fim.fill_in_middle(docs.limit(0)).count() == 0
    assert {r.form for r in fim.fill_in_middle(docs, share=100, suffix_first_share=0).select("form").collect()} == {"psm"}
    assert {r.form for r in fim.fill_in_middle(docs, share=0).select("form").collect()} == {"plain"}
    a, b = ([r.output for r in fim.fill_in_middle(docs, seed=s).orderBy("id").collect()] for s in (42, 43))
    assert a != b

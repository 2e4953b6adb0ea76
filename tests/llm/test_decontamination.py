import random
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from entityflow.llm import decontamination as d


def plain_occurs(window, text, edits):
    """Edit distance of the window to the best stretch of the text, in full."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(window, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (w != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row) <= edits


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        k, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[k] = rng.choice("xyz")
        elif kind == 1:
            out.insert(k, rng.choice("xyz "))
        else:
            del out[k]
    return "".join(out)


def codes(text):
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def test_folded():
    assert d.folded("  Ab--C \n É9!") == "ab c é9"
    assert d.folded("") == "" and d.folded("?!") == ""


def stretches(item):
    """(text, edits) of all stretches of a folded item, as the docstring defines them."""
    if len(item) < 30:
        return [(f" {item} ", 0)] if item.count(" ") >= 2 else []
    w = min(100, len(item))
    edits = int(w * 0.08)
    while w + 1 - 10 * (edits + 1) < 1:
        edits -= 1
    return [(item[s:s + w], edits) for s in range(len(item) - w + 1)]


def plain_found(item, text):
    """Whether any stretch occurs, by the full table of all stretches side by side."""
    every = stretches(item)
    if not every:
        return False
    if every[0][1] == 0:
        return any(w in f" {text} " for w, _ in every)
    text, windows = codes(text), np.array([codes(w) for w, _ in every])
    row, step = np.zeros((len(every), len(text) + 1), int), np.arange(len(text) + 1)
    for i in range(windows.shape[1]):
        new = np.minimum(row + 1, np.pad(row[:, :-1] + (text != windows[:, i:i + 1]), ((0, 0), (1, 0)), constant_values=10 ** 6))
        row = np.minimum.accumulate(new - step, axis=1) + step
    return bool(row.min() <= every[0][1])


@settings(max_examples=150, deadline=None)
@given(st.text("ab", min_size=4, max_size=12), st.text("ab", max_size=14), st.integers(0, 3))
def test_alignment_equals_the_full_table(window, text, edits):
    # The band covers all diagonals of a text about as long as the window.
    got = d.aligned(codes(window)[None], codes(text)[None], edits)[0]
    assert got == plain_occurs(window, text, edits) or len(text) < len(window) - edits


def prose_of(rng):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    return lambda n: " ".join(word() for _ in range(n))


def test_scan_against_brute_force():
    rng = random.Random(5)
    prose = prose_of(rng)
    items = [prose(n) for n in (3, 5, 8, 14, 18, 20, 30, 50)]
    index = d.Index(list(enumerate(items)))
    texts = []
    for k in range(64):
        part = edited(rng, items[k % 8], [0, 3, 8, 25][k // 8 % 4])
        if k % 5 == 0:
            part = part[len(part) // 3:]
        texts.append(prose(rng.randint(0, 30)) + " " + part + " " + prose(rng.randint(0, 20)))
    texts += [prose(60) for _ in range(8)]
    for text, found in zip(texts, d.find(texts, index)):
        assert found == [i for i, item in enumerate(items) if plain_found(item, d.folded(text))]


def test_excerpts_at_every_offset():
    rng = random.Random(8)
    prose = prose_of(rng)
    item = prose(60)[:300]
    index = d.Index([(7, item)])
    around = [prose(40), prose(40)]
    texts = [f"{around[0]} {item[a:a + 100]} {around[1]}" for a in range(201)]
    assert d.find(texts, index) == [[7]] * 201
    changed = [f"{around[0]} {edited(rng, item[a:a + 110], 6)} {around[1]}" for a in range(0, 190, 3)]
    assert d.find(changed, index) == [[7]] * len(changed)
    assert d.find([f"{around[0]} {item[a:a + 60]} {around[1]}" for a in range(0, 240, 7)], index) == [[]] * 35


def test_short_items():
    index = d.Index([(1, d.folded("What is the capital of Peru?")), (2, "peru"), (3, d.folded("Is it so?")), (4, "")])
    texts = ["So: what is the Capital of PERU!", "what is the capital of perus", "somewhat is the capital of peru", "is it so", "this is it, so", "peru", ""]
    assert d.find(texts, index) == [[1], [], [], [3], [3], [], []]


def test_many_items():
    rng = random.Random(3)
    items = [(i, f"{i:06d} " + "".join(rng.choices("abcdefghijkl ", k=30)).strip().replace("  ", " ")) for i in range(100_000)]
    index = d.Index(items)
    wanted = [10, 50_000, 80_000, 83_887, 84_000, 90_000, 99_000, 99_999]
    assert d.find([f"see {items[i][1]} there" for i in wanted], index) == [[i] for i in wanted]


def test_repeated_lines_take_seconds():
    rng = random.Random(4)
    prose = prose_of(rng)
    line = prose(30)[:100].strip()
    items = [(i, f"{prose(10)} {line} {prose(rng.randint(5, 20))}") for i in range(300)]
    index = d.Index(items)
    begun = time.time()
    found = d.find([f"{line} " * 10_000, " ".join(f"{line} {prose(1)}" for _ in range(100)), "a" * 1_000_000], d.Index(items[:20] + [(900, "a" * 500_000)]))
    assert found == [list(range(20))] * 2 + [[900]]
    assert d.find([f"{line} " * 200], index) == [list(range(300))]
    assert time.time() - begun < 40


def test_documents(spark, sf):
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    texts = {r.doc_id: d.folded(r.text) for r in docs.collect()}
    items = {r.item_id: d.folded(r.text) for r in bench.collect()}
    got = {(r.id, r.item) for r in d.leaks(docs, bench).collect()}
    parts = {k: [w for w, _ in stretches(s)[::50]] for k, s in items.items()}
    assert {(i, k) for i, t in texts.items() for k, ws in parts.items() if any(w in f" {t} " for w in ws)} <= got
    assert all(plain_found(items[k], texts[i]) for i, k in sorted(got)[::10] if len(texts[i]) < 3000)
    kept = {r.doc_id for r in d.clean(docs, bench).collect()}
    assert kept == set(texts) - {i for i, _ in got}


def test_odd_rows(spark, documents, monkeypatch):
    item = "the quick brown fox jumps over the lazy dog near the old river bank"
    bench = spark.createDataFrame([(1, item), (2, "short"), (3, None), (None, item), (4, item)], "item_id long, text string").withColumnRenamed("text", "doc_id_text")
    rows = [(1, f"So: {item.upper()}!"), (2, None), (3, ""), (1, f"So: {item.upper()}!"), (None, item), (5, "w " * 600_000 + item + " w" * 9), (6, "short")]
    docs = documents(rows).withColumnRenamed("n_chars", "item")
    monkeypatch.setattr(d, "BLOCK_CHARS", 50)  # one item per pass
    got = sorted(((r.id, r.item) for r in d.leaks(docs, bench, item_text_col="doc_id_text").collect()), key=repr)
    assert got == sorted([(i, k) for i in (1, 1, None, 5) for k in (1, 4)], key=repr)
    kept = d.clean(docs, bench, item_text_col="doc_id_text")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 6]
    assert d.clean(docs, bench.limit(0), item_text_col="doc_id_text").count() == len(rows)
    assert d.leaks(docs, bench.limit(0), item_text_col="doc_id_text").count() == 0
    assert d.clean(docs.limit(0), bench, item_text_col="doc_id_text").count() == 0

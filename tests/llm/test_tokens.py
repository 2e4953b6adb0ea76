import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from entityflow.llm import token_counts, token_planes

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TRICKY = st.lists(st.sampled_from([
    "the", " ", "  ", "\n", " \n", "\t", "'s", "'re", "'", "''ll", "don't", "1", "23", "é", "É", "́", " ", " ", "\x1c", "\x85",
    "!", "?!", ".,", "word.", "<|endoftext|>", "<|endof", "<|startoftext|>", "😀", "İ", "ß", "ΣΣ", "ﬁ", "½", "Ⅷ", "_", "a_b", "日本", "aaaa", "r", "e"]), max_size=25).map("".join)
CASES = st.lists(st.sampled_from(["<|ENDOFTEXT|>", "<|EndOfText|>", "<|StartOfText|>", "<|startoftext|>", "x", "X", "É", "é", "İ", "İ.", "İstanbul,", ".", ",", "..,", "́", "̈",
                                  "\u0149", "\u01F0", "\u1E9E", "ß", "Straße.", "ÀÉÎ", "K", "Å", "ﬀ", "'S", "'s", "a'LL", "×", "÷", "ª", "µ", "ÿ", "Ÿ", "가", "\u1100\u1161", " ", " ", "\u2003"]),
                 max_size=16).map("".join)
TEXTS = st.lists(st.one_of(TRICKY, st.none(), st.text(max_size=40)), min_size=1, max_size=6)


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(BYTE_BPE), Tokenizer.from_file(WORD_BPE)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_counts_equal_the_library(libraries, texts):
    want = [len(libraries[0].encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert COUNTER.counts(pa.array(texts, pa.string())).tolist() == want


@settings(max_examples=800, deadline=None)
@given(st.one_of(TEXTS, st.lists(CASES, min_size=1, max_size=6)))
def test_ids_equal_the_library(libraries, texts):
    ids, sizes = ENCODER.encode(pa.array(texts, pa.string()), 1)
    want = [libraries[1].encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_many_words_at_once(libraries):
    """Words encoded together get the ids that each gets alone, also when the cache is emptied on the way."""
    rng = np.random.default_rng(3)
    letters = list("abcdefghijklmnopqrstuvwxyzéèüßÀÖABCXYZ")
    encoder = token_planes.Encoder(WORD_BPE)
    encoder.PARTS = 500
    for _ in range(6):
        texts = [" ".join("".join(rng.choice(letters, rng.integers(1, 12))) + rng.choice(["", "", ".", ",", "...", "!", "-x"]) for _ in range(300)) for _ in range(5)]
        ids, sizes = encoder.encode(pa.array([*texts, None]), 1)
        want = [libraries[1].encode(t, add_special_tokens=False).ids + [1] for t in [*texts, ""]]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


COUNTER, ENCODER = token_counts.Counter(BYTE_BPE), token_planes.Encoder(WORD_BPE)


def test_state_maps_agree_with_one_walk():
    rng = np.random.default_rng(1)
    classes = rng.integers(0, 16, 5000).astype(np.uint8)
    classes[0] = 8
    nexts, begins = token_counts.compile_splitter()
    state, want = 0, []
    for c in classes:
        at = state * token_counts.CLASSES + int(c)
        want.append(bool(begins[at]))
        state = int(nexts[at])
    assert token_counts.run(classes, nexts, begins).tolist() == want


def test_slices_and_empty_columns(libraries):
    column = pa.array(["skip", None, "", "one two", "it's\n\n x"], pa.string()).slice(1)
    assert COUNTER.counts(column).tolist() == [0, 0, 2, len(libraries[0].encode("it's\n\n x").ids)]
    assert COUNTER.counts(pa.array([], pa.string())).tolist() == []
    ids, sizes = ENCODER.encode(column.slice(0, 2), 1)
    assert ids.tolist() == [1, 1] and sizes.tolist() == [1, 1]


@pytest.mark.parametrize("planes", [4, 32])
@pytest.mark.parametrize("n", [0, 1, 7, 100, 1000])
def test_container_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    data = token_planes.pack(ids, planes, block_ids=64)
    assert token_planes.unpack(data).tolist() == ids.tolist()
    assert token_planes.unpack(data, 3, 90).tolist() == ids[3:90].tolist()
    with pytest.raises(ValueError):
        token_planes.unpack(b"xxxx" + data[4:])


def test_write_and_read(spark, documents, tmp_path, libraries):
    long = "word " * 40_000
    rows = [(5, "b c"), (2, None), (9, long), (2, "a"), (None, "x y z"), (7, ""), (5, "b c")]
    docs = documents(rows).withColumnRenamed("n_chars", "tie")
    path = str(tmp_path / "tokens")
    token_planes.write_tokens(docs.repartition(3), WORD_BPE, 1, path)
    got = sorted((r for r in token_planes.read_tokens(spark, path).collect()), key=lambda r: r.start)
    assert [r.id for r in got] == [None, 2, 2, 5, 5, 7, 9]
    at = 0
    texts = {None: ["x y z"], 5: ["b c"], 7: [""], 9: [long], 2: ["", "a"]}
    for r in got:
        crcs = [zlib.crc32(np.array(libraries[1].encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes()) for t in texts[r.id]]
        assert r.start == at and r.crc32 in crcs
        at += r.n_tokens
    token_planes.write_tokens(docs.limit(0), WORD_BPE, 1, path + "-none")
    assert token_planes.read_tokens(spark, path + "-none").count() == 0


def test_token_counts(documents, libraries):
    docs = documents([(1, "it's"), (2, None), (3, "<|endoftext|> x"), (1, "it's"), (None, "  y")]).withColumnRenamed("lang", "n_tokens")
    got = sorted(map(tuple, token_counts.token_counts(docs, BYTE_BPE).collect()), key=repr)
    want = sorted(((i, len((t or "").encode()), len(libraries[0].encode(t or "").ids)) for i, t in
                   [(1, "it's"), (2, None), (3, "<|endoftext|> x"), (1, "it's"), (None, "  y")]), key=repr)
    assert got == want
    assert token_counts.token_counts(docs.limit(0), BYTE_BPE).count() == 0

"""Token counts of a byte-level BPE through a compiled transducer.

The tokenizer works in two deterministic steps, and both become transducers. The first reads character classes and marks
where each piece begins that merges can't cross. It has 8 states, so a chunk of text is a map from 8 states to 8 states;
the maps of all chunks compose by a parallel prefix scan, which gives every chunk its true start state, and all
chunks then run side by side. The second has one arc per distinct piece, annotated with the number of tokens that the
tokenizers library emits for it; an arc is added when its piece is first seen. A text's count is the sum along its path.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from entityflow.llm.common import id_and_text, id_type, per_process, steps, text_bytes, tokenizer

# The contractions that are pieces of their own, by length, and the separators of the split pattern.
SHORT = "stmd"
LONG = ("re", "ve", "ll")
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Input classes. Bounded lookahead is part of a class: an apostrophe knows whether a contraction follows, a space
# whether it joins the next piece (JOIN), stands alone (ALONE) or belongs to a run of spaces (RUN).
LETTER, NUMBER, OTHER, APOSTROPHE_2, APOSTROPHE_3, JOIN, ALONE, RUN = range(8)
FIRST = 8  # added to the class of a segment's first character
SPECIAL, SPECIAL_REST = 16, 17  # a special string is one piece
CLASSES = 18
# States: what the current piece consists of so far.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_RUN, JOINING, ONE_MORE, TWO_MORE = range(8)
STATES = 8

CHUNK = 512
MERGE_STEPS = 32  # steps after which nearly every chunk's 8 start states have met
ARCS = 400_000
LONGEST_ARC = 64


def compile_splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, does a piece begin) by state * CLASSES + class."""
    begin = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, APOSTROPHE_2: ONE_MORE, APOSTROPHE_3: TWO_MORE,
             JOIN: JOINING, ALONE: FRESH, RUN: IN_RUN}
    others = {c: IN_OTHERS for c in (OTHER, APOSTROPHE_2, APOSTROPHE_3)}
    stay = {
        IN_LETTERS: {LETTER: IN_LETTERS}, IN_NUMBERS: {NUMBER: IN_NUMBERS}, IN_OTHERS: others, IN_RUN: {RUN: IN_RUN},
        JOINING: {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, **others},
        ONE_MORE: dict.fromkeys(range(8), FRESH), TWO_MORE: dict.fromkeys(range(8), ONE_MORE),
    }
    nexts, begins = np.zeros((STATES, CLASSES), np.uint8), np.zeros((STATES, CLASSES), bool)
    for state in range(STATES):
        for c, to in begin.items():
            nexts[state, c] = stay.get(state, {}).get(c, to)
            begins[state, c] = c not in stay.get(state, {})
            nexts[state, c + FIRST], begins[state, c + FIRST] = to, True
        nexts[state, [SPECIAL, SPECIAL_REST]] = FRESH
        begins[state, SPECIAL] = True
    return nexts.ravel(), begins.ravel()


def character_classes() -> np.ndarray:
    """LETTER, NUMBER or OTHER of every code point, with separators as RUN."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[SPACES] = RUN
    return table


def classify(chars: np.ndarray, starts: np.ndarray, table: np.ndarray, special: list[tuple[int, int]]) -> np.ndarray:
    """Class of each character. ``starts``: positions of texts' first characters; ``special``: spans of special strings."""
    n = len(chars)
    first = np.zeros(n + 1, bool)
    first[starts] = True
    first[n] = True
    for a, b in special:
        first[[a, b]] = True
    kind = table[chars]
    follow = np.append(kind[1:], RUN)
    follow[first[1:]] = RUN  # the end of a segment acts like a separator
    out = kind.copy()
    space = kind == RUN
    end_of_run = space & (follow != RUN)
    out[end_of_run] = ALONE
    out[end_of_run & (chars == 0x20)] = JOIN
    at = np.flatnonzero(chars == ord("'"))
    if len(at):
        one, two = np.minimum(at + 1, n - 1), np.minimum(at + 2, n - 1)
        inside = ~first[at + 1]
        out[at[inside & np.isin(chars[one], [ord(c) for c in SHORT])]] = APOSTROPHE_2
        inside &= ~first[np.minimum(at + 2, n)]
        pair = np.zeros(len(at), bool)
        for a, b in LONG:
            pair |= (chars[one] == ord(a)) & (chars[two] == ord(b))
        out[at[inside & pair]] = APOSTROPHE_3
    out[first[:n]] += FIRST
    for a, b in special:
        out[a:b] = SPECIAL_REST
        out[a] = SPECIAL
    return out


def run(classes: np.ndarray, nexts: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each character."""
    n = len(classes)
    chunks = -(-n // CHUNK)
    steps_of = np.full(chunks * CHUNK, SPECIAL_REST, np.int64)
    steps_of[:n] = classes
    steps_of = np.ascontiguousarray(steps_of.reshape(chunks, CHUNK).T)
    # State map of every chunk. Once all start states have met, one state stands for the eight.
    state = np.broadcast_to(np.arange(STATES), (chunks, STATES)).copy()
    for c in steps_of[:MERGE_STEPS]:
        state = nexts[state * CLASSES + c[:, None]].astype(np.int64)
    met = (state == state[:, :1]).all(1)
    one, rest = state[met, 0], state[~met]
    for c in steps_of[MERGE_STEPS:]:
        one = nexts[one * CLASSES + c[met]].astype(np.int64)
        if len(rest):
            rest = nexts[rest * CLASSES + c[~met][:, None]].astype(np.int64)
    state[met], state[~met] = one[:, None], rest
    # Prefix scan of map composition: after step k, a map covers 2^k chunks.
    reach = 1
    while reach < chunks:
        state[reach:] = np.take_along_axis(state[reach:], state[:-reach], 1)
        reach *= 2
    now = np.concatenate([[FRESH], state[:-1, FRESH]])
    out = np.empty((CHUNK, chunks), bool)
    for k, c in enumerate(steps_of):
        at = now * CLASSES + c
        out[k] = begins[at]
        now = nexts[at].astype(np.int64)
    return out.T.ravel()[:n]


class Counter:
    """Counts tokens of whole text columns."""

    def __init__(self, path: str):
        self.library = tokenizer(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.table = per_process("character classes", character_classes)
        self.nexts, self.begins = compile_splitter()
        self.arcs: dict[str, int] = {}

    def arc_counts(self, pieces: list[str]) -> np.ndarray:
        if len(self.arcs) > ARCS:
            self.arcs.clear()
        new = [p for p in pieces if p not in self.arcs]
        fresh = dict(zip(new, (len(e.ids) for e in self.library.encode_batch_fast(new, add_special_tokens=False))))
        counts = np.fromiter((fresh[p] if p in fresh else self.arcs[p] for p in pieces), np.int64, len(pieces))
        self.arcs.update((p, k) for p, k in fresh.items() if len(p) <= LONGEST_ARC)
        return counts

    def special_spans(self, text: str) -> list[tuple[int, int]]:
        spans = []
        for s in self.special:
            at = text.find(s)
            while at >= 0:
                spans.append((at, at + len(s)))
                at = text.find(s, at + len(s))
        return sorted(spans)

    def counts(self, column: pa.Array) -> np.ndarray:
        data, starts = text_bytes(column)
        if not data.size:
            return np.zeros(len(column), np.int64)
        text = data.to_pybytes().decode()
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = np.zeros(len(chars) + 1, np.int64)  # byte position of each character
        np.cumsum(1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000), out=at[1:])
        first = np.searchsorted(at, starts)
        own = np.unique(first[:-1][np.diff(first) > 0])
        # A special string counts only inside one text.
        special = [s for s in self.special_spans(text) if np.searchsorted(own, s[0], "right") == np.searchsorted(own, s[1] - 1, "right")]
        begin = np.flatnonzero(run(classify(chars, own, self.table, special), self.nexts, self.begins))
        offsets = np.append(at[begin], at[-1]).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), data).dictionary_encode()
        emitted = self.arc_counts(pieces.dictionary.to_pylist())[np.asarray(pieces.indices)]
        total = np.concatenate([[0], np.cumsum(emitted)])
        return np.diff(total[np.searchsorted(begin, first)])


def _count(path: str):
    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = per_process(("token counter", path), lambda: Counter(path))
        for batch in steps(batches, keep=True):
            size = np.diff(text_bytes(batch.column(1))[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(counter.counts(batch.column(1)))],
                                             ["id", "n_bytes", "n_tokens"])

    return run_batches


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row, as the byte-level BPE file at ``path`` gives them without added tokens.

    One pass, no shuffle. Null texts are empty and empty texts have no tokens; repeated rows each return; texts of any
    length are counted whole. The arc cache is bounded and only saves work.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(_count(path), f"id {id_type(docs, id_col)}, n_bytes long, n_tokens long")

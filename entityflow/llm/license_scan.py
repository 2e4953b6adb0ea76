"""License scans: an exact set-similarity join between license templates and the blocks of every text.

The tokens of all templates are ordered by how often they occur in the whole table, rarest first. A template of m distinct
tokens that must share c of them with a block shares one of its first m - c + 1, its prefix; a block of n template tokens one
of its first n - c + 1. Only blocks that hold a prefix token are looked at; blocks of fewer than c template tokens are too
short; and from the places of a shared token in both orders it follows how many more can be shared at most. What is left is
counted exactly. Blocks are as long as two templates of their size class and begin at every multiple of one, so that a passage
as long as its template always lies whole in a block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityflow.llm.common import id_and_text, id_type, steps
from entityflow.session import settle

# Phrases whose words stand one after the other.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
# Openings of well-known license notices.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the Software), to deal in the Software without restriction"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
            "published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
# Share of a template's distinct tokens that a block must hold.
CONTAINMENT = 0.9
# Words of all templates together; they travel to every task, so their number is checked.
MOST_TEMPLATE_WORDS = 1 << 20
# Words of a long text are read in pieces of about this many bytes.
PIECE_BYTES = 1 << 20

# Bytes of words stay, capitals in lower case; all others become blanks.
LETTERS = bytes(b if b >= 0x80 or chr(b).isdigit() or "a" <= chr(b) <= "z" else 0x20 for b in bytes(range(256)).lower())


def words_of(text: str | None) -> list[str]:
    return [w.decode() for piece in _pieces(text) for w in piece]


def _pieces(text: str | None) -> Iterator[list[bytes]]:
    data = (text or "").encode().translate(LETTERS)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PIECE_BYTES)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


class Templates:
    """Prefix lists of all templates, by size class; tokens are ranks in the global frequency order."""

    def __init__(self, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]], containment: float, counts: dict[str, int]):
        given = [(label, words_of(text), exact) for exact, group in ((False, templates), (True, phrases)) for label, text in group]
        given = [(label, words, exact) for label, words, exact in given if words]
        if sum(len(words) for _, words, _ in given) > MOST_TEMPLATE_WORDS:
            raise ValueError(f"templates of more than {MOST_TEMPLATE_WORDS} words in all can't be sent to every task")
        tokens = sorted({w for _, words, _ in given for w in words}, key=lambda w: (counts.get(w, 0), w))
        self.rank = {w.encode(): k for k, w in enumerate(tokens)}
        self.label = [label for label, _, _ in given]
        self.phrase = [np.array([self.rank[w.encode()] for w in words]) if exact else None for _, words, exact in given]
        self.tokens = [np.unique([self.rank[w.encode()] for w in words]) for _, words, _ in given]
        self.least = [len(t) if exact else math.ceil(containment * len(t)) for t, (_, _, exact) in zip(self.tokens, given)]
        self.classes: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for k, (_, words, _) in enumerate(given):
            lists = self.classes.setdefault(size_class(len(words)), {})
            for place, token in enumerate(self.tokens[k][:len(self.tokens[k]) - self.least[k] + 1].tolist()):
                lists.setdefault(token, []).append((k, place))
        prefix = {token for lists in self.classes.values() for token in lists}
        self.telling = {w for w, k in self.rank.items() if k in prefix}

    def read(self, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of words, and of the words of templates their places and ranks; none if no prefix token is there."""
        n, places, ranks, telling = 0, [], [], False
        for words in _pieces(text):
            telling = telling or not self.telling.isdisjoint(words)
            found = np.fromiter((self.rank.get(w, -1) for w in words), np.int32, len(words))
            at = np.flatnonzero(found >= 0)
            places.append(at + n)
            ranks.append(found[at])
            n += len(words)
        if not telling:
            return n, np.zeros(0, np.int64), np.zeros(0, np.int32)
        return n, np.concatenate(places), np.concatenate(ranks)

    def find(self, places: np.ndarray, ranks: np.ndarray) -> list[tuple[int, int, float]]:
        """(template, word, containment): for phrases each place, for other templates each block that meets the threshold."""
        found = []
        for stride, lists in self.classes.items():
            here = places[np.isin(ranks, list(lists))] // stride
            for block in np.unique(np.concatenate([here, here - 1])).tolist():
                if block < 0:
                    continue
                start, end = np.searchsorted(places, [block * stride, (block + 2) * stride])
                tokens = np.unique(ranks[start:end])
                for k in self._candidates(tokens.tolist(), lists):
                    shared = len(np.intersect1d(tokens, self.tokens[k], assume_unique=True))
                    if shared < self.least[k]:
                        continue
                    if self.phrase[k] is None:
                        found.append((k, block * stride, shared / len(self.tokens[k])))
                    else:
                        own = np.searchsorted(places, (block + 1) * stride)
                        found += [(k, word, 1.0) for word in self._stand(places, ranks, start, own, self.phrase[k])]
        return sorted(found)

    def _candidates(self, tokens: list[int], lists: dict[int, list[tuple[int, int]]]) -> list[int]:
        """Templates that pass the length and the positional filter; ``tokens`` are those of a block, in order."""
        shared: dict[int, int] = {}
        for i, token in enumerate(tokens):
            for k, j in lists.get(token, ()):
                so_far = shared.get(k, 0) + 1
                most = so_far + min(len(tokens) - i - 1, len(self.tokens[k]) - j - 1)
                # A template is left once it can't be met any more; it stays left.
                shared[k] = so_far if len(tokens) >= self.least[k] and most >= self.least[k] else -len(tokens)
        return [k for k, n in shared.items() if n > 0]

    @staticmethod
    def _stand(places, ranks, start, end, phrase) -> list[int]:
        """First words, between two positions, of places where the phrase stands word by word."""
        at = np.arange(start, end)
        for k, rank in enumerate(phrase.tolist()):
            at = at[at + k < len(places)]
            at = at[(ranks[at + k] == rank) & (places[at + k] == places[at] + k)]
        return places[at].tolist()


def size_class(words: int) -> int:
    """The next power of two."""
    return 1 << (words - 1).bit_length()


def _counts(tokens: list[str]):
    rank = {w.encode(): k for k, w in enumerate(tokens)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(tokens), np.int64)
        for batch in steps(batches, 0):
            for text in batch.column(0):
                for words in _pieces(text.as_py()):
                    found = np.fromiter((rank.get(w, -1) for w in words), np.int32, len(words))
                    total += np.bincount(found + 1, minlength=len(tokens) + 1)[1:]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["token", "n"])

    return run


def token_counts(docs: DataFrame, tokens: list[str], text_col: str = "text") -> dict[str, int]:
    """How often each of the tokens occurs in all texts."""
    texts = id_and_text(docs, text_col, text_col).select("text")
    found = settle(texts.mapInArrow(_counts(tokens), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")), "template-tokens")
    return {tokens[r.token]: r.n for r in found.collect()}  # at most MOST_TEMPLATE_WORDS


MATCHES = "array<struct<label: string, exact: boolean, word: long, containment: double>>"


def _scan(templates: Templates):
    fields = pa.struct([("label", pa.string()), ("exact", pa.bool_()), ("word", pa.int64()), ("containment", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            sizes, matches = [], []
            for text in batch.column(1):
                n, places, ranks = templates.read(text.as_py())
                sizes.append(n)
                matches.append([{"label": templates.label[k], "exact": templates.phrase[k] is not None, "word": word, "containment": share}
                                for k, word, share in (templates.find(places, ranks) if len(places) else ())])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(matches, pa.list_(fields))], ["id", "n_words", "matches"])

    return run


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES,
         containment: float = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, matches) of every row: each place of a phrase, and each block that holds a template's share of tokens.

    Words are runs of letters and digits in lower case (A-Z only; all beyond ASCII counts as letters), numbered from 0. A
    phrase is a template whose tokens must all be in the block; its words are then checked one by one. Null texts are empty,
    repeated rows each return, and templates without words match nothing. One pass counts the templates' tokens in all texts,
    one finds the blocks; no row moves. Templates travel to the tasks; beyond MOST_TEMPLATE_WORDS they are refused.
    """
    tokens = sorted({w for _, text in [*templates, *phrases] for w in words_of(text)})
    if len(tokens) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MOST_TEMPLATE_WORDS} words can't be sent to every task")
    index = Templates(templates, phrases, containment, token_counts(docs, tokens, text_col))
    return id_and_text(docs, id_col, text_col).mapInArrow(_scan(index), f"id {id_type(docs, id_col)}, n_words long, matches {MATCHES}")

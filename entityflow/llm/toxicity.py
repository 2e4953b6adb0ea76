"""Toxicity: noisy-channel restoration of obfuscated words, then a linear score of the restored text.

A character language model gives the cost of a spelling. A suspicious stretch of text (letters mixed with digits or signs,
letters set apart, letters repeated) becomes a lattice: a character may stand for itself or for a letter it is used for,
a sign may be dropped or part two words, a repeated letter may be merged, and between characters set apart a word may
end. Viterbi finds the cheapest reading under channel and language model. Words of the text and of its readings, and their
beginnings, are the features of a sparse logistic model.

A fitted model uses few of them. Patterns made from those, matched in linear time, tell which stretches may be read as one
of them at all; only these are read when texts are scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityflow.llm.common import id_and_text, id_type, per_process, small_batches, steps, unit_hash
from entityflow.session import settle

# The letters that a digit or sign is written for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}

# Of those, the ones beyond ASCII, by one that is used for the same letter.
STAND_INS = {"€": "3", "£": "1"}

# Symbols of the language model: a word boundary, a-z, and other letters by code.
ALPHABET = 32
ORDER = 4
# Channel costs, as negative log probabilities.
COST_LEET, COST_DROP, COST_MERGE, COST_LOSE_LEET = 0.6, 0.4, 0.2, 3.0
LONGEST = 48  # characters of a stretch that is read at once; a longer one is read in windows that overlap by half

BEGINNINGS = (4, 5)  # letters of a word's beginning that are a feature
SAMPLE_ROWS = 40_000  # labelled rows that the classifier is fitted on, about
SELECTED = 4096  # features that the fit may use
LEAST_DOCS = 3  # toxic documents that a feature must be in
ITERATIONS = 400
TOKENS_KEPT = 150_000

PLAIN = re.compile(r"[^\W\d_]+")
DOUBLE = re.compile(r"([^\W\d_])\1")
LONG_RUN = re.compile(r"(.)\1{3,}")
SIGN_RUN = re.compile(r"([^\w\s])\1\1+$")
# What a word may stand between: marks at its ends, and signs that are used for no letter.
ENDS, SIGNS = ".,;:?\"'", "-_*#%&)]}[{"
# Words of these letters without a double one have nothing to restore.
SMALL = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
PLAIN_WORD, DOUBLES = f"^[{SMALL}]+$", "|".join(c * 2 for c in SMALL)
SET_APART = 3  # characters that stand alone one after the other, at least
PATTERN_FORMS = 32  # forms that one pattern looks for


def symbol_table() -> np.ndarray:
    def make():
        table = np.zeros(0x10000, np.uint8)
        for c in range(0x10000):
            if chr(c).isalpha():
                table[c] = c - 96 if 97 <= c <= 122 else 27 + c % (ALPHABET - 27)
        return table

    return per_process("language model symbols", make)


def symbols(text: str) -> np.ndarray:
    """Language-model symbols of a lower-case text; a letter beyond the basic plane counts as a boundary."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return symbol_table()[np.minimum(codes, 0xFFFF)]


def _ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(ALPHABET ** ORDER, np.int64)
    pad = " " * (ORDER - 1)
    for batch in steps(batches, 0):
        s = symbols(pad + pad.join(t for t in pc.utf8_lower(batch.column(0)).to_pylist() if t) + pad).astype(np.int32)
        grams = sum(s[i:len(s) - ORDER + 1 + i] * np.int32(ALPHABET ** (ORDER - 1 - i)) for i in range(ORDER))
        counts += np.bincount(grams, minlength=ALPHABET ** ORDER)
    used = np.flatnonzero(counts)
    for k in range(0, len(used), 1 << 16):
        some = used[k:k + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["gram", "n"])


def count_ngrams(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(gram, n): how often each run of ORDER symbols occurs in all texts. At most ALPHABET^ORDER rows."""
    texts = small_batches(docs).select(F.col(f"`{text_col}`").cast("string").alias("text"))
    return texts.mapInArrow(_ngrams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


class LanguageModel:
    """Cost of a symbol after ORDER - 1 symbols, with absolute discounting towards shorter contexts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, discount: float = 0.4):
        table = np.zeros(ALPHABET ** ORDER)
        table[grams] = counts
        table = table.reshape([ALPHABET] * ORDER)
        p = np.full(ALPHABET, 1 / ALPHABET)
        for order in range(1, ORDER + 1):
            here = table.sum(tuple(range(ORDER - order)))  # counts of the last ``order`` symbols of each run
            total = here.sum(-1, keepdims=True)
            kinds = (here > 0).sum(-1, keepdims=True)
            p = np.where(total > 0, (np.maximum(here - discount, 0) + discount * kinds * p) / np.maximum(total, 1), p)
        self.costs = -np.log(np.maximum(p, 1e-12)).astype(np.float32).ravel()

    def cost(self, context: tuple, symbol: int) -> float:
        key = 0
        for c in context:
            key = key * ALPHABET + c
        return float(self.costs[key * ALPHABET + symbol])


def restore(stretch: str, model: LanguageModel, apart: bool = False) -> str:
    """The cheapest reading of a suspicious stretch (lower case), words parted by blanks.

    A state is the last ORDER - 1 symbols read, as one number. A step reads a character as a letter, merges it into an equal
    letter before it, or, if it is no letter, drops it or ends a word there. With ``apart``, the characters stood alone and a word
    may end after any of them. Of readings of equal cost, the first in alphabetical order counts.
    """
    price, table, states = memoryview(model.costs), symbol_table(), ALPHABET ** (ORDER - 1)
    best: dict[int, tuple[float, str]] = {0: (0.0, "")}

    def offer(to: dict, state: int, symbol: int, cost: float, out: str) -> None:
        """A reading that goes on with a symbol."""
        at = state * ALPHABET + symbol
        found = (cost + price[at], out)
        at %= states
        if at not in to or found < to[at]:
            to[at] = found

    for c in stretch:
        letter = c.isalpha()
        readings = [(r, 0.0 if letter else COST_LEET, int(table[min(ord(r), 0xFFFF)])) for r in (c if letter else LEET.get(c, ""))]
        lost = COST_LOSE_LEET if c in LEET else COST_DROP
        if apart:
            for state, (cost, out) in list(best.items()):
                if state % ALPHABET:
                    offer(best, state, 0, cost, out + " ")
        now: dict[int, tuple[float, str]] = {}
        for state, (cost, out) in best.items():
            for r, extra, symbol in readings:
                offer(now, state, symbol, cost + extra, out + r)
                if out[-1:] == r and (state not in now or (cost + extra + COST_MERGE, out) < now[state]):
                    now[state] = (cost + extra + COST_MERGE, out)
            if not letter:
                if state not in now or (cost + lost, out) < now[state]:
                    now[state] = (cost + lost, out)
                if state % ALPHABET:
                    offer(now, state, 0, cost + lost, out + " ")
        best = now
    return min((cost + (price[state * ALPHABET] if state % ALPHABET else 0.0), out.strip()) for state, (cost, out) in best.items())[1]


def windows(stretch: str) -> list[str]:
    """Pieces of a long stretch that overlap by half, runs of one character shortened to three first."""
    if len(stretch) <= LONGEST:
        return [stretch]
    stretch = LONG_RUN.sub(lambda m: m.group(1) * 3, stretch)
    return [stretch[k:k + LONGEST] for k in range(0, max(1, len(stretch) - LONGEST // 2), LONGEST // 2)]


def forms(words: set[str]) -> set[str]:
    """Words and, marked by a star, their beginnings."""
    return words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) > n}


def tidy(stretches: pa.Array) -> pa.Array:
    """Stretches without characters that are neither letters nor used for letters, and with those in ASCII alone."""
    found = pc.replace_substring_regex(stretches, f"[^\\pL{re.escape(''.join(LEET))}]+", "")
    for c, same in STAND_INS.items():
        found = pc.replace_substring(found, c, same)
    return found


def writings(form: str) -> str:
    """A pattern that a tidy stretch meets if its lattice has a reading with this form in it.

    Each letter is written as itself or as a character used for it; after it may come repeats of it, which may be merged, and
    characters used for letters, which may be dropped.
    """
    signs = re.escape("".join(c for c in LEET if c not in STAND_INS))
    return "".join(f"[{letter}{re.escape(''.join(c for c, used in LEET.items() if letter in used and c not in STAND_INS))}][{letter}{signs}]*"
                   for letter in form)


class Reader:
    """Words of texts, as written and as restored."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.known: dict[str, set[str]] = {}

    def words(self, token: str) -> set[str]:
        """Words of a lower-case text without separators."""
        got = self.known.get(token)
        if got is None:
            got = set(PLAIN.findall(token))
            core = SIGN_RUN.sub("", token.rstrip(ENDS + "!")).strip(ENDS + SIGNS)
            if got and (not core.isalpha() or DOUBLE.search(core)):
                got.update(*(restore(w, self.model).split() for w in windows(core)))
            if len(token) <= LONGEST:
                if len(self.known) >= TOKENS_KEPT:
                    self.known.clear()
                self.known[token] = got
        return got

    def words_apart(self, run: str) -> set[str]:
        """Words of characters that stood alone, one after the other."""
        return set().union(*(restore(w, self.model, apart=True).split() for w in windows(run)))

    def words_of(self, column: pa.Array, scorer: Scorer | None = None) -> list[set[str]]:
        """The words of each text of a lower-case column; for a scorer, only those of stretches that may matter to it."""
        tokens = pc.ascii_split_whitespace(column)
        bounds = np.asarray(tokens.offsets, np.int64)
        coded = tokens.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        kinds, index, bounds = coded.dictionary, np.asarray(coded.indices, np.int64), bounds - bounds[0]
        out: list[set[str]] = [set() for _ in range(len(column))]
        telling = np.ones(len(kinds), bool) if scorer is None else scorer.may_matter(kinds)
        words = {k: self.words(kinds[k].as_py()) for k in np.flatnonzero(telling).tolist()}
        some = np.flatnonzero(telling[index])
        row = np.searchsorted(bounds, some, "right") - 1
        for pair in np.unique(row * max(1, len(kinds)) + index[some]).tolist():
            out[pair // len(kinds)] |= words[pair % len(kinds)]
        # Characters that stand alone, several in a row.
        alone = np.asarray(pc.and_(pc.equal(pc.utf8_length(kinds), 1), pc.or_(pc.utf8_is_alpha(kinds), pc.is_in(kinds, value_set=pa.array(list(LEET))))))
        at = np.flatnonzero(alone[index])
        row = np.searchsorted(bounds, at, "right") - 1
        first = np.flatnonzero(np.r_[True, (np.diff(at) > 1) | (np.diff(row) > 0)]) if len(at) else at
        size = np.diff(np.r_[first, len(at)])
        runs = [(int(row[a]), "".join(kinds.take(pa.array(index[at[a:a + n]])).to_pylist()))
                for a, n in zip(first[size >= SET_APART].tolist(), size[size >= SET_APART].tolist())]
        runs = [(k, run) for k, run in runs if sum(map(str.isalpha, run)) >= 2]
        telling = np.ones(len(runs), bool) if scorer is None else scorer.may_hold(pa.array([run for _, run in runs], pa.string()))
        for (k, run), told in zip(runs, telling.tolist()):
            if told:
                out[k] |= self.words_apart(run)
        return out


@dataclass
class Model:
    language: LanguageModel
    forms: list[str]
    weights: np.ndarray
    bias: float


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column.cast(pa.string()), ""))


def _sample_forms(language: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(language)
        for batch in steps(batches, 0):
            found = pa.array([sorted(forms(words)) for words in reader.words_of(lowered(batch.column(0)))], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(1), found], ["label", "forms"])

    return run


def _restrict(chosen: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            size = np.diff(np.asarray(lists.offsets))
            at = pc.index_in(lists.flatten(), value_set=pa.array(chosen, pa.string()))
            keep = np.asarray(at.is_valid())
            ends = np.concatenate([[0], np.cumsum(np.bincount(np.repeat(np.arange(len(size)), size)[keep], minlength=len(size)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), at.drop_null())], ["label", "features"])

    return run


def fit_logistic(rows: np.ndarray, columns: np.ndarray, labels: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Weights of at least zero under an L1 penalty that asks each feature to explain LEAST_DOCS documents; and the bias.

    Accelerated proximal gradient steps. The penalty picks the few features common to toxic documents and leaves out those
    that merely go along with them in one group of copies.
    """
    n = len(labels)
    w, bias = np.zeros(width), np.log((labels.sum() + 1) / (n - labels.sum() + 1))
    v, v_bias, pace = w.copy(), bias, 1.0
    most = np.bincount(rows, minlength=n).max(initial=0) + 1
    step = 4.0 / most
    for _ in range(ITERATIONS):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, v[columns], n) + v_bias, -30, 30)))
        miss = p - labels
        per = np.maximum(np.bincount(columns, minlength=width), 1)
        # Steps per feature are scaled by how many documents have it.
        new = np.maximum(0, v - step * (np.bincount(columns, miss[rows], width) + LEAST_DOCS) / per)
        new_bias = v_bias - step * miss.mean()
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        v, v_bias = new + (pace - 1) / faster * (new - w), new_bias + (pace - 1) / faster * (new_bias - bias)
        w, bias, pace = new, new_bias, faster
    return w, float(bias)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on about ``sample_rows`` of ``labels`` (id, 0/1), by hash of the id; the language model counts all texts.

    Null ids and labels teach nothing; an id with several labels counts as toxic if any says so. Without labelled documents of
    both kinds nothing is learnt, and every text scores next to 0.
    """
    grams = settle(count_ngrams(docs, text_col), "ngrams").toArrow()  # at most ALPHABET^ORDER rows
    language = LanguageModel(np.asarray(grams["gram"], np.int64), np.asarray(grams["n"], np.int64))
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).na.drop()
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    sample = known.where(unit_hash(F.col("id"), 11) < sample_rows / max(1, known.count()))
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(sample), "id").select("text", "label")  # sample_rows narrow rows
    seen = settle(rows.mapInArrow(_sample_forms(language), "label int, forms array<string>"), "sample-forms")
    if seen.select("label").distinct().count() < 2:
        return Model(language, [], np.zeros(0), float(np.log(1e-6)))
    counts = seen.select("label", F.explode("forms").alias("form")).groupBy("form").agg(F.count("*").alias("n"), F.sum("label").alias("t"))
    chosen = counts.where((F.col("t") >= LEAST_DOCS) & (2 * F.col("t") > F.col("n"))).orderBy(F.desc(F.col("t") * F.col("t") / F.col("n")), "form").limit(SELECTED)
    chosen = sorted(r.form for r in chosen.select("form").collect())
    table = seen.mapInArrow(_restrict(chosen), "label int, features array<int>").toArrow()  # sample_rows short rows
    lists = table["features"].combine_chunks()
    size = np.diff(np.asarray(lists.offsets))
    weights, bias = fit_logistic(np.repeat(np.arange(len(size)), size), np.asarray(lists.flatten(), np.int64),
                                 np.asarray(table["label"], np.float64), len(chosen))
    used = np.flatnonzero(weights > 1e-6)
    return Model(language, [chosen[k] for k in used], weights[used], bias)


class Scorer:
    """Scores text columns; reads only stretches in which a form of the model may be written."""

    def __init__(self, model: Model):
        self.reader, self.bias = Reader(model.language), model.bias
        self.weight = dict(zip(model.forms, model.weights.tolist()))
        self.whole = pa.array([f for f in model.forms if not f.endswith("*")], pa.string())
        self.begun = {n: pa.array([f[:-1] for f in model.forms if f.endswith("*") and len(f) == n + 1], pa.string()) for n in BEGINNINGS}
        patterns = [writings(f) for f in sorted({f.rstrip("*") for f in model.forms})]
        self.patterns = ["|".join(patterns[k:k + PATTERN_FORMS]) for k in range(0, len(patterns), PATTERN_FORMS)]

    def may_hold(self, stretches: pa.Array) -> np.ndarray:
        """Which stretches some form of the model may be written in."""
        held, tidied = np.zeros(len(stretches), bool), tidy(stretches)
        for pattern in self.patterns:
            held |= np.asarray(pc.match_substring_regex(tidied, pattern))
        return held

    def may_matter(self, tokens: pa.Array) -> np.ndarray:
        """Which tokens some form of the model may be a reading of. One with nothing to restore has itself as its only reading."""
        core = pc.utf8_trim(pc.utf8_rtrim(tokens, characters=ENDS + "!"), characters=ENDS + SIGNS)
        plain = np.asarray(pc.and_not(pc.match_substring_regex(core, PLAIN_WORD), pc.match_substring_regex(core, DOUBLES)))
        held = np.asarray(pc.is_in(core, value_set=self.whole)).copy()
        for n, begun in self.begun.items():
            held |= np.asarray(pc.is_in(pc.utf8_slice_codeunits(core, 0, n), value_set=begun))
        odd = np.flatnonzero(~plain)
        held[odd] = self.may_hold(tokens.take(pa.array(odd)))
        return held

    def of_words(self, words: set[str]) -> float:
        found = sorted(self.weight.keys() & forms(words))
        return 1 / (1 + np.exp(-self.bias - sum(self.weight[f] for f in found)))

    def scores(self, column: pa.Array) -> pa.Array:
        return pa.array([self.of_words(words) for words in self.reader.words_of(lowered(column), self)], pa.float64())


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in steps(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), scorer.scores(batch.column(1))], ["id", "score"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row: the probability that its label is toxic. One pass, no shuffle.

    Null texts are empty; an empty text gets the score of a text without any telling word. Repeated rows each return.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(_scores(model), f"id {id_type(docs, id_col)}, score double")


def reject(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, all columns kept; decided where the row is."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, scorer = schema.fieldNames().index(text_col), Scorer(model)
        for batch in steps(batches, at):
            yield batch.filter(pc.less(scorer.scores(batch.column(at)), threshold))

    return small_batches(docs).mapInArrow(run, schema)

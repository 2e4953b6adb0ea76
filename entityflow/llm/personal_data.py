"""Personal data: base patterns, and further spans that boosted trees select from high-recall candidates.

Generators propose overlapping spans of four kinds. A candidate is described by a few small whole numbers of its format and
context, never by the check that its kind has (digits, Luhn sum, part sizes); whether it passes that check is its label.
So all candidates of a table fit in one count per combination of features, whose number is bounded by the product of
their sizes, and the trees are boosted on these counts, hence on all rows. Probabilities are calibrated on a held-out fold,
and each kind gets the lowest threshold that is precise enough there. Everything runs as SQL functions.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityflow.session import settle

KINDS = ("email", "ip", "card", "phone")
CHUNK = 256

# The base patterns, written so that a run that can't match is given up at once: possessive where nothing may be given back,
# and starting only where the leftmost match can start (at a run's start, or where the last match ended).
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CANDIDATES = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?(?:@|[(\[]at[)\]]) ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:[.,][0-9]++){3}+",
    "card": r"[0-9](?:[ ./-]?[0-9])++",
    "phone": r"\+?\(?[0-9](?:[ ().-]{0,2}[0-9])++",
}
# What a text must hold for a pattern to match at all; cheap to test.
BASE_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){13}", "phone": r"\+[0-9]"}
NEEDS = {"email": r"@|[(\[]at[)\]]", "ip": r"[0-9][.,][0-9]", "card": r"[0-9][0-9 ./-]{12}", "phone": r"[0-9][0-9 ().-]{7}"}
CUES = {"email": "mail|contact|write", "ip": "ip|host|server|addr", "card": "card|visa|pay|account", "phone": "phone|call|tel|mobile|fax"}

# Features and how many values each can take.
FEATURES = {"kind": 4, "digits": 21, "separator": 6, "plus": 2, "before": 4, "after": 4, "cue": 2, "groups": 8, "varied": 2, "words": 4}
FOLDS = 4
ROUNDS = 40
RATE = 0.3
PRECISION = 0.98
CONTEXT = 24  # characters before a candidate that may hold a cue


def starts(steps: Column) -> Column:
    """Running sums before each element, in chunks, so that long arrays don't cost their square."""
    chunks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(steps) / CHUNK).cast("int") - 1)), lambda c: F.slice(steps, c * CHUNK + 1, F.lit(CHUNK)))

    def running(array, base):
        zero = F.struct(base.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(array, zero, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    sums = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x))
    return F.flatten(F.zip_with(chunks, running(sums, F.lit(0)), running))


def find(text: Column, pattern: str, needs: str) -> Column:
    """array<struct<start, end, value>> of the pattern's matches, in code points, from left to right."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), F.lit(1), F.size(found))
    first = F.zip_with(starts(F.zip_with(gaps, found, lambda g, m: g + F.length(m))), gaps, lambda s, g: s + g)
    spans = F.zip_with(first, found, lambda s, m: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("value")))
    return F.when(text.rlike(needs), spans).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn sum."""
    def add(acc, i):
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return acc + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """The check of a kind."""
    n = F.length(digits(value))
    if kind == "ip":
        parts = F.transform(F.split(value, "[.,]"), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.when(F.length(p) <= 3, p).cast("int") <= 255))
    if kind == "card":
        return F.when(n.between(14, 19), luhn(digits(value))).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end>> of all base matches that pass their check, by start and kind."""
    found = []
    for k, kind in enumerate(KINDS):
        found.append(F.transform(_passing(kind, find(text, BASE[kind], BASE_NEEDS[kind])), _span(k)))
    return F.array_sort(F.concat(*found))


def _passing(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda s: valid(kind, s["value"]))


def _span(k: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end"))


def sign_class(sign: Column) -> Column:
    """0 for the edge of the text, 1 space, 2 letter or digit, 3 other."""
    return F.when(F.length(sign) == 0, 0).when(sign.rlike(r"^\s"), 1).when(sign.rlike(r"^[\p{L}\p{N}]"), 2).otherwise(3)


def describe(text: Column, kind: str, span: Column) -> Column:
    """struct(start, end, label, features) of a candidate."""
    value = span["value"]
    number = digits(value)
    has = [value.contains(s) for s in (" ", "-", ".", "(")]
    several = sum((h.cast("int") for h in has[1:]), has[0].cast("int"))
    separator = F.when(several > 1, 5).when(has[0], 1).when(has[1], 2).when(has[2], 3).when(has[3], 4).otherwise(0)
    left = F.substring(text, F.greatest(F.lit(1), span["start"] - CONTEXT + 1), F.least(F.lit(CONTEXT), span["start"]))
    values = {
        "kind": F.lit(KINDS.index(kind)),
        "digits": F.least(F.length(number), F.lit(20)),
        "separator": separator,
        "plus": value.startswith("+").cast("int"),
        "before": sign_class(F.substring(text, span["start"], F.when(span["start"] > 0, 1).otherwise(0))),
        "after": sign_class(F.substring(text, span["end"] + 1, F.lit(1))),
        "cue": F.lower(left).rlike(CUES[kind]).cast("int"),
        "groups": F.least(F.size(F.split(value, r"[^0-9]+")), F.lit(7)),
        "varied": (F.size(F.array_distinct(F.split(number, ""))) > 2).cast("int"),
        "words": F.least(F.size(F.split(value, r"[^\p{L}]+")), F.lit(3)) if kind == "email" else F.lit(0),
    }
    if kind == "email":
        label = ~value.rlike(r"[ (\[]") & value.rlike(r"[A-Za-z0-9]@") & value.rlike(r"\.[A-Za-z]{2,}$")
    elif kind == "phone":
        label = valid(kind, value) & value.startswith("+")
    else:
        label = valid(kind, value)
    return F.struct(span["start"].alias("start"), span["end"].alias("end"), label.cast("int").alias("label"), F.struct(*[values[f].cast("int").alias(f) for f in FEATURES]).alias("f"))


def candidates(text: Column) -> Column:
    """All candidates of a text. Digit runs far too short or long for their kind are none."""
    found = []
    for kind in KINDS:
        spans = find(text, CANDIDATES[kind], NEEDS[kind])
        low, high = {"email": (0, 1 << 30), "ip": (4, 15), "card": (13, 19), "phone": (9, 15)}[kind]
        spans = F.filter(spans, lambda s: F.length(digits(s["value"])).between(low, high))  # noqa: B023
        found.append(F.transform(spans, lambda s: describe(text, kind, s)))  # noqa: B023
    return F.concat(*found)


@dataclass
class Model:
    trees: list = field(default_factory=list)  # (feature, limit, tree or value, tree or value): below or at the limit goes left
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    thresholds: tuple = (2.0,) * len(KINDS)

    def probability(self, f: Column) -> Column:
        def value(node):
            if not isinstance(node, tuple):
                return F.lit(float(node))
            name, limit, low, high = node
            return F.when(f[name] <= limit, value(low)).otherwise(value(high))

        z = F.lit(self.bias)
        for tree in self.trees:
            z = z + value(tree)
        return 1 / (1 + F.exp(-(self.slope * z + self.shift)))


def boost(x: np.ndarray, good: np.ndarray, total: np.ndarray) -> tuple[list, float]:
    """Two-level trees on counts: row i stands for ``total[i]`` candidates of which ``good[i]`` pass."""
    share = (good.sum() + 0.5) / (total.sum() + 1)
    bias = log(share / (1 - share))
    z, trees = np.full(len(x), bias), []
    names = list(FEATURES)

    def leaf(mask, g, h):
        return float(RATE * g[mask].sum() / (h[mask].sum() + 1))

    def split(mask, g, h, depth):
        best = (1e-6, None)
        for j, name in enumerate(names):
            by = [np.bincount(x[mask, j], v[mask], FEATURES[name]).cumsum() for v in (g, h)]
            gl, hl, gt, ht = by[0][:-1], by[1][:-1], by[0][-1], by[1][-1]
            gain = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
            k = int(gain.argmax()) if len(gain) else 0
            if len(gain) and gain[k] > best[0]:
                best = (gain[k], (j, k))
        if best[1] is None:
            return leaf(mask, g, h), None
        j, k = best[1]
        low, high = mask & (x[:, j] <= k), mask & (x[:, j] > k)
        if depth == 1:
            return (names[j], k, leaf(low, g, h), leaf(high, g, h)), None
        return (names[j], k, split(low, g, h, 1)[0], split(high, g, h, 1)[0]), None

    def apply(node, mask, out):
        if not isinstance(node, tuple):
            out[mask] = node
            return out
        j = names.index(node[0])
        apply(node[2], mask & (x[:, j] <= node[1]), out)
        return apply(node[3], mask & (x[:, j] > node[1]), out)

    everything = np.ones(len(x), bool)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-z))
        tree, _ = split(everything, good - total * p, total * p * (1 - p), 2)
        trees.append(tree)
        z = z + apply(tree, everything, np.zeros(len(x)))
    return trees, bias


def calibrate(z: np.ndarray, good: np.ndarray, total: np.ndarray) -> tuple[float, float]:
    """Slope and shift of least log loss on held-out counts, by Newton steps with a weak pull to 1 and 0."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g, h = good - total * p, total * p * (1 - p)
        ga, gb = (g * z).sum() - (a - 1), g.sum() - b
        haa, hab, hbb = (h * z * z).sum() + 1, (h * z).sum(), h.sum() + 1
        det = haa * hbb - hab * hab
        step_a, step_b = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(step_a) / 2, abs(step_b) / 2)
        a, b = a + step_a / size, b + step_b / size
    return a, b


def train(described: DataFrame, precision: float = PRECISION) -> Model:
    """Boost on the counts of all candidates of (fold, cands); the last fold calibrates and sets the thresholds."""
    one = described.select("fold", F.explode("cands").alias("c")).select("fold", "c.label", "c.f.*")
    counts = one.groupBy("fold", *FEATURES).agg(F.count("*").alias("n"), F.sum("label").alias("good")).collect()  # bounded by the features' sizes
    if not counts:
        return Model()
    x = np.array([[r[f] for f in FEATURES] for r in counts], np.int64)
    x = np.clip(x, 0, np.array(list(FEATURES.values())) - 1)
    good, total, fold = (np.array([float(r[c]) for r in counts]) for c in ("good", "n", "fold"))
    fit, held = fold < FOLDS - 1, fold == FOLDS - 1
    if not fit.any() or not held.any():
        return Model()
    trees, bias = boost(x[fit], good[fit], total[fit])
    model = Model(trees, bias)
    names = list(FEATURES)

    def value(node, row):
        while isinstance(node, tuple):
            node = node[2] if row[names.index(node[0])] <= node[1] else node[3]
        return node

    z = np.array([bias + sum(value(t, row) for t in trees) for row in x[held]])
    model.slope, model.shift = calibrate(z, good[held], total[held])
    p = 1 / (1 + np.exp(-(model.slope * z + model.shift)))
    limits = []
    for k in range(len(KINDS)):
        mine = np.flatnonzero(x[held][:, 0] == k)
        mine = mine[np.argsort(-p[mine], kind="stable")]
        right, of = good[held][mine].cumsum(), total[held][mine].cumsum()
        last = np.append(np.diff(p[mine]) != 0, True) if len(mine) else np.zeros(0, bool)
        enough = np.flatnonzero(last & ((right + 0.5) / (of + 1) >= precision))
        limits.append(float(p[mine][enough[-1]]) - 1e-9 if len(enough) else 2.0)
    model.thresholds = tuple(limits)
    return model


def join_spans(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def select(base: Column, cands: Column, model: Model) -> Column:
    """Base spans and the selected candidates that overlap none of them; of overlapping candidates the likeliest, then the first."""
    limits = F.array(*[F.lit(t) for t in model.thresholds])
    scored = F.transform(cands, lambda c: F.struct(c["start"].alias("start"), c["f"]["kind"].alias("kind"), c["end"].alias("end"), model.probability(c["f"]).alias("p")))
    chosen = F.filter(scored, lambda c: (c["p"] >= F.element_at(limits, c["kind"] + 1)) & ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))

    def beaten(c):
        rank = lambda s: F.struct(-s["p"], s["start"], s["kind"])
        return F.exists(chosen, lambda d: (d["start"] < c["end"]) & (c["start"] < d["end"]) & (rank(d) < rank(c)))

    more = F.transform(F.filter(chosen, lambda c: ~beaten(c)), lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    return F.array_sort(F.concat(base, more))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = PRECISION) -> DataFrame:
    """(id, base, spans) of every row: arrays of (start, kind, end) in code points, end exclusive; kind by place in KINDS.

    Null texts are empty. Repeated rows each return. The texts are read once; what was found is written, and both the
    training and the selection read that. Folds go by hash of the text, so copies share a fold.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    found = settle(rows.select("id", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"), base_spans(F.col("text")).alias("base"),
                               candidates(F.col("text")).alias("cands")), "candidates")
    model = train(found.where(F.size("cands") > 0), precision)
    return found.select("id", "base", F.when(F.size("cands") > 0, select(F.col("base"), F.col("cands"), model)).otherwise(F.col("base")).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span, from the last to the first, replaced by its kind in angle brackets."""
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    start = F.struct(text.alias("text"), F.length(text).alias("limit"))

    def cut(acc, s):
        rest = F.substring(acc["text"], F.least(s["end"], acc["limit"]) + 1, F.length(acc["text"]))
        return F.struct(F.concat(F.substring(acc["text"], F.lit(1), s["start"]), F.element_at(names, s["kind"] + 1), rest).alias("text"), s["start"].alias("limit"))

    return F.aggregate(F.reverse(spans), start, cut, lambda acc: acc["text"])

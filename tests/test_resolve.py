import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from entityflow.functions.names import normalize_name, tight_name
from entityflow.operators import resolve as R
from entityflow.operators.best_match import Scorer, SeedBlock
from entityflow.operators.similarity import lcs_length, weighted_ratio

# Names, canonical name, score (of the best seed when unmatched), matched.
GOLDEN = [
    ("OpenAI, Inc.", "OpenAI", 100.0, True), ("Open AI", "OpenAI", 100.0, True), ("OPENAI", "OpenAI", 100.0, True),
    ("X.AI", "xAI", 100.0, True), ("Mistral", "Mistral AI", 95.0, True), ("Perplexity", "Perplexity AI", 95.0, True),
    ("AI Meta", "Meta AI", 95.0, True), ("Midjourney UK", "Midjourney", 95.0, True), ("Hugging Face S.A.", "Hugging Face", 95.0, True),
    ("Meta", "Meta", 90.0, False), ("DeepMind", "DeepMind", 90.0, False), ("Cohere Health", "Cohere Health", 90.0, False),
    ("Cohere AI", "Cohere AI", 90.0, False), (" Runway ML ", "Runway ML", 90.0, False), ("Scale AI", "Scale AI", 85.5, False),
    ("Anthropics", "Anthropics", 94.7, False), ("Anthropc", "Anthropc", 94.1, False), ("", "", 0.0, False), ("Inc.", "Inc.", 0.0, False),
]


def table(spark, names, column="raw_name"):
    return spark.createDataFrame([(n,) for n in names], f"{column} string")


def test_weighted_ratio_facts():
    assert weighted_ratio("openai inc", "openai") == pytest.approx(90.0)
    assert weighted_ratio("cohere health", "cohere") == pytest.approx(90.0)
    assert weighted_ratio("scale ai", "stability ai") == pytest.approx(85.5)
    assert weighted_ratio("", "x") == 0.0


@pytest.mark.parametrize("small", [100, 0])
def test_golden_cascade(spark, small):
    rows = R.resolve(table(spark, [g[0] for g in GOLDEN]), scores=True, small=small).collect()
    got = {r["raw_name"]: (r["canonical_name"], round(r["match_score"], 1), r["matched_seed"]) for r in rows}
    assert got == {g[0]: g[1:] for g in GOLDEN}


def pairwise(spark, raw_names, seeds, threshold=95.0):
    """Every name scored against every seed, no blocking: raw name -> canonical name."""
    texts = sorted({*raw_names, *seeds})
    rows = table(spark, texts, "t").select("t", normalize_name("t"), tight_name("t")).collect()
    norm, tight = {r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}
    out = {}
    for raw in raw_names:
        exact = [s for s in seeds if norm[s] == norm[raw]] or [s for s in seeds if tight[s] == tight[raw]]
        if exact:
            out[raw] = exact[-1]
            continue
        scores = [weighted_ratio(norm[raw], norm[s]) for s in seeds]
        form = norm[seeds[scores.index(max(scores))]]
        a, b = sorted([len(norm[raw]), len(form)])
        accepted = max(scores) >= threshold and b > 0 and a / b >= 0.6
        out[raw] = [s for s in seeds if norm[s] == form][-1] if accepted else raw.strip()
    return out


def random_names(rng, seeds, count):
    out = []
    for _ in range(count):
        name = list(rng.choice(seeds))
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(name) + 1)
            kind = rng.random()
            if kind < 0.35 and name:
                name.pop(min(at, len(name) - 1))
            elif kind < 0.7:
                name.insert(at, rng.choice("abcxyz "))
            elif kind < 0.85:
                name += list(rng.choice([" ai", " labs", " inc", " uk", " s.a."]))
            else:
                words = "".join(name).split()
                rng.shuffle(words)
                name = list(" ".join(words))
        out.append("".join(name))
    return sorted(set(out))


LONG_SEEDS = [
    "International Machine Learning Research Laboratories", "Advanced Robotics and Autonomous Systems Group",
    "Northern Light Language Model Company of Toronto", "Deep Blue Analytics", "Deep Blue Analytics Ltd", "Blue Deep Analytics",
    "Quantum", "Inc.", "AI", "Zed AI", "Zed  A.I.",
]


@pytest.mark.parametrize("small", [100, 0])
@pytest.mark.parametrize("seeds", [R.SEED_NAMES, LONG_SEEDS], ids=["default", "long"])
def test_cascade_equals_pairwise_scoring(spark, seeds, small):
    names = random_names(random.Random(7), seeds, 400)
    want = pairwise(spark, names, seeds)
    rows = R.resolve(table(spark, names), R.seed_table(spark, seeds), small=small).collect()
    got = {r["raw_name"]: r["canonical_name"] for r in rows}
    assert {n: (got[n], want[n]) for n in names if got[n] != want[n]} == {}


def test_other_threshold(spark):
    names = random_names(random.Random(3), R.SEED_NAMES, 150) + ["Meta", "DeepMind", "Scale AI"]
    want = pairwise(spark, names, R.SEED_NAMES, 85.0)
    got = {r["raw_name"]: r["canonical_name"] for r in R.resolve(table(spark, names), threshold=85.0).collect()}
    assert got == want


def test_scorer_slices_agree(spark):
    norms = table(spark, ["scale ai", "cohere health", "open", ""], "norm")
    seeds = R.seed_table(spark)
    whole = {(r["norm"], r["form"], r["score"]) for r in R.best_scores(norms, seeds).collect()}
    sliced = {(r["norm"], r["form"], r["score"]) for r in R.best_scores(norms, seeds, slice_size=4).collect()}
    assert whole == sliced


def test_upper_bounds_hold_and_spare_pairs():
    """No score is above its bound, the best is that of scoring all pairs, and few pairs are scored."""
    rng = random.Random(5)
    syllables = ["al", "ba", "co", "den", "er", "fo", "gra", "hil", "in", "jo", "ka", "lu", "mer", "no", "ou", "pi", "qua", "ro", "st", "tu"]
    def word():
        return "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    forms = sorted({" ".join(word() for _ in range(rng.randint(1, 3))) for _ in range(1500)}) + ["x x", "é ß", "a"]
    rng.shuffle(forms)
    names = [*rng.sample(forms, 40), *(f[:-1] + "z" for f in rng.sample(forms, 40)), *(" ".join(word() for _ in range(2)) for _ in range(40)), "", "q", "x", "x x x"]
    block = SeedBlock(forms, list(range(len(forms))), forms)
    for name in names:
        scores = [weighted_ratio(name, f) for f in forms]
        assert (np.array(scores) <= block.bounds(name) + 1e-12).all()
        assert block.best(name) == (max(scores), scores.index(max(scores)))
        assert block.best(name, 101.0) is None
    assert block.scored < 0.2 * 2 * len(names) * len(forms)


def test_many_seeds_in_blocks(spark):
    rng = random.Random(6)
    seeds = random_names(rng, R.SEED_NAMES, 300)
    norms = sorted({n.lower() for n in random_names(rng, R.SEED_NAMES, 80)} | {""})
    table_ = R.seed_table(spark, seeds)
    forms = [(r["form"], r["seed_order"]) for r in R.seeds_by_norm(table_).collect()]
    got = {r["norm"]: (r["form"], r["score"]) for r in R.best_scores(table(spark, norms, "norm").repartition(3), table_, slice_size=37).collect()}
    for norm in norms:
        score, _, form = max((weighted_ratio(norm, f), -o, f) for f, o in forms)
        assert got[norm] == (form, score)
    assert len(got) == len(norms)


def test_no_seeds_give_no_scores(spark):
    none = R.seed_table(spark).limit(0)
    assert R.best_scores(table(spark, ["a"], "norm"), none).count() == 0
    rows = R.resolve(table(spark, ["Open AI"]), none, scores=True).collect()
    assert [(r["canonical_name"], r["match_score"], r["matched_seed"]) for r in rows] == [("Open AI", None, False)]


def test_native_lcs(spark):
    from entityflow.operators.similarity import _lcs

    rng = random.Random(1)
    pairs = [("".join(rng.choices("abcd ", k=rng.randint(1, 12))), "".join(rng.choices("abcd ", k=rng.randint(1, 12)))) for _ in range(60)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", lcs_length(F.col("a"), F.col("b")).alias("n")).collect():
        assert r["n"] == _lcs(r["a"], r["b"])


def test_no_cross_join(spark, capsys):
    for small in (100, 0):
        R.resolve(table(spark, ["a", "b"]), small=small).explain()
    out = capsys.readouterr().out
    assert "Cartesian" not in out and "NestedLoop" not in out


def test_later_spelling_wins_and_empty_list_means_default(spark):
    seeds = R.seed_table(spark, ["Acme Inc", "Other", "ACME"])
    for small in (100, 0):
        got = {r["raw_name"]: r["canonical_name"] for r in R.resolve(table(spark, ["acme", "a c m e"]), seeds, small=small).collect()}
        assert got == {"acme": "ACME", "a c m e": "ACME"}
    assert R.seed_table(spark, []).count() == 15


def test_log_and_mapping_keep_every_occurrence(spark):
    uses = R.occurrences({
        "STARTUP": (table(spark, ["Open AI", "Zed"], "n"), "n", None),
        "JOB": (table(spark, ["Open AI", " Zed "], "n"), "n", None),
    })
    resolved = R.resolve(uses)
    log = R.mapping_log(uses, resolved).collect()
    assert sorted((r["record_type"], r["raw_name"], r["canonical_name"], r["matched_seed"]) for r in log) == [
        ("JOB", " Zed ", "Zed", False), ("JOB", "Open AI", "OpenAI", True),
        ("STARTUP", "Open AI", "OpenAI", True), ("STARTUP", "Zed", "Zed", False),
    ]
    nested = table(spark, ["Open AI", " Zed "], "n").select(F.struct(F.col("n").alias("company"), F.lit(1).alias("x")).alias("content"))
    mapped = R.apply_mapping(nested, resolved, "content.company").select("content.company", "content.x").collect()
    assert sorted(tuple(r) for r in mapped) == [("OpenAI", 1), ("Zed", 1)]
    assert {r["raw_name"]: r["canonical_name"] for r in R.resolve_batch(uses).collect()}["Open AI"] == "OpenAI"


def test_seeds_alike_to_a_name_are_scored_once():
    """Bounds can't part seeds that differ in characters the name lacks: their one score is computed once, and is theirs."""
    rng = random.Random(9)
    forms = [f"customer{k:09d}" for k in range(500)] + [f"labs {k:03d} co" for k in range(200)] + ["x x", "zz zz a", "b zz a", "open ai labs", "labs", ""]
    rng.shuffle(forms)
    names = ["openai", "scale ai", "co labs", "labs", "x", "a zz", "zz", "", "0 labs", "customer 1", "\x00 a"]
    block = SeedBlock(forms, list(range(len(forms))), forms)
    for name in names:
        scorer, scores = Scorer(name), [weighted_ratio(name, f) for f in forms]
        assert [scorer.score(f)[0] for f in forms] == scores
        assert block.best(name) == (max(scores), scores.index(max(scores)))
    before = block.scored
    block.best("openai")
    assert block.scored - before < 20

"""Entity resolution: raw company names to canonical names, with a full mapping log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from entityflow.functions.names import normalize_name, squeeze, token_set
from entityflow.functions.text import strip
from entityflow.operators.best_match import best_of_seeds
from entityflow.operators.similarity import lcs_length
from entityflow.session import settle

# Fixed value: the default canonical names, in rank order.
SEED_NAMES = [
    "OpenAI", "Anthropic", "Google DeepMind", "Meta AI", "Mistral AI",
    "Cohere", "Stability AI", "Hugging Face", "xAI", "Perplexity AI",
    "Inflection AI", "Adept", "Runway", "ElevenLabs", "Midjourney",
]
DEFAULT_THRESHOLD = 95.0
MIN_LENGTH_RATIO = 0.6
SCORER_SLICE = 2_000
SMALL_DICTIONARY = 100


def seed_table(spark: SparkSession, seeds: Sequence[str] | None = None) -> DataFrame:
    """(seed_rank, seed); an empty list means the default names."""
    names = list(seeds or SEED_NAMES)
    # An Arrow table becomes a local relation, whose true size decides how it is joined.
    return spark.createDataFrame(pa.table({"seed_rank": pa.array(range(len(names)), pa.int32()), "seed": pa.array(names, pa.string())}))


def _seed_index(seeds: DataFrame, form: Column) -> DataFrame:
    """One row per normal form: the first rank orders it, the last spelling names it."""
    return (
        seeds.withColumn("form", form)
        .groupBy("form")
        .agg(
            F.min("seed_rank").alias("seed_order"),
            F.max("seed_rank").alias("last_rank"),
            F.max_by("seed", "seed_rank").alias("canonical"),
        )
    )


def seeds_by_norm(seeds: DataFrame) -> DataFrame:
    return _seed_index(seeds, normalize_name("seed"))


def seeds_by_tight(seeds: DataFrame) -> DataFrame:
    return _seed_index(seeds, squeeze(normalize_name("seed")))


# --- exact tiers -------------------------------------------------------------------


def lookup_exact(names: DataFrame, seeds: DataFrame) -> DataFrame:
    """Adds ``exact_name``: the seed whose normal form equals ``norm``."""
    table = seeds_by_norm(seeds).select(F.col("form").alias("norm"), F.col("canonical").alias("exact_name"))
    return names.join(table, "norm", "left")


def lookup_tight(names: DataFrame, seeds: DataFrame) -> DataFrame:
    """Adds ``tight_match``: the seed whose blank-free form equals that of ``norm``."""
    table = seeds_by_tight(seeds).select(F.col("form").alias("tight"), F.col("canonical").alias("tight_match"))
    return names.withColumn("tight", squeeze("norm")).join(table, "tight", "left")


# --- fuzzy tier ----------------------------------------------------------------------

# At threshold 95 a weighted ratio is accepted exactly when the lengths differ by
# less than half and either (1) one word set contains the other, which scores 95,
# or (2) the insert/delete distance is at most a twentieth of the joint length.
# Both are reached by equality joins, so no name meets every seed.


def _near_in_length(a: Column, b: Column) -> Column:
    return 2 * F.greatest(a, b) < 3 * F.least(a, b)


def _word_candidates(names: DataFrame, seeds: DataFrame) -> DataFrame:
    """Pairs where one word set contains the other.

    They share the contained side's rarest word, as counted over the seeds,
    so a word common to many seeds brings nobody together unless it is all
    there is. A name with a word no seed has is contained in no seed.
    """
    n = names.withColumn("words", token_set("norm")).withColumn("n", F.length("norm"))
    s = seeds.withColumn("seed_words", token_set("form")).withColumn("m", F.length("form"))
    counts = s.select(F.explode("seed_words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("uses"))

    def rarest(df: DataFrame, key: str, words: str) -> DataFrame:
        by_word = df.select(key, F.explode(words).alias("word")).join(counts, "word", "left")
        best = by_word.groupBy(key).agg(F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "word")).alias("r"))
        return best.filter("r.uses > 0").select(key, F.col("r.word").alias("word"))

    band = _near_in_length(F.col("n"), F.col("m"))
    inside_name = (
        n.withColumn("word", F.explode("words"))
        .join(s.join(rarest(s, "form", "seed_words"), "form"), "word")
        .filter(band & (F.size(F.array_except("seed_words", "words")) == 0))
    )
    inside_seed = (
        n.join(rarest(n, "norm", "words"), "norm")
        .join(s.withColumn("word", F.explode("seed_words")), "word")
        .filter(band & (F.size(F.array_except("words", "seed_words")) == 0))
    )
    pairs = [p.select("norm", "form", "seed_order", "canonical") for p in (inside_name, inside_seed)]
    return pairs[0].unionByName(pairs[1]).withColumn("score", F.lit(95.0))


def _max_edits(total: Column) -> Column:
    return F.floor(total / 20).cast("int")


def _segment_candidates(names: DataFrame, seeds: DataFrame) -> DataFrame:
    """Pairs within the edit limit, found by shared segments.

    A seed of length m allows at most k edits, so of its k + 1 equal segments
    one must occur unchanged in the name, shifted by at most k. Names look up
    their substrings by (seed length, segment number, text); only lengths
    that some seed has are expanded. Short seeds (limit 0) need equality,
    which the exact tier already decided.
    """
    m = F.col("m")
    longest = F.floor(m * 105 / 95).cast("int")  # longest name within the limit of a seed of length m
    edits = _max_edits(longest + m)
    seg_len = F.floor(m / (F.col("k") + 1)).cast("int")
    # Segments 0..k start at i * seg_len; the last one runs to the end.
    def seg_start(i):
        return i * F.col("seg_len") + 1

    def seg_size(i):
        return F.when(i == F.col("k"), F.col("m") - F.col("k") * F.col("seg_len")).otherwise(F.col("seg_len"))

    sized = seeds.withColumn("m", F.length("form")).withColumn("k", edits).filter("k >= 1").withColumn("seg_len", seg_len)
    lengths = sized.select("m", "k", "seg_len").distinct()
    seed_segments = sized.withColumn("seg", F.explode(F.sequence(F.lit(0), F.col("k")))).withColumn(
        "piece", F.substring(F.col("form"), seg_start(F.col("seg")), seg_size(F.col("seg")))
    ).select("m", "seg", "piece", "form", "seed_order", "canonical")

    n = F.length("norm")
    low, high = F.ceil(n * 95 / 105).cast("int"), F.floor(n * 105 / 95).cast("int")
    name_pieces = (
        names.withColumn("n", n)
        .filter("n > 0")
        .withColumn("m", F.explode(F.sequence(low, F.greatest(low, high))))
        .join(lengths, "m")
        .withColumn("seg", F.explode(F.sequence(F.lit(0), F.col("k"))))
        .withColumn("shift", F.explode(F.sequence(-F.col("k"), F.col("k"))))
        .withColumn("at", seg_start(F.col("seg")) + F.col("shift"))
        .filter("at >= 1")
        .withColumn("piece", F.substring(F.col("norm"), F.col("at"), seg_size(F.col("seg"))))
        .select("norm", "n", "m", "seg", "piece")
    )
    pairs = (
        name_pieces.join(seed_segments, ["m", "seg", "piece"])
        .select("norm", "form", "seed_order", "canonical", "n", "m")
        .distinct()
        .filter(F.levenshtein("norm", "form") <= _max_edits(F.col("n") + F.col("m")))
    )
    total = F.col("n") + F.col("m")
    dist = total - 2 * lcs_length(F.col("norm"), F.col("form"))
    return (
        pairs.withColumn("score", (1 - dist / total) * 100)
        .filter(dist * 20 <= total)
        .select("norm", "form", "seed_order", "canonical", "score")
    )


def _best_of(pairs: DataFrame) -> DataFrame:
    """Highest score per name; the earliest seed wins a tie."""
    best = F.max_by(
        F.struct("form", "seed_order", "canonical", "score"), F.struct(F.col("score"), -F.col("seed_order"))
    )
    return pairs.groupBy("norm").agg(best.alias("b")).select("norm", "b.form", "b.seed_order", "b.canonical", "b.score")


def _native_fuzzy(norms: DataFrame, seeds: DataFrame) -> DataFrame:
    return _best_of(_word_candidates(norms, seeds).unionByName(_segment_candidates(norms, seeds)))


def best_scores(norms: DataFrame, seeds: DataFrame, slice_size: int = SCORER_SLICE) -> DataFrame:
    """Best weighted ratio of every distinct ``norm`` over all seeds, whatever its height: (norm, form, seed_order, canonical, score).

    Seeds are visited by falling upper bound, block by block (see ``best_match``); names and seeds are tables, so neither has to fit
    anywhere at once. Without seeds there are no rows.
    """
    indexed = seeds_by_norm(seeds).select("form", "seed_order", "canonical")
    return _best_of(best_of_seeds(norms, indexed, slice_size))


def best_fuzzy(norms: DataFrame, seeds: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Accepted fuzzy match per distinct ``norm``: (norm, canonical, score)."""
    if threshold == DEFAULT_THRESHOLD:
        # The seed forms feed seven small joins; written once, each of them just reads it.
        best = _native_fuzzy(norms, settle(seeds_by_norm(seeds), "seed-forms"))
    else:
        best = best_scores(norms, seeds)
    n, m = F.length("norm"), F.length("form")
    close = F.least(n, m) / F.greatest(n, m, F.lit(1)) >= MIN_LENGTH_RATIO
    return best.filter((F.col("score") >= threshold) & close).select("norm", "canonical", "score")


# --- the cascade ----------------------------------------------------------------------


def _small_dictionary(names: DataFrame, seeds: Sequence[Row]) -> DataFrame:
    """All tiers as one expression over a seed list that fits into the plan: no join, no shuffle.

    Adds exact_name, fuzzy_name, fuzzy_score to (raw_name, norm).
    """
    last_by_tight = {r["form"].replace(" ", ""): r["last_rank"] for r in sorted(seeds, key=lambda r: r["last_rank"])}
    by_rank = {r["last_rank"]: r["canonical"] for r in seeds}
    by_norm = {r["form"]: r["canonical"] for r in seeds}
    by_tight = {tight: by_rank[rank] for tight, rank in last_by_tight.items()}

    def literal_map(pairs: Mapping[str, str]) -> Column:
        return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])

    table = F.array(*[
        F.struct(
            F.lit(r["form"]).alias("form"), F.lit(len(r["form"])).alias("m"), F.lit(r["seed_order"]).alias("seed_order"),
            F.lit(r["canonical"]).alias("canonical"), F.array(*[F.lit(w) for w in _words(r["form"])]).cast("array<string>").alias("words"),
        )
        for r in seeds
    ])
    norm, n, words = F.col("norm"), F.length("norm"), F.col("__words")

    # Most names share no word with any seed and have no seed's length, give or
    # take the edit limit. Two cheap tests settle those.
    vocabulary = sorted({w for r in seeds for w in _words(r["form"])})
    lengths = sorted({
        size for m in {len(r["form"]) for r in seeds} for size in range(m * 2 + 1) if abs(size - m) <= (size + m) // 20
    })
    possible = F.arrays_overlap(words, F.array(*[F.lit(w) for w in vocabulary]).cast("array<string>")) | n.isin(lengths)

    def near_edits(s: Column) -> Column:
        limit = _max_edits(n + s["m"])
        return (F.abs(n - s["m"]) <= limit) & (F.levenshtein(norm, s["form"]) <= limit)

    def contained(s: Column) -> Column:
        return (F.size(F.array_except(s["words"], words)) == 0) | (F.size(F.array_except(words, s["words"])) == 0)

    def scored(s: Column) -> Column:
        total = n + s["m"]
        dist = F.when(near_edits(s), total - 2 * lcs_length(norm, s["form"]))
        near = F.when(dist * 20 <= total, (1 - dist / total) * 100)
        score = F.coalesce(near, F.when(contained(s), 95.0))
        return F.struct(score.alias("score"), (-s["seed_order"]).alias("early"), s["canonical"].alias("canonical"))

    exact = F.coalesce(
        F.try_element_at(literal_map(by_norm), norm), F.try_element_at(literal_map(by_tight), squeeze("norm"))
    )
    close = F.filter(table, lambda s: _near_in_length(n, s["m"]) & (near_edits(s) | contained(s)))
    candidates = F.filter(F.transform(close, scored), lambda c: c["score"].isNotNull())
    tried = names.withColumn("exact_name", exact).withColumn("__words", F.split("norm", " "))
    best = F.when(F.col("exact_name").isNull() & (n > 0) & possible, F.array_max(candidates))
    return (
        tried.withColumn("__best", best)
        .withColumn("fuzzy_name", F.col("__best.canonical"))
        .withColumn("fuzzy_score", F.col("__best.score"))
        .drop("__words", "__best")
    )


def _words(form: str) -> list[str]:
    return sorted(set(form.split()))


def _large_dictionary(names: DataFrame, seeds: DataFrame, threshold: float) -> DataFrame:
    """The same columns through equality joins, for seed lists of any size and other thresholds."""
    tiers = lookup_tight(lookup_exact(names, seeds), seeds)
    # Read by every branch of the fuzzy tier, hence written once.
    tiers = settle(tiers.withColumn("exact_name", F.coalesce("exact_name", "tight_match")), "name-tiers")
    open_norms = tiers.filter(F.col("exact_name").isNull()).select("norm").distinct()
    fuzzy = best_fuzzy(open_norms, seeds, threshold).select(
        "norm", F.col("canonical").alias("fuzzy_name"), F.col("score").alias("fuzzy_score")
    )
    return tiers.join(fuzzy, "norm", "left")


def resolve(
    names: DataFrame,
    seeds: DataFrame | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    raw: str = "raw_name",
    scores: bool = False,
    small: int = SMALL_DICTIONARY,
) -> DataFrame:
    """One row per distinct raw name: raw_name, canonical_name, match_score, matched_seed.

    Tiers: equal normal form (100), equal blank-free form (100), fuzzy match
    (its score), else the stripped raw name, unmatched. An unmatched name's
    score does not affect the result; ``scores=True`` fills it in with one
    Arrow pass over the distinct unmatched normal forms, else it is null.

    Up to ``small`` seeds become part of the expression; longer lists are
    joined. Both give the same result.
    """
    seeds = seed_table(names.sparkSession) if seeds is None else seeds
    distinct = names.select(F.col(raw).alias("raw_name")).filter(F.col("raw_name").isNotNull()).distinct()
    named = distinct.withColumn("norm", normalize_name("raw_name"))
    dictionary = seeds_by_norm(seeds).limit(small + 1).collect() if threshold == DEFAULT_THRESHOLD else []
    if 0 < len(dictionary) <= small:
        joined = _small_dictionary(named, dictionary)
    else:
        joined = _large_dictionary(named, seeds, threshold)
    name = F.coalesce("exact_name", "fuzzy_name")
    other = F.lit(None).cast("double")
    if scores:
        joined = settle(joined, "name-tiers")
        open_norms = joined.filter(name.isNull()).select("norm").distinct()
        reported = best_scores(open_norms, seeds).select("norm", F.col("score").alias("open_score"))
        joined = joined.join(reported, "norm", "left")
        other = F.col("open_score")
    return joined.select(
        "raw_name",
        F.coalesce(name, strip("raw_name")).alias("canonical_name"),
        F.when(F.col("exact_name").isNotNull(), F.lit(100.0)).otherwise(F.coalesce(F.col("fuzzy_score"), other)).alias("match_score"),
        name.isNotNull().alias("matched_seed"),
    )


def resolve_batch(names: DataFrame, seeds: DataFrame | None = None, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Distinct raw name -> canonical name."""
    return resolve(names, seeds, threshold).select("raw_name", "canonical_name")


def occurrences(tables: Mapping[str, tuple[DataFrame, str, str | None]]) -> DataFrame:
    """Every use of a name, in table order: table_rank, record_type, raw_name, and row_id where given.

    ``tables`` maps a record type to (rows, name column, row id column or None).
    """
    parts = []
    for rank, (record_type, (df, name, row_id)) in enumerate(tables.items()):
        ids = [F.col(row_id).alias("row_id")] if row_id else []
        head = [F.lit(rank).alias("table_rank"), F.lit(record_type).alias("record_type")]
        parts.append(df.select(*head, *ids, F.col(name).alias("raw_name")))
    return reduce(DataFrame.unionByName, parts)


def mapping_log(uses: DataFrame, resolved: DataFrame, with_open: bool = False) -> DataFrame:
    """One log row per occurrence.

    Only matched names have to be looked up: an unmatched one maps to its own
    stripped text. That keeps the build side as small as the seeds' spellings.
    ``with_open=True`` joins unmatched names too, for their reported scores.
    """
    side = resolved if with_open else resolved.filter("matched_seed")
    side = side.select("raw_name", F.col("canonical_name").alias("__name"), "match_score", "matched_seed")
    return (
        uses.join(side, "raw_name", "left")
        .withColumn("canonical_name", F.coalesce("__name", strip("raw_name")))
        .withColumn("matched_seed", F.coalesce("matched_seed", F.lit(False)))
        .drop("__name")
    )


def apply_mapping(df: DataFrame, resolved: DataFrame, name: str) -> DataFrame:
    """Overwrite a name column, or a field such as ``content.company``, by its canonical name."""
    side = resolved.filter("matched_seed").select(
        F.col("raw_name").alias("__raw"), F.col("canonical_name").alias("__name")
    )
    joined = df.withColumn("__raw", F.col(name)).join(side, "__raw", "left")
    final = F.coalesce("__name", strip("__raw"))
    top, _, field = name.partition(".")
    value = F.col(top).withField(field, final) if field else final
    return joined.withColumn(top, value).drop("__raw", "__name")

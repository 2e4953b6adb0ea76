"""Mixing sources to target weights: exact block quotas, split over output shards by a hypergeometric tree.

Documents fall into blocks of about BLOCK_DOCS by a hash. A source's target decides how many of its blocks are drawn:
all of them once for each whole multiple of its size, then blocks in order until the rest is nearly filled, and single
documents of the next block for what remains, in the best of FILL_ATTEMPTS hash orders. The draws of all sources are split among the shards by a binary tree: each node
gives its left half a multivariate-hypergeometric share of its quotas, so each shard has its exact number of blocks, in
proportions that a full shuffle would give. A source's draws are permuted, and each shard takes the next ones, so shards
are disjoint. Documents are shuffled inside their shard alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityflow.session import settle

BLOCK_DOCS = 256
SHARD_WORDS = 4_000_000
# Blocks whose running total one window computes; totals of such spans add up in a second window.
SPAN_BLOCKS = 4096
# Hash orders in which the last block's documents are tried.
FILL_ATTEMPTS = 32
# A prime beyond any number of draws of one source, so multiplying by it permutes them.
STRIDE = 2_147_483_647


def word_count(text: Column) -> Column:
    """Number of words between ASCII separators; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """Adds idx and target to (source, source_size, docs), one row per source.

    Weights repeat over the sources in code-point order, null last. Targets are by weight, at most ``cap`` times the
    source's size, and add up to ``share`` of all sizes; what a capped source can't take goes to the others by weight.
    Sources in order of size per weight are capped first, so the level is found from running sums.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("idx") % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("idx", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    rows = rows.withColumn("weight", weight).withColumn("most", cap * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), "idx")
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("level", (F.least(F.sum("most").over(every), share * F.sum("source_size").over(every))
                                     - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                           / F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    # The first source whose share at its level is within its cap fixes the level for all after it.
    fits = F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("most") / F.col("weight"))).over(every)
    level = F.first(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumn("__fits", fits).withColumn("__level", level)
    target = F.when(F.col("__fits").isNull() | (F.col("most") / F.col("weight") < F.col("__fits")), F.col("most")).otherwise(
        F.least(F.col("most"), F.col("__level") * F.col("weight")))
    return rows.withColumn("target", target.cast("double")).select("source", "idx", "source_size", "docs", "target")


def running_sum(rows: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """Adds ``total``: the sum of ``value`` up to and with this row, by whole-number ``order`` in each group.

    Two steps, so a group is cut into spans of SPAN_BLOCKS and no task orders more than a span or the spans' sums.
    """
    span = F.floor(F.col(order) / SPAN_BLOCKS)
    rows = settle(rows.withColumn("span", span), "spans")
    sums = rows.groupBy(group, "span").agg(F.sum(value).alias("s"))
    before = Window.partitionBy(group).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(group, "span", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(group, "span").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(sums, [group, "span"]).withColumn("total", F.col("base") + F.sum(value).over(inside)).drop("span", "base")


def log_factorial(x: Column) -> Column:
    """Stirling's series, six places further on for accuracy, less the logarithm of the factors gone too far."""
    y = x.cast("double") + 7
    factors = (y - 6) * (y - 5) * (y - 4) * (y - 3) * (y - 2) * (y - 1)
    return (y - 0.5) * F.log(y) - y + F.lit(0.5 * math.log(2 * math.pi)) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5))) - F.log(factors)


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """The number of marked ones among ``drawn`` out of ``total``, by inverting the distribution at ``u``.

    The walk covers 12 standard deviations around the mean, beyond which no double-precision ``u`` falls.
    """
    mean = drawn.cast("double") * marked / F.greatest(total, F.lit(1))
    spread = F.sqrt(mean * (1 - marked.cast("double") / F.greatest(total, F.lit(1))))
    low = F.greatest(F.lit(0), drawn - (total - marked), F.floor(mean - 12 * spread - 12)).cast("long")
    high = F.least(marked, drawn, F.ceil(mean + 12 * spread + 12)).cast("long")
    # log of C(marked, low) * C(total - marked, drawn - low) / C(total, drawn), as one signed sum of log factorials.
    terms = [(1, marked), (-1, low), (-1, marked - low), (1, total - marked), (-1, drawn - low), (-1, total - marked - drawn + low),
             (-1, total), (1, drawn), (1, total - drawn)]
    terms = F.array(*[F.struct(F.lit(sign).alias("sign"), x.cast("double").alias("x")) for sign, x in terms])
    start = F.exp(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t["sign"] * log_factorial(t["x"])))

    def step(acc, k):
        p = acc["p"] * (marked - k) * (drawn - k) / ((k + 1) * F.greatest(total - marked - drawn + k + 1, F.lit(1)))
        done = acc["sum"] >= u
        return F.struct(F.when(done, acc["k"]).otherwise(F.least(k + 1, high)).alias("k"), F.when(done, acc["p"]).otherwise(p).alias("p"),
                        F.when(done, acc["sum"]).otherwise(acc["sum"] + p).alias("sum"))

    first = F.struct(low.alias("k"), start.cast("double").alias("p"), start.cast("double").alias("sum"))
    return F.aggregate(F.sequence(low, high), first, step, lambda acc: acc["k"])


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(idx, draws) -> (shard, idx, quota): the splitting tree over all sources, one level at a time."""
    node = quotas.agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "draws"))), lambda x: x["draws"]).alias("quotas"))
    node = node.select(F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("n"), "quotas")
    for level in range(max(0, math.ceil(math.log2(shards)))):
        left_n = F.floor(F.col("n") / 2)
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, x: a + x)
        node = node.withColumn("total", total).withColumn("room", F.floor(F.col("total") * left_n / F.col("n")))

        salt = F.xxhash64(F.lit(seed), F.lit(level), F.col("low"))

        def draw(acc, x):
            u = F.pmod(F.xxhash64(salt, F.size(acc["left"])), F.lit(1 << 52)) / F.lit(float(1 << 52))  # noqa: B023
            got = hypergeometric(acc["total"], x, acc["room"], u)
            return F.struct((acc["total"] - x).alias("total"), (acc["room"] - got).alias("room"), F.concat(acc["left"], F.array(got)).alias("left"))

        start = F.struct(F.col("total").alias("total"), F.col("room").alias("room"), F.array().cast("array<bigint>").alias("left"))
        node = node.withColumn("left", F.aggregate("quotas", start, draw, lambda acc: acc["left"]))
        halves = F.when(F.col("n") == 1, F.array(F.struct("low", "n", "quotas"))).otherwise(F.array(
            F.struct("low", left_n.alias("n"), F.col("left").alias("quotas")),
            F.struct((F.col("low") + left_n).alias("low"), (F.col("n") - left_n).alias("n"),
                     F.zip_with("quotas", "left", lambda a, b: a - b).alias("quotas"))))
        # Written after each level: a plan of all levels would be analyzed whole, again and again.
        node = settle(node.select(F.explode(halves).alias("half")).select("half.*").repartition("low"), "quota-nodes")
    return node.select(F.col("low").alias("shard"), F.posexplode("quotas").alias("idx", "quota"))


def plan_mix(docs: DataFrame, weights: list[float], share: float, cap: float, seed: int = 7, shard_words: int = SHARD_WORDS,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(row, size, source_size, target, shards) for every row; ``row`` is the struct of all columns of ``docs``.

    ``shards`` lists the output shard of each copy that the mix takes; it is empty for a row left out. A row is taken at most
    ceil(target / source_size) times. Null text has size 0. A null source is a source of its own. Rows that agree in id
    and text share their fate. Sources without any word are left out. Same rows and seed, same result.
    """
    docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    at = lambda name: F.col("row").getField(name)
    docs = docs.select("row", at(source_col).alias("source"), word_count(at(text_col)).alias("size"),
                       F.xxhash64(F.lit(seed), at(id_col), at(text_col)).alias("key"))
    sized = settle(docs.select("source", "size", "key"), "sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    sources = settle(targets(sizes, weights, share, cap)
                     .withColumn("blocks", F.ceil(F.col("docs") / BLOCK_DOCS))
                     .withColumn("times", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)))
                     .withColumn("rest", F.when(F.col("source_size") > 0, F.col("target") - F.col("times") * F.col("source_size")).otherwise(-1.0)), "sources")

    def blocked(rows: DataFrame) -> DataFrame:
        narrow = sources.withColumnRenamed("source", "__source")
        return rows.join(narrow, F.col("source").eqNullSafe(F.col("__source"))).withColumn("block", F.pmod("key", "blocks"))

    blocks = blocked(sized).groupBy("idx", "block").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    whole = F.col("total") <= F.col("rest")
    summed = settle(running_sum(blocks, "idx", "block", "words"), "block-sums")
    filled = summed.groupBy("idx").agg(
        F.sum(whole.cast("long")).alias("whole"), F.max("block").alias("last"),
        F.max(F.when(whole, F.col("total")).otherwise(0)).alias("words"), F.first("rest").alias("rest"))
    # Blocks that hold no document are missing among the totals; all before the first unfilled one count as drawn.
    gaps = summed.where(~whole).groupBy("idx").agg(F.min("block").alias("open"))
    filled = settle(filled.join(gaps, "idx", "left").select(
        "idx", F.coalesce("open", F.when(F.col("rest") >= 0, F.col("last") + 1), F.lit(0)).alias("whole"), (F.col("rest") - F.col("words")).alias("rest")), "filled")

    # Single documents of the block after the whole ones, as long as they fit, in the hash order that leaves least.
    cut = blocked(sized).join(filled.select("idx", F.col("whole").alias("block"), F.col("rest").alias("room")), ["idx", "block"]).where("room > 0")
    cut = cut.groupBy("idx", "key").agg(F.sum("size").alias("size"), F.first("room").alias("room"))
    cut = cut.groupBy("idx").agg(F.array_sort(F.collect_list(F.struct("key", "size"))).alias("units"), F.first("room").alias("room"))
    start = F.struct(F.col("room").alias("room"), F.array().cast("array<bigint>").alias("keys"))

    def fill(attempt):
        shuffled = F.array_sort(F.transform("units", lambda x: F.struct(F.xxhash64(attempt, x["key"]).alias("rank"), x["key"].alias("key"), x["size"].alias("size"))))
        return F.aggregate(shuffled, start, lambda acc, x: F.when(x["size"] <= acc["room"], F.struct(
            (acc["room"] - x["size"]).alias("room"), F.concat(acc["keys"], F.array(x["key"])).alias("keys"))).otherwise(acc))

    fit = F.array_min(F.transform(F.sequence(F.lit(1), F.lit(FILL_ATTEMPTS)), fill))["keys"]
    chosen = settle(cut.select("idx", F.explode(fit).alias("key")), "chosen")

    counts = sources.select("idx", "blocks", "times", "target").join(filled.select("idx", "whole"), "idx", "left").join(
        chosen.groupBy("idx").agg(F.lit(1).alias("cut")), "idx", "left").na.fill(0, ["whole", "cut"])
    counts = settle(counts.withColumn("draws", F.col("times") * F.col("blocks") + F.col("whole") + F.col("cut")), "draw-counts")
    words, draws = counts.agg(F.sum("target"), F.sum("draws")).first()
    shards = max(1, min(int(draws or 0), math.ceil((words or 0) / shard_words)))
    offset = Window.partitionBy("idx").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    quotas = split_quotas(counts, shards, seed).withColumn("start", F.coalesce(F.sum("quota").over(offset), F.lit(0))).where("quota > 0")
    drawn = quotas.withColumn("nth", F.explode(F.expr("sequence(start, start + quota - 1)"))).join(counts, "idx")
    drawn = drawn.withColumn("draw", F.pmod(F.col("nth") * F.pmod(F.lit(STRIDE), F.col("draws")) + F.pmod(F.xxhash64(F.lit(seed), "idx"), "draws"), "draws"))
    extra = F.col("draw") - F.col("times") * F.col("blocks")
    drawn = drawn.select("idx", F.when(extra >= 0, extra).otherwise(F.pmod("draw", "blocks")).alias("block"), "shard",
                         ((extra >= 0) & (extra == F.col("whole"))).alias("part"))
    drawn = settle(drawn.groupBy("idx", "block").agg(
        F.array_sort(F.collect_list(F.when(~F.col("part"), F.col("shard")))).alias("all"),
        F.array_sort(F.collect_list(F.when(F.col("part"), F.col("shard")))).alias("some")), "draws")

    none = F.array().cast("array<bigint>")
    rows = blocked(docs).join(drawn, ["idx", "block"], "left").join(chosen.withColumn("picked", F.lit(True)), ["idx", "key"], "left")
    shards_of = F.concat(F.coalesce("all", none), F.when(F.col("picked"), F.coalesce("some", none)).otherwise(none))
    return rows.select("row", "size", "source_size", "target", shards_of.alias("shards"), "key")


def mix(docs: DataFrame, weights: list[float], share: float, cap: float, seed: int = 7, **columns) -> DataFrame:
    """The mixed rows, columns of ``docs`` alone: each shard is one partition, shuffled inside."""
    drawn = plan_mix(docs, weights, share, cap, seed, **columns).select("row", "key", F.posexplode("shards").alias("copy", "shard"))
    drawn = drawn.repartition("shard").sortWithinPartitions("shard", F.xxhash64(F.lit(seed + 1), "key", "copy"))
    return drawn.select("row.*")

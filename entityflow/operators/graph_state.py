"""The entity graph kept up to date from changed records.

A record's whole contribution to the graph is a list of items: its nodes and edges. The state holds the last list of every
record and, for every item, how many records support it. A batch of changed records adds one for each item that is new to a
record and takes one for each that it lost, so only these are touched, and an item goes when no record supports it any more.
Both tables are written as generations, merged by size: a batch adds one, four of a level become one of the next.
What belongs to the state after a batch stands in its manifest, written last, so a repeated batch replaces its own output.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entityflow.operators import graph
from entityflow.session import path_exists, settle

SLOTS, GENERATIONS = 64, 4
ITEM = "struct<kind: string, type: string, a: string, b: string>"
RECORDS = f"record_id string, version long, items array<{ITEM}>, slot int"
SUPPORT = "kind string, type string, a string, b string, n long"
MANIFEST = "name string, level int"
ENDS = {
    graph.AUTHORED: (graph.PERSON_NODE, graph.PAPER_NODE),
    graph.PUBLISHES: (graph.STARTUP_NODE, graph.PRODUCT_NODE),
    graph.FOUNDED: (graph.PERSON_NODE, graph.STARTUP_NODE),
}


def _item(kind: str, item_type: str, a: Column, b: Column | None = None) -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.lit(item_type).alias("type"), a.alias("a"), (F.lit("") if b is None else b).alias("b"))


def _changes(df: DataFrame, record_type: str, key: list[str], version: Column, items: Column, empty_names: bool = False) -> DataFrame:
    """(record_id, version, items); rows without a key take part in nothing, rows of one record and version are put together."""
    named = reduce(lambda x, y: x & y, [F.col(k).isNotNull() & (F.lit(empty_names) | (F.col(k) != "")) for k in key])
    rows = df.where(named).select(F.to_json(F.array(F.lit(record_type), *key)).alias("record_id"), version.cast("long").alias("version"),
                                  F.filter(items, lambda i: i["a"].isNotNull() & (F.lit(empty_names) | (i["a"] != ""))).alias("items"))
    return rows.groupBy("record_id", "version").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def startup_changes(startups: DataFrame, version: Column) -> DataFrame:
    """One record per startup name."""
    return _changes(startups, graph.STARTUP_NODE, ["entityName"], version, F.array(_item("node", graph.STARTUP_NODE, F.col("entityName"))))


def product_changes(products: DataFrame, version: Column) -> DataFrame:
    """One record per product URL. Its edge shows once its startup is known."""
    publishes = _item("edge", graph.PUBLISHES, F.col("startupName"), F.col("url"))
    return _changes(products, graph.PRODUCT_NODE, ["url"], version, F.array(_item("node", graph.PRODUCT_NODE, F.col("url")), publishes))


def paper_changes(papers: DataFrame, version: Column) -> DataFrame:
    """One record per paper URL: the paper, its authors and their edges."""
    authors = F.coalesce("authors", F.array().cast("array<string>"))
    people = F.transform(authors, lambda p: _item("node", graph.PERSON_NODE, p))
    authored = F.transform(authors, lambda p: _item("edge", graph.AUTHORED, p, F.col("paper_url")))
    return _changes(papers, graph.PAPER_NODE, ["paper_url"], version, F.concat(F.array(_item("node", graph.PAPER_NODE, F.col("paper_url"))), people, authored))


def founder_changes(founded: DataFrame, version: Column) -> DataFrame:
    """One record per (person, entityName); an empty name is a name here, as in ``graph.graph_edges``."""
    return _changes(founded, graph.FOUNDED, ["person", "entityName"], version, F.array(_item("edge", graph.FOUNDED, F.col("person"), F.col("entityName"))), True)


def removals(changes: DataFrame) -> DataFrame:
    """The same records, gone as of their versions."""
    return changes.withColumn("items", F.array().cast(f"array<{ITEM}>"))


def _latest(records: DataFrame) -> DataFrame:
    last = records.groupBy("record_id").agg(F.max(F.struct("version", "items")).alias("last")).select("record_id", "last.version", "last.items")
    return last.withColumn("slot", F.pmod(F.xxhash64("record_id"), F.lit(SLOTS)).cast("int"))


def _summed(support: DataFrame) -> DataFrame:
    return support.groupBy("kind", "type", "a", "b").agg(F.sum("n").alias("n")).where("n <> 0")


def _write(records: DataFrame, support: DataFrame, path: str, name: str) -> None:
    records.repartition("slot").write.mode("overwrite").partitionBy("slot").parquet(f"{path}/records/{name}")
    support.write.mode("overwrite").parquet(f"{path}/support/{name}")


def _read(spark: SparkSession, path: str, table: str, schema: str, names: list[str]) -> DataFrame:
    parts = [spark.read.schema(schema).parquet(f"{path}/{table}/{name}") for name in names]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _generations(spark: SparkSession, path: str, batch_id: int) -> list[tuple[str, int]]:
    if batch_id < 0:
        return []
    place = f"{path}/manifests/after-{batch_id}"
    if not path_exists(spark, place):
        raise ValueError(f"batch {batch_id} has not been applied")
    return sorted(tuple(r) for r in spark.read.schema(MANIFEST).parquet(place).collect())  # a few per level


def apply_changes(changes: DataFrame, path: str, batch_id: int) -> None:
    """Bring the state below ``path`` from batch ``batch_id - 1`` to ``batch_id``; batches are numbered from 0.

    changes: (record_id, version, items), several versions of a record allowed. The highest version of a record counts, of
    equal ones in a batch the greater list; one not above the stored version changes nothing, so late and repeated
    changes do no harm. Only the slots of changed records are read. A removed record keeps its version, with an empty list.
    """
    spark = changes.sparkSession
    held = _generations(spark, path, batch_id - 1)
    new = settle(_latest(changes.where("record_id IS NOT NULL AND version IS NOT NULL")), "graph-changes")
    slots = [r[0] for r in new.select("slot").distinct().collect()]  # at most SLOTS numbers
    stored = _read(spark, path, "records", RECORDS, [name for name, _ in held]).where(F.col("slot").isin(slots))
    # Generations hold whole lists; those of unchanged records drop before they are grouped.
    old = _latest(stored.join(new.select("record_id"), "record_id", "left_semi"))
    old = old.select("record_id", F.col("version").alias("old_version"), F.col("items").alias("old_items"))
    moved = settle(new.join(old, "record_id", "left").where("old_version IS NULL OR version > old_version"), "graph-moved")
    before = F.coalesce("old_items", F.array().cast(f"array<{ITEM}>"))

    def signed(items: Column, n: int) -> Column:
        return F.transform(items, lambda i: F.struct(i.alias("item"), F.lit(n).cast("long").alias("n")))

    both = F.concat(signed(F.array_except("items", before), 1), signed(F.array_except(before, F.col("items")), -1))
    deltas = moved.select(F.explode(both).alias("d")).select("d.item.*", "d.n")
    name = f"batch-{batch_id}"
    _write(moved.select("record_id", "version", "items", "slot"), _summed(deltas), path, name)
    now, level = [*held, (name, 0)], 0
    while sum(g[1] == level for g in now) >= GENERATIONS:
        due = [g[0] for g in now if g[1] == level]
        name = f"level{level + 1}-{batch_id}"
        _write(_latest(_read(spark, path, "records", RECORDS, due)), _summed(_read(spark, path, "support", SUPPORT, due)), path, name)
        now = [g for g in now if g[1] != level] + [(name, level + 1)]
        level += 1
    spark.createDataFrame(now, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifests/after-{batch_id}")


def support(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """(kind, type, a, b, n): all items that a record supports after a batch, and how many do."""
    return _summed(_read(spark, path, "support", SUPPORT, [name for name, _ in _generations(spark, path, batch_id)]))


def nodes(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """(id, node_type, name) after a batch; equals ``graph.graph_nodes`` over the records of that time."""
    rows = support(spark, path, batch_id).where("kind = 'node'")
    return rows.select(graph.node_id_of(F.col("type"), F.col("a")).alias("id"), F.col("type").alias("node_type"), F.col("a").alias("name"))


def edges(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """(src, edge_type, dst) after a batch; equals ``graph.graph_edges`` over the records of that time."""
    every = support(spark, path, batch_id)
    rows = every.where("kind = 'edge'")
    startups = every.where((F.col("kind") == "node") & (F.col("type") == graph.STARTUP_NODE)).select("a")
    publishes = F.col("type") == graph.PUBLISHES
    rows = rows.where(~publishes).unionByName(rows.where(publishes).join(startups, "a", "left_semi"))
    ends = [F.create_map(*[F.lit(x) for edge, types in ENDS.items() for x in (edge, types[k])])[F.col("type")] for k in (0, 1)]
    return rows.select(graph.node_id_of(ends[0], F.col("a")).alias("src"), F.col("type").alias("edge_type"), graph.node_id_of(ends[1], F.col("b")).alias("dst"))

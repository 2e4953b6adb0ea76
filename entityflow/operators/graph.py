"""Entity graph tables, derived from the record tables and never the source of truth."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Node and edge types.
STARTUP_NODE, PAPER_NODE, PERSON_NODE, PRODUCT_NODE = "Startup", "Paper", "Person", "Product"
AUTHORED, FOUNDED, PUBLISHES = "AUTHORED", "FOUNDED", "PUBLISHES"


def node_id(node_type: str, key) -> Column:
    return node_id_of(F.lit(node_type), F.col(key) if isinstance(key, str) else key)


def node_id_of(node_type: Column, key: Column) -> Column:
    return F.sha2(F.concat_ws("|", node_type, key), 256)


def _nodes(df: DataFrame, node_type: str, key: Column) -> DataFrame:
    named = df.select(key.alias("name")).filter(F.col("name").isNotNull() & (F.col("name") != ""))
    return named.select(node_id(node_type, "name").alias("id"), F.lit(node_type).alias("node_type"), "name")


def graph_nodes(startups: DataFrame, products: DataFrame, papers: DataFrame) -> DataFrame:
    """Distinct Startup, Product, Paper and Person nodes: (id, node_type, name).

    startups(entityName), products(startupName, url), papers(paper_url, authors).
    """
    parts = [
        _nodes(startups, STARTUP_NODE, F.col("entityName")),
        _nodes(products, PRODUCT_NODE, F.col("url")),
        _nodes(papers, PAPER_NODE, F.col("paper_url")),
        _nodes(papers, PERSON_NODE, F.explode("authors")),
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def graph_edges(startups: DataFrame, products: DataFrame, papers: DataFrame, founded: DataFrame | None = None) -> DataFrame:
    """Distinct typed edges (src, edge_type, dst).

    AUTHORED: person -> paper. PUBLISHES: startup -> product sharing its
    canonical name. FOUNDED: person -> startup, from the given (person,
    entityName) table, since no record type holds founders.
    """
    authored = papers.select(F.explode("authors").alias("person"), "paper_url").filter(
        (F.col("person") != "") & (F.col("paper_url") != "")
    )
    known = startups.select(F.col("entityName").alias("startupName")).distinct()
    publishes = products.select("startupName", "url").filter(F.col("startupName") != "").join(known, "startupName", "left_semi")
    parts = [
        _edges(authored, PERSON_NODE, "person", AUTHORED, PAPER_NODE, "paper_url"),
        _edges(publishes, STARTUP_NODE, "startupName", PUBLISHES, PRODUCT_NODE, "url"),
    ]
    if founded is not None:
        parts.append(_edges(founded, PERSON_NODE, "person", FOUNDED, STARTUP_NODE, "entityName"))
    return reduce(DataFrame.unionByName, parts)


def _edges(df: DataFrame, src_type: str, src: str, edge: str, dst_type: str, dst: str) -> DataFrame:
    # Distinct on the short names first; the hashes are made once per edge.
    return df.select(src, dst).distinct().select(
        node_id(src_type, src).alias("src"), F.lit(edge).alias("edge_type"), node_id(dst_type, dst).alias("dst")
    )


def people_in_both(papers: DataFrame, job_people: DataFrame) -> DataFrame:
    """People who author a paper and are linked to a job posting (``job_people.person``)."""
    authors = papers.select(F.explode("authors").alias("person")).distinct()
    return authors.join(job_people.select("person").distinct(), "person", "left_semi")


def startups_from_papers(startups: DataFrame, papers: DataFrame, links: DataFrame) -> DataFrame:
    """Startups linked to a known paper: (entityName, paper_url) through a link table (row_id, paper_url)."""
    known = papers.select("paper_url").filter(F.col("paper_url") != "").distinct()
    pairs = links.select("row_id", "paper_url").distinct().join(known, "paper_url", "left_semi")
    return startups.select("row_id", "entityName").join(pairs, "row_id").select("entityName", "paper_url").distinct()


def products_of_startup(products: DataFrame, startups: DataFrame) -> DataFrame:
    """Products of known startups by canonical name, with the number each startup has."""
    known = startups.select(F.col("entityName").alias("startupName")).distinct()
    own = products.select("startupName", "url").distinct().join(known, "startupName", "left_semi")
    return _with_sizes(own)


def same_parent(products: DataFrame) -> DataFrame:
    """Products that share their parent with at least one other product.

    A membership list (one row per product, with the family's size), not pairs:
    a parent of n products gives n rows.
    """
    own = products.select("startupName", "url").filter(F.col("startupName") != "").distinct()
    return _with_sizes(own).filter("n_products > 1")


def _with_sizes(own: DataFrame) -> DataFrame:
    sizes = own.groupBy("startupName").agg(F.count(F.lit(1)).alias("n_products"))
    return own.join(sizes, "startupName")

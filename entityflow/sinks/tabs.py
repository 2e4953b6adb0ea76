"""Flat views, CSV backups and published tabs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityflow.schemas import MAPPING_LOG

# Tab names in publishing order, backup file names, marker of an empty tab.
TAB_NAMES = ["Startups", "Products", "Research Papers", "Jobs", "News", "Entity Mapping Log"]
BACKUP_NAMES = ["startups", "products", "research_papers", "news", "jobs", "entity_mapping_log"]
EMPTY_MARKER = "(no data collected this run)"


def _leaves(schema: T.StructType, prefix: str, sep: str, label: str) -> list[tuple[Column, str]]:
    plain, nested = [], []
    for field in schema.fields:
        path = f"{prefix}`{field.name}`"
        name = f"{label}{field.name}"
        if isinstance(field.dataType, T.StructType):
            nested += _leaves(field.dataType, f"{path}.", sep, f"{name}{sep}")
        elif isinstance(field.dataType, (T.ArrayType, T.MapType)):
            plain.append((F.to_json(F.col(path)), name))
        else:
            plain.append((F.col(path), name))
    return plain + nested


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested fields as ``a.b`` columns: plain ones first, nested ones after; a list is one JSON cell."""
    return df.select(*[c.alias(name) for c, name in _leaves(df.schema, "", sep, "")])


def write_backups(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """One CSV folder with header per table, replaced on each run; returns the paths."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder.rstrip('/')}/{name}.csv"
        flatten(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(paths[name])
    return paths


def startups_tab(df: DataFrame) -> DataFrame:
    return df.select(
        "content.entityName", "content.data.employeeCount", F.col("source.name").alias("source"),
        F.col("source.url").alias("sourceUrl"), "collectedAt",
    )


def products_tab(df: DataFrame) -> DataFrame:
    return df.select(
        "content.startupName", "content.pricingModel", F.col("source.name").alias("source"),
        F.col("source.url").alias("sourceUrl"), "collectedAt",
    )


def papers_tab(df: DataFrame) -> DataFrame:
    return df.select(
        "content.title", F.array_join("content.authors", ", ").alias("authors"), "content.paper_url",
        "content.github_url", "content.github_stars", "content.published_date",
    )


def jobs_tab(df: DataFrame) -> DataFrame:
    return df.select("content.company", "content.date", "content.is_remote", "content.role_family")


def news_tab(df: DataFrame) -> DataFrame:
    return df.select(
        "content.headline", "content.url", "content.publishedAt", "content.summary", F.col("source.name").alias("source")
    )


def mapping_log_tab(log: DataFrame) -> DataFrame:
    """Scores to one digit, halves to even."""
    return log.select("raw_name", "canonical_name", F.bround("match_score", 1).alias("match_score"), "matched_seed").to(
        MAPPING_LOG
    )


def as_text(df: DataFrame, null: str = "None") -> DataFrame:
    """Every cell as text, one token for null."""
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null)).alias(c) for c in df.columns])


def publish_tabs(tabs: Mapping[str, DataFrame], folder: str | None = None, database: str | None = None) -> dict[str, str]:
    """Replace each tab in full, creating it when absent; an empty tab then gets its one marker row.

    Tabs go to Parquet folders below ``folder`` or to tables of ``database``.
    Emptiness is asked of the written tab, so its plan runs only once.
    """
    if (folder is None) == (database is None):
        raise ValueError("give either a folder or a database")

    def put(df: DataFrame, place: str) -> None:
        writer = df.write.mode("overwrite")
        writer.parquet(place) if folder is not None else writer.saveAsTable(place)

    places = {}
    for name, df in tabs.items():
        table = name.lower().replace(" ", "_")
        place = f"{folder.rstrip('/')}/{table}" if folder is not None else f"{database}.{table}"
        put(as_text(df), place)
        if read_tab(df.sparkSession, place).isEmpty():
            put(df.sparkSession.createDataFrame([(EMPTY_MARKER,)], "value string"), place)
        places[name] = place
    return places


def read_tab(spark: SparkSession, place: str) -> DataFrame:
    return spark.read.parquet(place) if "/" in place else spark.table(place)

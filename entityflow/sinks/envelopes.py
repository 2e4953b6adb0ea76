"""Envelopes of the five record types, and the one-table JSON store of all of them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityflow.functions.labels import company_or_site, is_remote, pricing_model, role_family
from entityflow.functions.times import as_instant
from entityflow.schemas import (
    CONTENT,
    HAS_SOURCE,
    JOB,
    NEWS,
    PRODUCT,
    REQUIRED,
    RESEARCH_PAPER,
    SCHEMA_VERSION,
    STARTUP,
)
from entityflow.sources.sites import COMPANY_SITE, PRODUCT_SITE


def envelope(
    df: DataFrame, record_type: str, content: Column, run_ts, source: Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """schemaVersion, recordType, source (where the type has one), content, collectedAt.

    ``run_ts`` is an argument, so a rerun gives the same rows. ``keep`` passes
    key columns through in front. A row lacking a required content field is
    no record and drops.
    """
    columns = [F.col(c) for c in keep]
    columns += [F.lit(SCHEMA_VERSION).alias("schemaVersion"), F.lit(record_type).alias("recordType")]
    if HAS_SOURCE[record_type]:
        columns.append(source.alias("source"))
    columns += [content.cast(CONTENT[record_type]).alias("content"), as_instant(run_ts).alias("collectedAt")]
    present = reduce(lambda a, b: a & b, [F.col(f"content.{f}").isNotNull() for f in REQUIRED[record_type]])
    return df.select(*columns).filter(present)


def _source(name, url) -> Column:
    return F.struct(name.alias("name"), F.col(url).alias("url"))


def startup_envelopes(df: DataFrame, run_ts, keep: tuple[str, ...] = ()) -> DataFrame:
    """From (name, url, employee_count)."""
    content = F.struct(
        F.col("name").alias("entityName"), F.struct(F.col("employee_count").alias("employeeCount")).alias("data")
    )
    return envelope(df, STARTUP, content, run_ts, _source(F.lit(COMPANY_SITE[0]), "url"), keep)


def product_envelopes(df: DataFrame, run_ts, keep: tuple[str, ...] = ()) -> DataFrame:
    """From (name, url, pricing_raw)."""
    content = F.struct(F.col("name").alias("startupName"), pricing_model("pricing_raw").alias("pricingModel"))
    return envelope(df, PRODUCT, content, run_ts, _source(F.lit(PRODUCT_SITE[0]), "url"), keep)


def paper_envelopes(df: DataFrame, run_ts, keep: tuple[str, ...] = ()) -> DataFrame:
    """From (title, authors, paper_url, github_url, github_stars, published_date)."""
    content = F.struct("title", "authors", "paper_url", "github_url", "github_stars", "published_date")
    return envelope(df, RESEARCH_PAPER, content, run_ts, keep=keep)


def job_envelopes(df: DataFrame, run_ts, keep: tuple[str, ...] = ()) -> DataFrame:
    """From (title, company, site_name, published_at)."""
    content = F.struct(
        company_or_site("company", "site_name").alias("company"),
        F.col("published_at").alias("date"),
        is_remote("title").alias("is_remote"),
        role_family("title").alias("role_family"),
    )
    return envelope(df, JOB, content, run_ts, keep=keep)


def news_envelopes(df: DataFrame, run_ts, keep: tuple[str, ...] = ()) -> DataFrame:
    """From (title, url, site_name, site_url, published_at); the summary is never filled."""
    content = F.struct(
        F.col("title").alias("headline"), F.col("url"), F.col("published_at").alias("publishedAt"),
        F.lit(None).cast("string").alias("summary"),
    )
    return envelope(df, NEWS, content, run_ts, _source(F.col("site_name"), "site_url"), keep)


def envelope_store(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All record types in one table: recordType, schemaVersion, collectedAt, source name and url, JSON content."""

    def stored(df: DataFrame) -> DataFrame:
        has_source = "source" in df.columns
        null = F.lit(None).cast("string")
        return df.select(
            "recordType", "schemaVersion", "collectedAt",
            (F.col("source.name") if has_source else null).alias("source_name"),
            (F.col("source.url") if has_source else null).alias("source_url"),
            F.to_json("content").alias("content"),
        )

    return reduce(DataFrame.unionByName, [stored(df) for df in tables.values()])


def write_store(store: DataFrame, path: str) -> None:
    """One folder per record type, so a query on a type reads only that type; rows by time within each file, so a
    range of times skips the row groups outside it."""
    store.sortWithinPartitions("recordType", "collectedAt").write.mode("overwrite").partitionBy("recordType").parquet(path)


def query_content(
    store: DataFrame,
    record_type: str,
    paths: Mapping[str, str],
    collected_from=None,
    collected_to=None,
    schema_version: str | None = None,
) -> DataFrame:
    """Filter on the envelope columns, then read fields (name -> '$.json.path') inside the content."""
    rows = store.filter(F.col("recordType") == record_type)
    if schema_version is not None:
        rows = rows.filter(F.col("schemaVersion") == schema_version)
    if collected_from is not None:
        rows = rows.filter(F.col("collectedAt") >= as_instant(collected_from))
    if collected_to is not None:
        rows = rows.filter(F.col("collectedAt") < as_instant(collected_to))
    return rows.select(
        "recordType", "collectedAt", *[F.get_json_object("content", path).alias(name) for name, path in paths.items()]
    )

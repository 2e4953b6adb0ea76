"""Repository popularity for papers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityflow.functions.text import repo_slug
from entityflow.operators.dedup import FIRST_SEEN_ORDER
from entityflow.operators.joins import left_lookup


def distinct_slugs(papers: DataFrame, url: str = "github_url") -> DataFrame:
    """Unique repository slugs: each is looked up once."""
    return papers.select(repo_slug(url).alias("slug")).filter(F.col("slug").isNotNull()).distinct()


def enrich_stars(
    papers: DataFrame,
    stars: DataFrame,
    key: str = "url",
    order: Sequence[str] = FIRST_SEEN_ORDER,
) -> DataFrame:
    """Adds ``github_stars``, null without a repository or when its lookup missed.

    ``stars`` is (slug, stargazers_count); a null count is 0. With
    ``key="url"`` only the exact link text of the first paper carrying a slug
    receives the count, another spelling of the same slug stays null.
    ``key="slug"`` gives every spelling its count.
    """
    counts = stars.select("slug", F.coalesce("stargazers_count", F.lit(0)).alias("github_stars"))
    if key == "slug":
        keyed = papers.withColumn("slug", repo_slug("github_url"))
        return left_lookup(keyed, counts, "slug", "paper_url").drop("slug")
    first_links = (
        papers.filter(F.col("github_url").isNotNull())
        .withColumn("slug", repo_slug("github_url"))
        .groupBy("slug")
        .agg(F.min_by("github_url", F.struct(*order)).alias("github_url"))
    )
    by_link = first_links.join(counts, "slug").select("github_url", "github_stars")
    return left_lookup(papers, by_link, "github_url", "paper_url")

"""Page and feed tables to records, one lazy plan per record type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityflow.operators.dedup import contiguous_pages, page_window, take_until
from entityflow.operators.enrich import enrich_stars
from entityflow.operators.filters import require, under_size_cap
from entityflow.operators.reports import union_sources
from entityflow.schemas import FRESHNESS_HOURS, PAGE_SIZE
from entityflow.session import settle
from entityflow.sinks.envelopes import job_envelopes, news_envelopes, paper_envelopes, product_envelopes, startup_envelopes
from entityflow.sources.cards import extract_cards, extract_company_cards, extract_job_postings, extract_product_cards
from entityflow.sources.papers import parse_feed_pages
from entityflow.sources.sites import pages_for_site


def papers(entries: DataFrame, stars: DataFrame, run_ts, target: int | None = None) -> DataFrame:
    """Feed entries (source_rank, page_no, row_id + entry columns) to enriched paper records.

    Pages of a category count up to its first empty page. With a target, pages are read until that
    many unique papers are met; without one, all are kept.
    """
    usable = settle(require(entries, ["title", "paper_url"]), "feed-entries")
    reached = usable.join(contiguous_pages(usable), ["source_rank", "page_no"], "left_semi")
    unique = take_until(reached, "paper_url", target)
    return paper_envelopes(enrich_stars(unique, stars), run_ts, keep=("source_rank", "page_no", "row_id"))


def feed_entries(feed_pages: DataFrame, page_cap: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Stored feed pages (source_rank, page_no, body) to entries in reading order.

    ``page_cap`` limits the entries per source that are asked for (PAGE_CAP is the feed's own limit), ``max_bytes`` the body.
    """
    within = feed_pages if page_cap is None else feed_pages.filter(F.col("page_no") * PAGE_SIZE < page_cap)
    capped = under_size_cap(within, "body", max_bytes)
    return parse_feed_pages(capped).withColumnRenamed("entry_no", "row_id")


def feed_from_archive(papers_table: DataFrame, category: str = "source_rank", cap: int | None = None) -> DataFrame:
    """A stored paper table seen as feed pages: newest first, 100 per page, at most ``cap`` per category."""
    windowed = page_window(papers_table.drop("page_no"), category=category, cap=cap)
    return windowed.withColumn("row_id", F.col("feed_rank"))


def _site_pages(pages: DataFrame, sites: DataFrame, kind: str, max_bytes: int | None) -> DataFrame:
    return pages_for_site(under_size_cap(pages, "html", max_bytes), sites.filter(F.col("kind") == kind))


def news(
    pages: DataFrame, sites: DataFrame, now, run_ts, hours: int | None = FRESHNESS_HOURS, fuzzy: bool = False, max_bytes: int | None = None
) -> DataFrame:
    """Fresh news records of all news sites; repeats are kept."""
    return news_envelopes(extract_cards(_site_pages(pages, sites, "news", max_bytes), now, hours, fuzzy), run_ts)


def jobs(
    pages: DataFrame, sites: DataFrame, now, run_ts, hours: int | None = FRESHNESS_HOURS, fuzzy: bool = False, max_bytes: int | None = None
) -> DataFrame:
    """Fresh job records of all job sites, cards and embedded records alike; repeats are kept."""
    on_site = _site_pages(pages, sites, "job", max_bytes)
    columns = ["page_id", "site_name", "title", "company", "published_at"]
    cards = extract_cards(on_site, now, hours, fuzzy).withColumn("company", F.lit(None).cast("string")).select(*columns)
    rows = on_site.filter(F.col("extractor") == "job_rows")
    posted = extract_job_postings(rows, now, hours, keep=("page_id", "site_name")).select(*columns)
    return job_envelopes(union_sources([cards, posted]), run_ts)


def _page_number(url: str = "url"):
    return F.coalesce(F.regexp_extract(url, r"[?&]page=([0-9]+)", 1).try_cast("int"), F.lit(1))


def products(
    pages: DataFrame, sites: DataFrame, run_ts, target: int | None = None, last_page: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Unique products of the directory categories; with a target, page by page until it is met."""
    numbered = _site_pages(pages, sites, "product", max_bytes).withColumn("page_no", _page_number())
    numbered = numbered if last_page is None else numbered.filter(F.col("page_no") <= last_page)
    # Markup is read once; the paging and target rules below reread only the small card table.
    cards = settle(extract_product_cards(numbered, keep=("page_id", "source_rank", "page_no")), "product-cards")
    reached = cards.join(contiguous_pages(cards, first_page=1), ["source_rank", "page_no"], "left_semi")
    unique = take_until(reached.withColumnRenamed("card_no", "row_id"), "url", target)
    return product_envelopes(unique, run_ts)


def startups(pages: DataFrame, sites: DataFrame, run_ts, target: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Unique companies of the directory tags; with a target, whole tags until it is met."""
    cards = settle(extract_company_cards(_site_pages(pages, sites, "company", max_bytes)), "company-cards")
    unique = take_until(cards, "href", target, page=None, order=("source_rank", "page_id", "card_no"))
    return startup_envelopes(unique, run_ts)

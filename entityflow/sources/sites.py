"""The source dimension: which sites, categories and tags are read, in which order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The sources and how their cards are found. Columns: kind, name,
# url, card, title, link, time. Order within a kind is the reading order.
NEWS_SITES = [
    ("VentureBeat AI", "https://venturebeat.com/category/ai/", "article", "h2 a, h3 a", "h2 a, h3 a", "time"),
    ("TechCrunch AI", "https://techcrunch.com/category/artificial-intelligence/", "div.loop-card", "h3.loop-card__title a", "h3.loop-card__title a", "time"),
    ("The Verge AI", "https://www.theverge.com/ai-artificial-intelligence", "article", "h2 a", "h2 a", "time"),
    ("MIT Tech Review AI", "https://www.technologyreview.com/topic/artificial-intelligence/", "article", "h3 a, h2 a", "h3 a, h2 a", "time"),
    ("Ars Technica AI", "https://arstechnica.com/ai/", "li.tease-full, article", "h2 a", "h2 a", "time"),
]
JOB_SITES = [
    ("SimplyHired", "https://www.simplyhired.com/search?q=artificial+intelligence", "div.SerpJob, li.SerpJob-jobCard", "a", "a", "time"),
    ("AI-Jobs.net", "https://ai-jobs.net/", "li.job-list-item", "a", "a", "time"),
    ("WeWorkRemotely", "https://weworkremotely.com/categories/remote-programming-jobs?term=ai", "li.feature, article", "a", "a", "time"),
    ("Wellfound", "https://wellfound.com/role/ai-engineer", "div[data-test='StartupResult'], div[data-test='JobSearchResult']", "a", "a", "time"),
    ("RemoteOK", "https://remoteok.com/remote-ai-jobs", "tr.job[data-id]", "", "", ""),
]
PAPER_CATEGORIES = ["cs.AI", "cs.LG", "cs.CL", "cs.CV", "stat.ML"]
PAPER_FEED = "http://export.arxiv.org/api/query"
PRODUCT_SITE = ("Futurepedia", "https://www.futurepedia.io")
PRODUCT_CATEGORIES = [
    "marketing", "ai-agents", "workflows", "research-assistant",
    "personal-assistant", "social-media", "design-generators",
]
PRODUCT_PAGES = 40
COMPANY_SITE = ("Y Combinator", "https://www.ycombinator.com")
COMPANY_TAGS = ["artificial-intelligence", "generative-ai", "machine-learning", "computer-vision", "nlp"]

# Card rules of the two directories: card, title, link, extra text.
PRODUCT_CARD = ("div.bg-card", "p", r"^https://www\.futurepedia\.io/tool/[\w-]+", "div.flex.justify-between.text-lg > span")
COMPANY_CARD = ("a[href^='/companies/']:has(> li)", ".text-2xl", "span.text-gray-700")

SITE_ROWS = 1_000

SITE_SCHEMA = (
    "kind string, source_rank int, name string, url string, "
    "card_selector string, title_selector string, link_selector string, time_selector string, extractor string"
)


def site_config(spark: SparkSession) -> DataFrame:
    """One row per source: 5 news and 5 job sites, paper and product categories, company tags."""
    rows = []
    for rank, (name, url, card, title, link, time) in enumerate(NEWS_SITES):
        rows.append(("news", rank, name, url, card, title, link, time, "cards"))
    for rank, (name, url, card, title, link, time) in enumerate(JOB_SITES):
        rows.append(("job", rank, name, url, card, title, link, time, "cards" if title else "job_rows"))
    for rank, category in enumerate(PAPER_CATEGORIES):
        rows.append(("paper", rank, category, PAPER_FEED, "", "", "", "", "feed"))
    for rank, slug in enumerate(PRODUCT_CATEGORIES):
        url = f"{PRODUCT_SITE[1]}/ai-tools/{slug}"
        rows.append(("product", rank, slug, url, PRODUCT_CARD[0], PRODUCT_CARD[1], "a", "", "product_cards"))
    for rank, tag in enumerate(COMPANY_TAGS):
        url = f"{COMPANY_SITE[1]}/companies/industry/{tag}"
        rows.append(("company", rank, tag, url, COMPANY_CARD[0], COMPANY_CARD[1], "self", "", "company_cards"))
    return spark.createDataFrame(rows, SITE_SCHEMA)


def host_of(url) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def pages_for_site(pages: DataFrame, sites: DataFrame, url: str = "url") -> DataFrame:
    """Attach the site row to every page of a site; pages of other hosts drop.

    News and job sites own their host. Directory categories and tags share one, so their pages must also lie below the
    category's address. Up to SITE_ROWS sites, checked, become a literal map from host to site rows, so page bodies stay where they
    are: no shuffle and no broadcast, whatever the settings. A longer list is joined on the host.
    """
    side = sites.filter(F.col("kind") != "paper").select(
        host_of(F.col("url")).alias("__host"), "kind", "source_rank", F.col("name").alias("site_name"),
        F.col("url").alias("site_url"), "card_selector", "title_selector", "link_selector", "time_selector", "extractor",
    )

    def belongs(site_url, kind):
        tail = F.substring(F.col(url), F.length(site_url) + 1, F.lit(1))
        return ~kind.isin("product", "company") | (F.col(url).startswith(site_url) & tail.isin("", "/", "?", "#"))

    rows = side.limit(SITE_ROWS + 1).collect()
    if len(rows) > SITE_ROWS:
        joined = pages.withColumn("__host", host_of(F.col(url))).join(side, "__host").drop("__host")
        return joined.filter(belongs(F.col("site_url"), F.col("kind")))
    fields = side.schema.fields[1:]
    by_host: dict[str, list[Column]] = {}
    for row in rows:
        site = F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in fields])
        by_host.setdefault(row["__host"], []).append(site)
    if not by_host:
        return pages.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).filter(F.lit(False))
    known = F.create_map(*[x for host, found in by_host.items() for x in (F.lit(host), F.array(*found))])
    mine = F.filter(known[host_of(F.col(url))], lambda site: belongs(site["site_url"], site["kind"]))
    return pages.select("*", F.explode(mine).alias("__site")).select(*pages.columns, "__site.*")

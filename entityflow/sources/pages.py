"""Page bodies: size cap and safe decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityflow.operators.filters import under_size_cap
from entityflow.schemas import MAX_BODY_BYTES

LINK = r'<a\s[^>]*href="([^"]*)"'


def read_pages(spark: SparkSession, path: str, max_bytes: int = MAX_BODY_BYTES) -> DataFrame:
    """(page_id, url, html) from a Parquet page table; bodies over the cap are rejected."""
    pages = spark.read.parquet(path).select("page_id", "url", "html")
    return under_size_cap(pages, "html", max_bytes)


def read_page_files(spark: SparkSession, path: str, max_bytes: int = MAX_BODY_BYTES) -> DataFrame:
    """(url, html) from raw files: the path stands for the URL, bad bytes are replaced on decode."""
    files = spark.read.format("binaryFile").load(path).filter(F.col("length") <= max_bytes)
    return files.select(F.col("path").alias("url"), F.make_valid_utf8(F.col("content").cast("string")).alias("html"))


def page_links(pages: DataFrame) -> DataFrame:
    """One row per link of a page, in order: (page_id, url, link_no, href)."""
    hrefs = F.regexp_extract_all("html", F.lit(LINK), 1)
    return pages.select("page_id", "url", F.posexplode(hrefs).alias("link_no", "href"))

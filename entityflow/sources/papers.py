"""Paper feed pages (Atom) and repository star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityflow.functions.text import clean_array, clean_title, empty_to_null, first_repo_url, strip
from entityflow.functions.times import parse_iso
from entityflow.operators.filters import require
from entityflow.schemas import MAX_BODY_BYTES

FEED_SCHEMA = (
    "entry ARRAY<STRUCT<id: STRING, title: STRING, summary: STRING, published: STRING, "
    "author: ARRAY<STRUCT<name: STRING>>>>"
)


def parse_feed_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """One row per feed entry of every page, the page's other columns kept.

    Adds entry_no, title, authors, paper_url, summary, github_url, published.
    A page is read as a whole: one that is not well formed gives no rows. An
    entry without title or id drops; blank dates and author names vanish.
    """
    others = [c for c in pages.columns if c != body]
    feed = F.from_xml(F.col(body), FEED_SCHEMA, {"ignoreSurroundingSpaces": "false"})
    entries = pages.select(*others, F.posexplode(feed["entry"]).alias("entry_no", "e"))
    names = F.transform(F.col("e.author"), lambda a: F.coalesce(a["name"], F.lit("")))
    return require(
        entries.select(
            *others,
            "entry_no",
            clean_title("e.title").alias("title"),
            F.coalesce(clean_array(names), F.array().cast("array<string>")).alias("authors"),
            strip("e.id").alias("paper_url"),
            F.coalesce("e.summary", F.lit("")).alias("summary"),
            first_repo_url("e.summary").alias("github_url"),
            empty_to_null(strip("e.published")).alias("published"),
        ),
        ["title", "paper_url"],
    ).withColumn("published_date", parse_iso("published"))


def read_papers(spark: SparkSession, path: str, per: str = "file", max_bytes: int = MAX_BODY_BYTES) -> DataFrame:
    """Entries of stored feed pages: one page per file, or per line with ``per="line"``.

    Adds ``path``. Pages over the byte cap are rejected before they are read as XML.
    """
    if per == "file":
        # The length filter reaches the file listing, so an oversized file is never opened.
        files = spark.read.format("binaryFile").load(path).filter(F.col("length") <= max_bytes)
        pages = files.select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("body"))
    else:
        lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))
        pages = lines.filter(F.octet_length("body") <= max_bytes)
    return parse_feed_pages(pages)


def read_repo_stars(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """(slug, stargazers_count); a missing count is 0, a failed lookup has no row."""
    reader = spark.read.schema("slug string, stargazers_count int").format(fmt)
    return reader.load(path).filter(F.col("slug").isNotNull()).select(
        "slug", F.coalesce("stargazers_count", F.lit(0)).alias("stargazers_count")
    )

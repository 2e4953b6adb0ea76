"""Cards and job rows out of page bodies.

Only reading the markup happens in Python, one Arrow batch at a time and one
page at a time; time parsing, freshness, links and labels follow as native
expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityflow.functions.text import empty_to_null, strip, unescape_entities
from entityflow.functions.text import employee_count as employees
from entityflow.functions.times import parse_iso
from entityflow.functions.urls import absolute_url
from entityflow.operators.filters import fresh_only
from entityflow.operators.pin import pin
from entityflow.operators.timed import fresh_by_text
from entityflow.schemas import FRESHNESS_HOURS
from entityflow.sources.markup import Page, first, select, within
from entityflow.sources.sites import COMPANY_CARD, COMPANY_SITE, PRODUCT_CARD

CARD_FIELDS = ["title", "href", "extra"]


def _line(text: str) -> str:
    return " ".join(text.split())


def signal_cards(html: str, row) -> Iterator[tuple]:
    """(title, href, time text) of every card that has all three."""
    for card in select(Page(html, implied=True).nodes, row.card_selector):
        title = card if row.title_selector == "self" else first(card, row.title_selector)
        link = card if row.link_selector == "self" else first(card, row.link_selector)
        when = first(card, row.time_selector) if row.time_selector else None
        if title is None or link is None or when is None:
            continue
        found = (_line(title.text()), link.attrs.get("href"), when.attrs.get("datetime") or _line(when.text()))
        if all(found):
            yield found


def product_cards(html: str, row) -> Iterator[tuple]:
    """(name, tool link, pricing text or None) of every directory card with a name and a tool link."""
    card_rule, name_rule, link_rule, price_rule = PRODUCT_CARD
    for card in select(Page(html).nodes, card_rule):
        link = next((n for n in select(within(card), "a") if re.search(link_rule, n.attrs.get("href", ""))), None)
        name = first(card, name_rule)
        if link is None or name is None:
            continue
        title = "".join(s.strip() for s in name.strings())
        price = first(card, price_rule)
        if title:
            yield title, link.attrs["href"], "".join(s.strip() for s in price.strings()) if price else None


def company_cards(html: str, row) -> Iterator[tuple]:
    """(name, href, badge naming the employees or None) of every company card."""
    card_rule, name_rule, badge_rule = COMPANY_CARD
    for card in select(Page(html, implied=True).nodes, card_rule):
        name = first(card, name_rule)
        badges = (b.text() for b in select(within(card), badge_rule))
        badge = next((b for b in badges if re.search(r"[\d,]+\s+employees?", b, re.IGNORECASE)), None)
        if name is not None and name.text().strip():
            yield name.text().strip(), card.attrs["href"], badge


EXTRACTORS: dict[str, Callable] = {
    "cards": signal_cards,
    "product_cards": product_cards,
    "company_cards": company_cards,
}


def read_cards(pages: DataFrame, keep: list[str], extractors: dict[str, Callable] | None = None) -> DataFrame:
    """Cards of every page: the ``keep`` columns plus card_no, title, href, extra, failure.

    ``pages`` is a page table joined to its site rows (html, extractor, the
    selectors). A page whose reading fails gives one row with the reason in ``failure`` and nothing else. Own extractors can
    be passed by name: functions (html, page row) -> (title, href, extra).
    """
    known = {**EXTRACTORS, **(extractors or {})}
    needs = ["html", "extractor", "card_selector", "title_selector", "link_selector", "time_selector"]
    columns = list(dict.fromkeys([*keep, *needs]))
    found_fields = [T.StructField("card_no", T.IntegerType())] + [T.StructField(f, T.StringType()) for f in (*CARD_FIELDS, "failure")]
    schema = T.StructType(pages.select(*keep).schema.fields + found_fields)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                head = [getattr(row, c) for c in keep]
                try:
                    found = list(known[row.extractor](row.html, row))
                except Exception as error:  # a malformed page is told, never fatal
                    rows.append((*head, None, *[None] * len(CARD_FIELDS), f"{type(error).__name__}: {error}"))
                    continue
                rows += [(*head, i, *card, None) for i, card in enumerate(found)]
            made = pd.DataFrame(rows, columns=[*keep, "card_no", *CARD_FIELDS, "failure"])
            yield made.astype({"card_no": "Int32"})

    readable = pages.filter(F.col("html").isNotNull() & F.col("extractor").isin(sorted(known)))
    # A card needs its time element, so a page without any never has to reach Python.
    timeless = (F.col("extractor") == "cards") & (F.col("time_selector") == "time") & ~F.col("html").rlike(r"(?i)<time\b")
    readable = readable.filter(~timeless) if not extractors else readable
    return readable.select(*columns).mapInPandas(extract, schema)


def raw_cards(pages: DataFrame, keep: list[str], extractors: dict[str, Callable] | None = None) -> DataFrame:
    """The cards of every page that could be read; ``page_failures`` lists the others."""
    return read_cards(pages, keep, extractors).filter(F.col("failure").isNull()).drop("failure")


def page_failures(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), extractors: dict[str, Callable] | None = None) -> DataFrame:
    """The ``keep`` columns plus failure, one row per page whose reading failed."""
    failed = read_cards(pages, list(keep), extractors).filter(F.col("failure").isNotNull())
    return failed.select(*keep, "failure")


def extract_cards(pages: DataFrame, now, hours: int | None = FRESHNESS_HOURS, fuzzy: bool = False) -> DataFrame:
    """Fresh news or job cards: (page_id, source_rank, site_name, site_url, card_no, title, url, published_at)."""
    keep = ["page_id", "source_rank", "site_name", "site_url"]
    cards = raw_cards(pages.filter(F.col("extractor") == "cards"), keep)
    return fresh_by_text(cards, "extra", "published_at", now, hours, fuzzy).select(
        *keep, "card_no", "title", absolute_url("href", "site_url").alias("url"), "published_at"
    )


def extract_product_cards(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "source_rank")) -> DataFrame:
    """The ``keep`` columns plus card_no, name, url, pricing_raw from product directory pages."""
    cards = raw_cards(pages.filter(F.col("extractor") == "product_cards"), list(keep))
    return cards.select(
        *keep, "card_no", F.col("title").alias("name"), F.col("href").alias("url"), F.col("extra").alias("pricing_raw")
    )


def extract_company_cards(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "source_rank")) -> DataFrame:
    """The ``keep`` columns plus card_no, name, href, url, employee_count from company directory pages."""
    cards = raw_cards(pages.filter(F.col("extractor") == "company_cards"), list(keep))
    return cards.select(
        *keep, "card_no", F.col("title").alias("name"), "href",
        absolute_url("href", F.lit(COMPANY_SITE[1])).alias("url"), employees("extra").alias("employee_count"),
    )


# Job rows carry their data as attributes and an embedded JSON record, so plain
# expressions can read them.
# A row may lack its end tag; it then ends at the next row or with its table.
TAG_BODY = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+"
JOB_ROW = rf"(?is)<tr\b{TAG_BODY}>.*?(?=</tr\b|<tr\b|</tbody\b|</table\b|\z)"
OPEN_TAG = rf"(?is)^<tr\b{TAG_BODY}>"
JSON_SCRIPT = r"(?is)<script\b[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"
JOB_RECORD = "title STRING, datePosted STRING"


QUOTES = (r"\"([^\"]*)\"", r"'([^']*)'", r"([^\s\"'=<>`]+)")


def _valued(name: str, value: str) -> str:
    """An attribute of a start tag that isn't inside another one's quotes."""
    return rf"(?is)^<\w+(?:\s+[^\s=>\"'/]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'=<>`]+))?)*?\s+{name}\s*=\s*{value}"


def _attribute(tag, name: str):
    """An attribute's value, in double, single or no quotes."""
    found = [F.regexp_extract(tag, _valued(name, quote), 1) for quote in QUOTES]
    return empty_to_null(unescape_entities(F.concat(*found)))


def extract_job_postings(
    pages: DataFrame,
    now,
    hours: int | None = FRESHNESS_HOURS,
    site_url="site_url",
    keep: tuple[str, ...] = ("page_id",),
) -> DataFrame:
    """Fresh job rows: the ``keep`` columns plus row_no, title, url, company, published_at.

    Rows are ``tr`` elements of class ``job`` with a ``data-id``. The posting
    date must be ISO text; relative wording is not read here.
    """
    base = F.col(site_url) if isinstance(site_url, str) else site_url
    rows = pages.select("*", F.posexplode(F.regexp_extract_all("html", F.lit(JOB_ROW), 0)).alias("row_no", "__row"))
    rows = pin(rows.drop("html"), "__tag", F.regexp_extract("__row", OPEN_TAG, 0))
    is_job = _attribute(F.col("__tag"), "class").rlike(r"(?i)(^|\s)job(\s|$)") & F.col("__tag").rlike(r"(?is)\sdata-id(\s|=|>)")
    read = pin(rows.filter(is_job), "__rec", F.from_json(F.regexp_extract("__row", JSON_SCRIPT, 1), JOB_RECORD))
    read = pin(read, "published_at", parse_iso(strip("__rec.datePosted"))).withColumn(
        "__href", _attribute(F.col("__tag"), "data-href")
    )
    return fresh_only(read, "published_at", now, hours).filter(
        (F.col("__rec.title") != "") & F.col("__href").isNotNull()
    ).select(
        *keep, "row_no", F.col("__rec.title").alias("title"), absolute_url("__href", base).alias("url"),
        _attribute(F.col("__tag"), "data-company").alias("company"), "published_at",
    )

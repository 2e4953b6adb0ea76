"""Rule-based labels: pricing model, role family, remote flag, company fallback."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityflow.functions.text import as_col, empty_to_null, strip

# Pricing words and role keywords, in their matching order.
PRICING_WORDS = {
    "free": "FREE",
    "freemium": "FREEMIUM",
    "paid": "PAID",
    "free trial": "PAID",
    "contact for pricing": "ENTERPRISE",
    "contact sales": "ENTERPRISE",
}
DEFAULT_PRICING = "PAID"

ROLE_KEYWORDS = {
    "ML Engineer": ["ml engineer", "machine learning engineer"],
    "Data Scientist": ["data scientist"],
    "Research Scientist": ["research scientist", "research engineer"],
    "AI Engineer": ["ai engineer", "artificial intelligence engineer"],
    "Software Engineer": ["software engineer", " swe "],
}
DEFAULT_ROLE = "Other"


def pricing_model(value) -> Column:
    """Pricing text to one of the four models; anything unknown, empty or null is PAID."""
    word = F.lower(strip(value))
    label = F.lit(DEFAULT_PRICING)
    for model in ("ENTERPRISE", "FREEMIUM", "FREE"):
        label = F.when(word.isin([w for w, m in PRICING_WORDS.items() if m == model]), model).otherwise(label)
    return label


def classify(value, rules: Mapping[str, Sequence[str]], default: str) -> Column:
    """First label any of whose keywords occurs in the text, which is lower-cased and padded."""
    padded = F.concat(F.lit(" "), F.lower(as_col(value)), F.lit(" "))
    chain = None
    for label, keywords in rules.items():
        hit = None
        for keyword in keywords:
            found = padded.contains(keyword)
            hit = found if hit is None else hit | found
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return F.lit(default) if chain is None else chain.otherwise(default)


def role_family(title) -> Column:
    return classify(title, ROLE_KEYWORDS, DEFAULT_ROLE)


def is_remote(title) -> Column:
    return F.lower(as_col(title)).contains("remote")


def company_or_site(company, site_name) -> Column:
    return F.coalesce(empty_to_null(company), as_col(site_name))

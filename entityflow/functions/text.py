"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What counts as a repository link, its owner/name part, and an employee figure.
REPO_URL = r"(?U)https?://github\.com/[\w.-]+/[\w.-]+"
REPO_PATH = r"(?U)github\.com/([\w.-]+/[\w.-]+)"
EMPLOYEES = r"(?i)([0-9,]+)\s+employees?"


def as_col(value) -> Column:
    """A column from a name or a column."""
    return F.col(value) if isinstance(value, str) else value


def empty_to_null(value) -> Column:
    return F.nullif(as_col(value), F.lit(""))


def strip(value) -> Column:
    """Remove white space of every kind at both ends (plain trim drops only blanks)."""
    return F.btrim(as_col(value), F.lit(WHITESPACE))


def clean_title(value) -> Column:
    """Stripped title on one line."""
    return F.replace(strip(value), F.lit("\n"), F.lit(" "))


def clean_array(values) -> Column:
    """Strip every element and drop the empty ones."""
    return F.filter(F.transform(as_col(values), strip), lambda x: x != "")


def collapse_whitespace(value) -> Column:
    """Three or more newlines become two; two or more blanks or tabs become one blank."""
    fewer_lines = F.regexp_replace(as_col(value), r"\n{3,}", "\n\n")
    return F.regexp_replace(fewer_lines, r"[ \t]{2,}", " ")


def employee_count(value) -> Column:
    """First '<digits> employee(s)' figure, or null."""
    digits = F.replace(F.regexp_extract(as_col(value), EMPLOYEES, 1), F.lit(","), F.lit(""))
    return digits.try_cast("int")


def first_repo_url(value) -> Column:
    """First repository link in a text; a dot ending the sentence stays part of it."""
    return empty_to_null(F.regexp_extract(as_col(value), REPO_URL, 0))


def repo_slug(value) -> Column:
    """'owner/repo' of a repository link, without a trailing '.git'."""
    return empty_to_null(F.regexp_replace(F.regexp_extract(as_col(value), REPO_PATH, 1), r"\.git$", ""))


# The named character references that occur in attributes.
NAMED = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "copy": "\u00a9", "reg": "\u00ae", "trade": "\u2122",
    "hellip": "\u2026", "ndash": "\u2013", "mdash": "\u2014", "lsquo": "\u2018", "rsquo": "\u2019", "ldquo": "\u201c", "rdquo": "\u201d",
    "laquo": "\u00ab", "raquo": "\u00bb", "bull": "\u2022", "middot": "\u00b7", "deg": "\u00b0", "euro": "\u20ac", "pound": "\u00a3",
    "yen": "\u00a5", "cent": "\u00a2", "sect": "\u00a7", "times": "\u00d7", "szlig": "\u00df", "auml": "\u00e4", "ouml": "\u00f6", "uuml": "\u00fc",
    "Auml": "\u00c4", "Ouml": "\u00d6", "Uuml": "\u00dc", "agrave": "\u00e0", "aacute": "\u00e1", "acirc": "\u00e2", "aring": "\u00e5",
    "aelig": "\u00e6", "ccedil": "\u00e7", "egrave": "\u00e8", "eacute": "\u00e9", "ecirc": "\u00ea", "euml": "\u00eb", "iacute": "\u00ed",
    "ntilde": "\u00f1", "oacute": "\u00f3", "ocirc": "\u00f4", "oslash": "\u00f8", "uacute": "\u00fa", "ucirc": "\u00fb",
}


def _character(code: Column) -> Column:
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")


def _reference(part: Column) -> Column:
    """What follows an ampersand, with the reference it starts with, if any, replaced."""
    name = F.regexp_extract(part, r"^([A-Za-z][A-Za-z0-9]*);", 1)
    known = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])[name]
    whole = r"^#(?:[xX][0-9a-fA-F]{1,7}|[0-9]{1,8});?"
    decimal = F.regexp_extract(part, r"^#([0-9]{1,8})", 1).try_cast("bigint")
    hexadecimal = F.conv(F.nullif(F.regexp_extract(part, r"^#[xX]([0-9a-fA-F]{1,7})", 1), F.lit("")), 16, 10).try_cast("bigint")
    return (
        F.when(part.rlike(whole), F.concat(_character(F.coalesce(hexadecimal, decimal)), F.regexp_replace(part, whole, "")))
        .when(known.isNotNull(), F.concat(known, F.substring(part, F.length(name) + 2, F.length(part))))
        .otherwise(F.concat(F.lit("&"), part))
    )


def unescape_entities(value) -> Column:
    """Numeric and common named character references, each undone once."""
    text = as_col(value)
    parts = F.split(text, "&", -1)
    rest = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), _reference)
    return F.when(text.contains("&"), F.concat(parts[0], F.array_join(rest, ""))).otherwise(text)


def build_prompt(chunk, schema_json: str) -> Column:
    """Batch-inference input: fixed instruction, the wanted schema, then the chunk."""
    # Fixed wording of the instruction.
    head = (
        "Extract structured data from the content below and return ONLY a single "
        "JSON object that strictly matches this JSON Schema -- no prose, no markdown "
        "code fences, just the raw JSON object.\n\n"
    )
    return F.concat(F.lit(f"{head}SCHEMA:\n{schema_json}\n\nCONTENT:\n"), as_col(chunk))

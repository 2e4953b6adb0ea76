"""Record types, their envelopes and their fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: schema version, record types, pricing set, row targets -----
SCHEMA_VERSION = "1.0"
STARTUP = "STARTUP"
PRODUCT = "PRODUCT"
RESEARCH_PAPER = "RESEARCH_PAPER"
JOB = "JOB"
NEWS = "NEWS"
RECORD_TYPES = [STARTUP, PRODUCT, RESEARCH_PAPER, JOB, NEWS]
PRICING_VALUES = ["FREE", "FREEMIUM", "PAID", "ENTERPRISE"]
ROW_TARGETS = {STARTUP: 1000, PRODUCT: 1000, RESEARCH_PAPER: 1000}
DEFAULT_TARGET = 1000
FRESHNESS_HOURS = 24
MAX_BODY_BYTES = 5_000_000
PAGE_SIZE = 100
PAGE_CAP = 2000
MAX_CHUNK_CHARS = 12_000


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


_S, _I, _B, _TS = T.StringType(), T.IntegerType(), T.BooleanType(), T.TimestampType()

SOURCE = _struct(name=_S, url=_S)

CONTENT = {
    STARTUP: _struct(entityName=_S, data=_struct(employeeCount=_I)),
    PRODUCT: _struct(startupName=_S, pricingModel=_S),
    RESEARCH_PAPER: _struct(
        title=_S, authors=T.ArrayType(_S), paper_url=_S, github_url=_S, github_stars=_I, published_date=_TS
    ),
    JOB: _struct(company=_S, date=_TS, is_remote=_B, role_family=_S),
    NEWS: _struct(headline=_S, url=_S, publishedAt=_TS, summary=_S),
}

# Content fields a record cannot be without.
REQUIRED = {
    STARTUP: ["entityName"],
    PRODUCT: ["startupName", "pricingModel"],
    RESEARCH_PAPER: ["title", "paper_url"],
    JOB: ["company", "date", "is_remote", "role_family"],
    NEWS: ["headline", "url", "publishedAt"],
}

# Papers and jobs carry no source in their envelope.
HAS_SOURCE = {STARTUP: True, PRODUCT: True, RESEARCH_PAPER: False, JOB: False, NEWS: True}

# The content field holding a company name, where there is one.
NAME_FIELD = {STARTUP: "entityName", PRODUCT: "startupName", JOB: "company"}

MAPPING_LOG = _struct(raw_name=_S, canonical_name=_S, match_score=T.DoubleType(), matched_seed=_B)


def envelope_schema(record_type: str) -> T.StructType:
    """Declared schema of one record type's envelope."""
    fields = [T.StructField("schemaVersion", _S), T.StructField("recordType", _S)]
    if HAS_SOURCE[record_type]:
        fields.append(T.StructField("source", SOURCE))
    fields += [T.StructField("content", CONTENT[record_type]), T.StructField("collectedAt", _TS)]
    return T.StructType(fields)

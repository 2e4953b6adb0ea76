"""Validation of stored model replies against a schema, and the first valid one per document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityflow.operators.pin import pin

# What each field type accepts, in lax mode:
#   string     JSON string only
#   integer    JSON integer or whole number, true/false, or a numeric string
#   double     JSON number, true/false, or a numeric string
#   boolean    true/false, 0/1, or one of the words below
#   timestamp  an ISO string
#   array      JSON array whose every element is accepted
#   struct     JSON object whose required fields are accepted
# Null is accepted where the field is optional. Extra keys are ignored.
TRUE_WORDS = ["1", "true", "t", "yes", "y", "on"]
FALSE_WORDS = ["0", "false", "f", "no", "n", "off"]


def _kind(node: Column) -> Column:
    """JSON type of a variant node: STRING, BIGINT, BOOLEAN, DECIMAL(..), DOUBLE, OBJECT<..>, ARRAY<..>, VOID."""
    return F.schema_of_variant(node)


def _text(node: Column) -> Column:
    return F.try_variant_get(node, "$", "string")


def _scalar(node: Column, dtype: T.DataType) -> Column:
    kind, text = _kind(node), _text(node)
    number = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    if isinstance(dtype, T.StringType):
        return F.when(kind == "STRING", text)
    if isinstance(dtype, T.BooleanType):
        word = F.lower(text)
        usable = kind.isin("BOOLEAN", "STRING") | number
        return F.when(usable & word.isin(TRUE_WORDS), True).when(usable & word.isin(FALSE_WORDS), False)
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        as_double = text.try_cast("double")
        whole = F.when(as_double == F.floor(as_double), as_double.try_cast(dtype))
        return (
            F.when(kind == "BOOLEAN", F.when(text == "true", 1).otherwise(0).cast(dtype))
            .when(kind == "STRING", F.when(F.trim(text).rlike(r"^[+-]?[0-9]+$"), F.trim(text).try_cast(dtype)))
            .when(kind == "BIGINT", text.try_cast(dtype))
            .when(number, whole)
        )
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0)).when(
            number | (kind == "STRING"), text.try_cast("double")
        )
    if isinstance(dtype, T.TimestampType):
        return F.when(kind == "STRING", F.try_to_timestamp(text))
    raise TypeError(f"no validation rule for {dtype.simpleString()}")


def _given(node: Column) -> Column:
    """Present and not JSON null."""
    return node.isNotNull() & ~F.coalesce(F.is_variant_null(node), F.lit(True))


def _read(node: Column, dtype: T.DataType) -> tuple[Column, Column]:
    """(value, ok) of one node that is given."""
    if isinstance(dtype, T.StructType):
        values, ok = [], _kind(node).startswith("OBJECT")
        for field in dtype.fields:
            child = F.try_variant_get(node, f"$.{field.name}", "variant")
            value, fine = _read(child, field.dataType)
            values.append(F.when(_given(child), value).alias(field.name))
            ok = ok & F.when(_given(child), fine).otherwise(F.lit(field.nullable))
        return F.struct(*values), ok
    if isinstance(dtype, T.ArrayType):
        nodes = F.try_variant_get(node, "$", "array<variant>")
        items = F.transform(nodes, lambda n: _read(n, dtype.elementType)[0])
        return items, nodes.isNotNull() & ~F.exists(items, lambda x: x.isNull())
    value = _scalar(node, dtype)
    return value, value.isNotNull()


def validate_json(
    df: DataFrame,
    schema: T.StructType,
    required: Sequence[str] | None = None,
    raw: str = "raw",
    enums: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Adds ``parsed`` (the typed fields, null when invalid) and ``is_valid``.

    ``required`` defaults to the schema's non-nullable fields; ``enums`` lists
    the allowed values of a field.
    """
    wanted = T.StructType([
        T.StructField(f.name, f.dataType, f.nullable if required is None else f.name not in required)
        for f in schema.fields
    ])
    parsed = pin(df, "__doc", F.try_parse_json(raw))
    value, ok = _read(F.col("__doc"), wanted)
    for field, allowed in (enums or {}).items():
        got = F.try_variant_get(F.col("__doc"), f"$.{field}", "string")
        ok = ok & (got.isNull() | got.isin(list(allowed)))
    checked = pin(parsed, "is_valid", F.coalesce(F.col("__doc").isNotNull() & ok, F.lit(False)))
    return checked.withColumn("parsed", F.when(F.col("is_valid"), value)).drop("__doc")


def first_valid(validated: DataFrame, doc: str = "doc_id", order: Sequence[str] = ("chunk_no", "provider_rank")) -> DataFrame:
    """First valid reply per document, by chunk and then provider; a document without one gives no row."""
    best = F.min_by(F.struct(*order, "parsed"), F.struct(*order))
    return (
        validated.filter("is_valid").groupBy(doc).agg(best.alias("b"))
        .select(doc, *[f"b.{c}" for c in order], "b.parsed.*")
    )

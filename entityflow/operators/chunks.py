"""Paragraph-aware text chunks and their prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityflow.functions.text import as_col, build_prompt, collapse_whitespace
from entityflow.operators.pin import pin
from entityflow.schemas import MAX_CHUNK_CHARS


def _pieces(para: Column, size: int) -> Column:
    """An over-long paragraph cut into pieces of ``size`` characters."""
    starts = F.sequence(F.lit(1), F.length(para), F.lit(size))
    return F.transform(starts, lambda at: F.substring(para, at, F.lit(size)))


def chunk_array(text, max_chars: int = MAX_CHUNK_CHARS) -> Column:
    """Chunks of at most ``max_chars`` characters as an array; white space is collapsed first.

    Paragraphs are packed greedily. One that does not fit closes the open
    chunk; one longer than the limit is cut. Empty text is one empty chunk.
    """
    return _packed(collapse_whitespace(text), max_chars)


def _packed(cleaned: Column, max_chars: int) -> Column:
    none = F.array().cast("array<string>")
    size = F.lit(max_chars)

    def state(done, open_):
        return F.struct(done.alias("done"), open_.alias("open"))

    def pack(acc, para):
        done, open_ = acc["done"], acc["open"]
        closed = F.when(open_ != "", F.concat(done, F.array(open_))).otherwise(done)
        return (
            F.when(
                F.length(open_) + F.length(para) + 2 > size,
                F.when(F.length(para) > size, state(F.concat(closed, _pieces(para, max_chars)), F.lit("")))
                .otherwise(state(closed, para)),
            )
            .when(open_ != "", state(done, F.concat(open_, F.lit("\n\n"), para)))
            .otherwise(state(done, para))
        )

    def finish(acc):
        return F.when(acc["open"] != "", F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"])

    packed = F.aggregate(F.split(cleaned, "\n\n"), state(none, F.lit("")), pack, finish)
    return F.when(F.length(cleaned) <= size, F.array(cleaned)).otherwise(packed)


def chunk_text(df: DataFrame, text: str = "text", max_chars: int = MAX_CHUNK_CHARS) -> DataFrame:
    """One row per chunk: the other columns, ``chunk_no`` from 0 and ``chunk``. No shuffle."""
    others = [c for c in df.columns if c != text]
    cleaned = pin(df, "__clean", collapse_whitespace(as_col(text)))
    return cleaned.select(*others, F.posexplode(_packed(F.col("__clean"), max_chars)).alias("chunk_no", "chunk"))


def with_prompt(chunks: DataFrame, schema_json: str) -> DataFrame:
    return chunks.withColumn("prompt", build_prompt("chunk", schema_json))

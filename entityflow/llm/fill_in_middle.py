"""Fill-in-middle transformation: texts cut into prefix, middle and suffix at token ends that a hash of the id picks."""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityflow.llm.common import id_and_text

SEED = 42
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Of a hundred texts, how many are rearranged, and of a hundred of those, how many with the suffix first.
SHARE, SUFFIX_FIRST_SHARE = 50, 80
# One word with the blanks before it, or the blanks at the end. What a unit has taken it never gives back, so that the
# match keeps no way back beside the units.
UNITS = regex.compile(r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+")


def cut(text: str, first: int, second: int) -> tuple[int, int, int]:
    """Number of units, and the offsets after the smaller and the larger of the two picks modulo that number plus one."""
    ends = UNITS.fullmatch(text).ends(1)
    n = len(ends)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    return n, ends[low - 1] if low else 0, ends[high - 1] if high else 0


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in ("n", "low", "high")]))
def _cuts(text: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    found = [cut(t.as_py(), a.as_py(), b.as_py()) for t, a, b in zip(text, first, second)]
    return pa.StructArray.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(3)], ["n", "low", "high"])


def picks(id_column: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers that the seed and the id as text decide; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, share: int = SHARE,
                   suffix_first_share: int = SUFFIX_FIRST_SHARE) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row: its units, how it was rearranged, and the new text.

    Form ``plain`` leaves the text as it is and has null lengths: texts that are empty or hold a marker, and the share
    that isn't rearranged. ``psm`` is prefix, suffix, middle, each behind its marker; ``spm`` begins with the suffix. The
    choice depends on seed and id alone, so reruns agree and rows that repeat an id are treated alike. Null texts are empty.
    One pass without a shuffle; the text stays in the JVM but for the match, which needs some 270 bytes per unit of one text.
    """
    h1, h2, h3, h4 = picks(F.col("id"), seed)
    rows = id_and_text(docs, id_col, text_col).select("id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("id", "text", _cuts("text", h1, h2).alias("cut"))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.length("text") == 0) | marked | (h3 % 100 >= share)
    form = F.when(plain, "plain").when(h4 % 100 < suffix_first_share, "spm").otherwise("psm")
    rows = rows.select("id", "text", "cut.*", form.alias("form"))
    low, high = F.col("low").cast("int"), F.col("high").cast("int")
    head = F.concat(F.lit(PREFIX), F.substring("text", F.lit(1), low))
    middle = F.concat(F.lit(MIDDLE), F.substring("text", low + 1, high - low))
    tail = F.concat(F.lit(SUFFIX), F.substring("text", high + 1, F.length("text") - high))
    output = F.when(F.col("form") == "psm", F.concat(head, tail, middle)).when(F.col("form") == "spm", F.concat(tail, head, middle)).otherwise(F.col("text"))
    moved = F.col("form") != "plain"
    return rows.select("id", "n", "form", F.when(moved, F.col("low")).alias("prefix_chars"),
                       F.when(moved, F.col("high") - F.col("low")).alias("middle_chars"), output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` rearranged.

    No marker is in the text and none can begin inside another one, so the first of each kind in the output is the one set there.
    """
    def parts(first, second):
        """What follows the first marker, the second and the last one."""
        after = F.substring(output, F.lit(len(first) + 1), F.length(output))
        one = F.substring_index(after, second, 1)
        rest = F.substring(after, F.length(one) + len(second) + 1, F.length(after))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substring(rest, F.length(two) + len(MIDDLE) + 1, F.length(rest))

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(SUFFIX, PREFIX)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)

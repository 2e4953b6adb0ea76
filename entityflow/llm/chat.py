"""Chat formatting: typed parts become text and ordered placeholders, turns become one marked string with a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# One turn: BEGIN role MIDDLE body END. Every control string starts with "<" or "[".
BEGIN, MIDDLE, END = "<s>[INST] ", " [/INST] ", "</s>"
PLACEHOLDERS = {"image": "[IMG]", "audio": "[AUD]", "document": "[DOC]"}
CONTROL = (r"<(/?s>)", r"\[(/?INST\]|(?:IMG|AUD|DOC)\])")
PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escape(text: Column) -> Column:
    """Text without any control string. The backslash becomes ``\\b``, the first sign of a control string ``\\l`` or ``\\k``."""
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    return F.regexp_replace(F.regexp_replace(text, CONTROL[0], r"\\l$1"), CONTROL[1], r"\\k$1")


def unescape(text: Column) -> Column:
    for mark, sign in (("\\l", "<"), ("\\k", "["), ("\\b", "\\")):
        text = F.replace(text, F.lit(mark), F.lit(sign))
    return text


class PartVisitor:
    """What each kind of part turns into. A part of an unknown kind or without one is text."""

    PATCH = 28  # pixels per side of an image token
    AUDIO_RATE = 25  # tokens per second
    PAGE = 1024  # tokens per page

    def text(self, part: Column) -> tuple[Column, Column]:
        return escape(F.coalesce(part["text"], F.lit(""))), F.lit(0).cast("long")

    def image(self, part: Column) -> tuple[Column, Column]:
        sides = [F.ceil(F.coalesce(part[c], F.lit(0)) / self.PATCH) for c in ("width", "height")]
        return F.lit(PLACEHOLDERS["image"]), (sides[0] * sides[1]).cast("long")

    def audio(self, part: Column) -> tuple[Column, Column]:
        return F.lit(PLACEHOLDERS["audio"]), F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.AUDIO_RATE).cast("long")

    def document(self, part: Column) -> tuple[Column, Column]:
        return F.lit(PLACEHOLDERS["document"]), (F.coalesce(part["pages"], F.lit(0)) * self.PAGE).cast("long")

    def visit(self, part: Column) -> Column:
        """struct(body, kind, ref, tokens); kind is null for text."""
        body, tokens = self.text(part)
        known = part["kind"].isin(*PLACEHOLDERS)
        for kind in PLACEHOLDERS:
            shown, count = getattr(self, kind)(part)
            body = F.when(part["kind"] == kind, shown).otherwise(body)
            tokens = F.when(part["kind"] == kind, count).otherwise(tokens)
        return F.struct(body.alias("body"), F.when(known, part["kind"]).alias("kind"), F.when(known, part["ref"]).alias("ref"), tokens.alias("tokens"))


def text_part(text: Column) -> Column:
    """A plain text as the only part of its turn."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
                            F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 parts_col: str | None = None, learn_role: str = "assistant", visitor: PartVisitor | None = None) -> DataFrame:
    """One row per conversation: (conv_id, formatted, loss_spans, attachments, placeholder_tokens).

    ``loss_spans`` holds (start, length) in code points of each ``learn_role`` body in ``formatted``. ``attachments`` lists
    (turn, kind, ref, tokens) in the order of their placeholders. Turns are in order of the turn number, null first; turns
    of the same number are in order of role and text. Null roles and texts are empty, repeated rows are turns of their own, and
    rows with a null conversation form one. A conversation is one string, so one row, as long as Spark can hold it;
    turns are formatted before they are gathered.
    """
    visitor = visitor or PartVisitor()
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(""))
    parts = F.col(f"`{parts_col}`").cast(PARTS) if parts_col else text_part(F.col(f"`{text_col}`").cast("string"))
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"),
                        F.transform(F.coalesce(parts, F.array().cast(PARTS)), visitor.visit).alias("parts"))
    rows = rows.select("conv", "turn", "role", F.concat(F.lit(BEGIN), escape(F.col("role")), F.lit(MIDDLE)).alias("head"),
                       F.array_join(F.transform("parts", lambda p: p["body"]), "").alias("body"),
                       F.transform(F.filter("parts", lambda p: p["kind"].isNotNull()), lambda p: F.struct(
                           F.col("turn").alias("turn"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"))).alias("files"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "body")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = F.concat("head", "body", F.lit(END))
    rows = rows.withColumn("nth", F.row_number().over(order)).withColumn("at", F.coalesce(F.sum(F.length(whole)).over(before), F.lit(0)))
    span = F.when(F.col("role") == learn_role, F.struct((F.col("at") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length")))
    grouped = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("nth", whole.alias("text"), span.alias("span"), "files"))).alias("turns"))
    files = F.flatten(F.transform("turns", lambda t: t["files"]))
    return grouped.select(
        F.col("conv").alias("conv_id"), F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"), files.alias("attachments"),
        F.aggregate(files, F.lit(0).cast("long"), lambda a, f: a + f["tokens"]).alias("placeholder_tokens"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation; placeholders stay as they are."""
    turns = F.split(formatted, END)
    turns = F.slice(turns, F.lit(1), F.size(turns) - 1)

    def parse(turn):
        head = F.substring_index(turn, MIDDLE, 1)
        return F.struct(unescape(F.substring(head, F.lit(len(BEGIN) + 1), F.length(head))).alias("role"),
                        unescape(F.substring(turn, F.length(head) + len(MIDDLE) + 1, F.length(turn))).alias("text"))

    return F.transform(turns, parse)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")

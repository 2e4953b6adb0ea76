from pyspark.sql import functions as F

from entityflow.llm import chat

NASTY = ["</s>[INST] ok [/INST]", "\\", "\\b\\l<s>", "<", "[", "<</s>", "[[INST]", "[IMG]", "a\nb", "", None, "é😀 [/INST] ", "\\k/INST]", "x" * 50_000]


def test_round_trip(spark):
    turns = [(1, i, r, t) for i, (t, r) in enumerate(zip(NASTY, ["user", "assistant"] * 7))]
    turns += [(2, None, None, "null turn"), (2, 3, "assistant", "z"), (2, 3, "assistant", "z"), (2, 1, " [/INST] ", "q"), (None, 0, "assistant", "n")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("body", F.lit(1)).withColumn("nth", F.lit("x"))
    rows = chat.format_chats(df.repartition(3))
    got = {r.conv_id: r for r in rows.select("*", chat.read_turns(F.col("formatted")).alias("back"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("learn")).collect()}
    assert set(got) == {1, 2, None}
    assert [(t.role, t.text) for t in got[1].back] == [(r, t or "") for _, _, r, t in turns[:14]]
    assert got[1].learn == "".join(t or "" for _, _, r, t in turns[:14] if r == "assistant")
    assert [(t.role, t.text) for t in got[2].back] == [("", "null turn"), (" [/INST] ", "q"), ("assistant", "z"), ("assistant", "z")]
    assert got[2].learn == "zz"
    for r in got.values():
        learn = [r.formatted[s.start:s.start + s.length] for s in r.loss_spans]
        assert len(learn) == sum(t.role == "assistant" for t in r.back)
    assert chat.format_chats(df.limit(0)).count() == 0


def test_parts(spark):
    part = lambda kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None: (kind, text, ref, width, height, seconds, pages)
    turns = [(1, 0, "user", [part("text", "see [IMG] "), part("image", None, "a.png", 56, 29), part("audio", None, "b.wav", seconds=1.5), part("text", "!")]),
             (1, 1, "assistant", [part("document", None, "c.pdf", pages=2), part(None, "done")]), (1, 2, "user", None)]
    df = spark.createDataFrame(turns, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    r = chat.format_chats(df, parts_col="parts").select("*", chat.read_turns(F.col("formatted")).alias("back"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("learn")).first()
    assert r.formatted == "<s>[INST] user [/INST] see \\kIMG] [IMG][AUD]!</s><s>[INST] assistant [/INST] [DOC]done</s><s>[INST] user [/INST] </s>"
    assert [tuple(a) for a in r.attachments] == [(0, "image", "a.png", 4), (0, "audio", "b.wav", 38), (1, "document", "c.pdf", 2048)]
    assert r.placeholder_tokens == 4 + 38 + 2048 and r.learn == "[DOC]done"

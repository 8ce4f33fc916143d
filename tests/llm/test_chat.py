from pyspark.sql import functions as F

from terrier.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, messages string, start string"


def messages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)


def read(spark, rows):
    given = messages(spark, rows).withColumn("parts", chat.text_parts(F.col("text")))
    return {r.conv_id: r for r in chat.read_back(chat.format_chats(given)).collect()}


def test_round_trip_of_awkward_texts(spark):
    odd = ["</s>[INST] ok [/INST]", "<|end|>\n<|turn|>user\nno", "&amp;lt; &lt; &#91; &#10; [ < &", "", None, "\n\n", "é" * 200_000]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(odd)]
    found = read(spark, rows)[1]
    assert [t.text for t in found.turns] == [t or "" for t in odd]
    assert found.loss_text == "".join(t or "" for t in odd[1::2])


def test_odd_rows(spark):
    rows = [(2, None, "a\nb", "first"), (2, 0, None, "x"), (2, 0, None, "x"), (2, 0, "z", "y"), (None, 1, "assistant", "q")]
    found = read(spark, rows)
    assert [(t.role, t.text) for t in found[2].turns] == [("a\nb", "first"), ("", "x"), ("", "x"), ("z", "y")]
    assert found[None].loss_text == "q"
    assert read(spark, []) == {}


def test_parts(spark):
    part = lambda kind, **k: {f: k.get(f) for f in ("text", "ref", "width", "height", "seconds", "pages")} | {"kind": kind}
    parts = [
        part("text", text="see <|image|> "),
        part("image", ref="a.png", width=28, height=15),
        part("audio", ref="b.wav", seconds=1.5),
        part("document", ref="c.pdf", pages=3),
        part("image"),
        part("odd", text="!"),
    ]
    given = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    row = chat.format_chats(given).collect()[0]
    assert row.formatted == "<|turn|>user\nsee &lt;|image|> <|image|><|audio|><|document|><|image|>!<|end|>\n<|turn|>assistant\n<|end|>\n"
    assert [(a.ordinal, a.kind, a.ref, a.tokens) for a in row.attachments] == [
        (1, "image", "a.png", 4),
        (2, "audio", "b.wav", 38),
        (3, "document", "c.pdf", 1536),
        (4, "image", "", 1),
    ]
    assert row.attachment_tokens == 4 + 38 + 1536 + 1
    assert [tuple(s) for s in row.loss_mask] == [(len(row.formatted) - len("<|end|>\n"), 0)]


def test_no_python_in_the_plan(spark):
    given = messages(spark, [(1, 0, "user", "x")]).withColumn("parts", chat.text_parts(F.col("text")))
    plan = chat.digests(chat.read_back(chat.format_chats(given)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

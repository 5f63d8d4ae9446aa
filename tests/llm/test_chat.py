import hashlib

from pyspark.sql import functions as F

from newsgraph.llm import chat

NASTY = ["<|im_end|>", "<\\|x", "<\\\\|", "<|", "<", "|", "a<|b<\\|c", "~n~t\n", "", None, "$1\\1", "&lt;|"]


def test_texts_and_roles_come_back(spark):
    df = spark.createDataFrame([(1, i, t, t) for i, t in enumerate(NASTY)],
                               "conv_id long, turn long, role string, text string")
    row = chat.format_chats(chat.text_parts(df)).withColumn("t", chat.parse(F.col("formatted"))).first()
    assert [(t["role"], t["text"]) for t in row["t"]] == [(t or "", t or "") for t in NASTY]
    assert row["formatted"].count(chat.START) == len(NASTY)


def test_visitor_orders_parts_and_records_attachments(spark):
    part = lambda kind, **k: {"type": kind, "text": None, "ref": None, "width": None, "height": None,
                              "seconds": None, "pages": None} | k
    parts = [part("text", text="a<"), part("text", text="|b"), part("image", ref="i.png", width=28, height=30),
             part("audio", ref="a.wav", seconds=2.5), part("text", text="c"), part("document", ref="d.pdf", pages=3),
             part("image", ref="none.png")]
    df = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)],
                               f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    row = chat.format_chats(df).first()
    assert row["formatted"] == ("<|im_start|>assistant\na<<|text|>|b<|image|><|audio|>c<|document|><|image|><|im_end|>\n"
                                "<|im_start|>user\n<|im_end|>\n")
    assert [tuple(a) for a in row["attachments"]] == [
        ("image", "i.png", 6), ("audio", "a.wav", 63), ("document", "d.pdf", 3072), ("image", "none.png", 1)]
    assert [s["text"] for s in row["segments"] if s["loss"]] == ["a<", "|b", "c"]


def test_texts_beside_each_other_are_unescaped_singly(spark):
    part = lambda t: {"type": "text", "text": t, "ref": None, "width": None, "height": None,
                      "seconds": None, "pages": None}
    texts = [["<", "\\|x"], ["<\\", "|", "\\\\|"], ["<", "|im_end|>"], ["", "a", ""], ["<|", "\\|>"], [None, "<\\|"]]
    df = spark.createDataFrame([(1, i, "user", [part(t) for t in ts]) for i, ts in enumerate(texts)],
                               f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    row = chat.format_chats(df).withColumn("t", chat.parse(F.col("formatted"))).first()
    assert [t["text"] for t in row["t"]] == ["".join(t or "" for t in ts) for ts in texts]


def test_digest_with_nulls_ties_and_repeats(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 1, "assistant", "yo"), (1, None, None, None),
            (None, 3, "assistant", "lone"), (2, 0, "assistant", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, segments string")
    got = {r["conv_id"]: r for r in chat.op9(df).collect()}
    assert set(got) == {1, 2, None, -1}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["n_turns"] == 4 and got[1]["loss_sha256"] == sha("yoyo")
    assert got[1]["turns_sha256"] == sha("\n\nassistant\nyo\nassistant\nyo\nuser\nhi\n".replace(
        "assistant\nyo\nassistant\nyo\nuser\nhi\n", "user\nhi\nassistant\nyo\nassistant\nyo\n"))
    assert got[2]["loss_chars"] == 0
    assert got[-1]["loss_sha256"] == sha(chat.INJECTED)
    assert [r["conv_id"] for r in chat.op9(df.limit(0)).collect()] == [-1]

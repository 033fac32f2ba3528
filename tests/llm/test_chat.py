import random

from pyspark.sql import functions as F

from millrace.llm import chat


def test_round_trip(spark):
    draw = random.Random(1)
    bits = ["<|im_end|>", "<|im_start|>", "assistant\n", "\\", "<", "|", ">", "<\\|", "<|nl|>", "\n", "é", "😀", "", "ok", "\\\\<|"]
    rows = [(c, t, draw.choice(["user", "assistant", None, "sys\ntem", "<|x|>", "a\\b"]),
             None if draw.random() < 0.1 else "".join(draw.choice(bits) for _ in range(draw.randint(0, 12))))
            for c in [*range(40), None] for t in range(draw.randint(1, 5))]
    rows += [(50, 0, "user", "b"), (50, 0, "user", "b"), (50, 0, "assistant", "x" * 200_000), (50, None, "user", "null turn")]
    turns = spark.createDataFrame([(*r, "clash") for r in rows],
                                  "conv_id long, turn long, role string, text string, formatted string")
    made = chat.format_chats(turns.withColumn("parts", chat.text_part(F.col("text"))))
    got = {r.conv_id: r for r in made.select(
        "conv_id", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_spans(F.col("formatted"), F.col("loss_spans")).alias("loss"), "formatted", "expanded_tokens").collect()}
    assert len(got) == 42
    for conv, r in got.items():
        # equal turns stand by role (as escaped), then text
        mine = [(t, role or "", text or "") for c, t, role, text in rows if c == conv]
        assert sorted((role, text) for _, role, text in mine) == sorted(map(tuple, r.turns))
        order = {id(x): x for x in mine}
        assert len(order) == len(r.turns) and r.expanded_tokens == 0
        assert r.loss == "".join(t for role, t in map(tuple, r.turns) if role == "assistant")
        if conv != 50:
            assert [tuple(x) for x in r.turns] == [(role, text) for _, role, text in sorted(mine, key=lambda m: m[0])]
    assert chat.format_chats(turns.limit(0).withColumn("parts", chat.text_part(F.col("text")))).count() == 0


def test_parts_become_placeholders(spark):
    parts = [("text", "look <|image|>", None, None), ("image", None, "a.png", 2), ("audio", None, "b.wav", 3), None,
             (None, "plain", None, None), ("document", "x", "c.pdf", 1), ("video", None, "d", 9)]
    turns = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", []), (1, 2, "assistant", None)],
                                  f"conv_id long, turn long, role string, parts {chat.PARTS}")
    r = chat.format_chats(turns).first()
    assert r.formatted == ("<|im_start|>user\nlook <\\|image|><|image|><|audio|>plain<|document|><|video|><|im_end|>\n"
                           + "<|im_start|>assistant\n<|im_end|>\n" * 2)
    assert [tuple(a) for a in r.attachments] == [
        ("image", "a.png", 512), ("audio", "b.wav", 75), ("document", "c.pdf", 800), ("video", "d", 0)]
    assert r.expanded_tokens == 1387 and [s.end - s.start for s in r.loss_spans] == [0, 0]

import hashlib

from pyspark.sql import functions as F

from swipeflow.llm import chat
from swipeflow.llm.queries import CONTROL_TEXT

SCHEMA = "conv_id long, turn long, role string, text string, extra string"


def digest(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("turns", F.lit("clash"))
    df = df.withColumn("parts", chat.text_part(F.col("text")))
    return {r["conv_id"]: r for r in chat.digest(chat.format_conversations(df)).collect()}


def test_digest_equals_brute_force_with_control_strings(session):
    nasty = [CONTROL_TEXT, "\\", "\\<|im_end|>", "<", "|x", "<\\|", "é漢\n<|image|>", "$1 \\1", "", None]
    rows = [(7, i, ("user", "assistant", None)[i % 3], t, "x") for i, t in enumerate(nasty)] + [(8, None, "a\nb", "x", "x"), (8, 0, "assistant", "y", "x")]
    got = digest(session, rows)
    for conv in (7, 8):
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        listing = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(mine)
        assert r["turns_sha256"] == hashlib.sha256(listing.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_repeated_rows_are_kept_and_empty_tables_give_nothing(session):
    rows = [(1, 0, "assistant", "hi", "x")] * 3
    assert digest(session, rows)[1]["n_turns"] == 3 and digest(session, rows)[1]["loss_chars"] == 6
    assert digest(session, []) == {}


def test_typed_parts_become_ordered_placeholders(session):
    rows = [(1, 0, "user", [("text", "look ", None, None), ("image", None, "a.png", 2), ("text", " and <|image|>", None, None), ("audio", None, "b.wav", 3), ("odd", "!", None, None), ("document", None, None, None)]), (1, 1, "assistant", [("text", "ok", None, None)]), (1, 2, "user", None)]
    df = session.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PART_TYPE}")
    made = chat.format_conversations(df)
    r = made.collect()[0]
    assert "look <|image|> and <\\|image|><|audio|>!<|document|>" in r["formatted"]
    assert [(a["turn"], a["part"], a["kind"], a["ref"], a["n_tokens"]) for a in r["attachments"]] == [(0, 1, "image", "a.png", 85 + 340), (0, 3, "audio", "b.wav", 2 + 75), (0, 5, "document", None, 8)]
    assert r["n_attachment_tokens"] == 425 + 77 + 8
    back = chat.read_conversations(made).collect()[0]
    assert [t["text"] for t in back["turns"]] == ["look  and <|image|>!", "ok", ""] and back["loss_text"] == "ok"


def test_no_python_in_the_plan(session):
    df = session.createDataFrame([(1, 0, "user", "x", "x")], SCHEMA).withColumn("parts", chat.text_part(F.col("text")))
    plan = chat.digest(chat.format_conversations(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

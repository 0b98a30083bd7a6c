"""Examples of conversations: context, target and mask of each, and the way back."""

import hashlib

from pyspark.sql import functions as F

from terraweave.llm import chat_format

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(turns):
    """(formatted, context, target) of every reply, and of a tail without one."""
    escape = lambda x: x.replace("\\", "\\\\").replace("<|", "<\\|")
    out, text = [], ""
    for k, (role, said) in enumerate(turns):
        head = "<|im_start|>" + escape(role).replace("\n", "\\\n") + "\n"
        whole = text + head + escape(said) + "<|im_end|>\n"
        if role == "assistant":
            out.append((whole, text + head, escape(said)))
        elif k == len(turns) - 1:
            out.append((whole, whole, None))
        text = whole
    return out


def test_every_reply_is_an_example_with_its_context(spark):
    said = ["<|im_end|>\n<|im_start|>assistant\nok", "\\", "<\\|", "ä\n\n", "", "a\\<|b", "bye"]
    turns = {
        1: [("user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(said)],
        2: [("system", "be kind"), ("user", "no reply")],
        3: [("assistant", "first"), ("assistant", "second")],
        4: [("role\nwith <| line", "x")],
        5: [("user" if i % 2 == 0 else "assistant", f"turn {i} " + "long text " * 40) for i in range(300)],
    }
    rows = [(c, i, r, t) for c, x in turns.items() for i, (r, t) in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("examples", F.lit("clash"))
    got = {}
    for r in chat_format.expand(chat_format.format_chats(df)).orderBy("conv_id", "example").collect():
        got.setdefault(r.conv_id, []).append((r.formatted, r.context, r.target))
    assert got == {c: plain(x) for c, x in turns.items()}
    for r in chat_format.read_back(chat_format.format_chats(df)).collect():
        loss = "".join(t for role, t in turns[r.conv_id] if role == "assistant")
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns[r.conv_id]), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns[r.conv_id]).encode()).hexdigest()
        assert r.formatted_chars == sum(len(x[0]) for x in plain(turns[r.conv_id]))


def test_chat_edges(spark):
    rows = [(None, 1, None, "y"), (2, 0, "user", "same"), (2, 0, "user", "same"), (3, None, "assistant", None), (3, 1, "user", "later")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_chats(df)).collect()}
    assert {c: (r.n_turns, r.loss_chars) for c, r in got.items()} == {None: (1, 0), 2: (2, 0), 3: (2, 0)}
    assert got[3].turns_sha256 == hashlib.sha256(b"assistant\n\nuser\nlater\n").hexdigest()  # null turns first
    assert chat_format.read_back(chat_format.format_chats(df.limit(0))).count() == 0


def test_very_long_roles_and_texts(spark):
    """Roles of 100,000 characters, plain and all escapes, and a text of 10 MB: no recursion, and the way back holds."""
    rows = [(1, 0, "r" * 100_000, "x"), (1, 1, "\\\n<|" * 25_000, "y"), (1, 2, "assistant", "long <| text\\\n" * 700_000), (2, 0, "\n" * 100_000, "\n")]
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_chats(spark.createDataFrame(rows, SCHEMA))).collect()}
    for conv in (1, 2):
        said = "".join(f"{role}\n{text}\n" for c, _, role, text in rows if c == conv)
        assert got[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256(rows[2][3].encode()).hexdigest()

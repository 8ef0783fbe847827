"""Chat formatting: exact round trip, loss mask, order of roles."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandmill.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"
T = chat.Template()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    convs = {}
    last = lambda v: (v is None, v or 0)
    for conv, turn, role, text in sorted(rows, key=lambda r: (last(r[1]), r[2] or "", r[3] or "")):
        convs.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"seg": F.lit("x"), "loss": F.lit(1)})
    segments = chat.format_chats(df)
    got = {
        r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
        for r in chat.read_back(segments).collect()
    }
    assert got == brute(rows)
    return segments


hard = st.text(alphabet="\\#</turn> :\nuser😀aA", max_size=40)


@settings(max_examples=500, deadline=None)
@given(hard, hard)
def test_any_turn_reads_back(role, text):
    formatted = "".join(s for s, _ in T.segments(role, text))
    assert T.read_turn(formatted) == (role, text)
    # Only the template's own markers are left unescaped.
    body = T.escaped(text)
    assert T.unescaped(body) == text and not body.startswith("###") and not body.startswith("</turn>")


def test_cases(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, "user", "### user: </turn>\n"),
        (1, 3, "assistant", "\\"), (2, 0, "assistant", "first"), (2, 1, "assistant", "first"),
        (2, 1, "assistant", "first"), (3, None, "user", "late"), (3, 5, "system", ""),
        (None, 1, None, None), (None, 0, "tool: x", "y"), (4, 0, "user", "a" * 200_000),
        (4, 1, "assistant", "#" * 100_000), (5, 0, "user", queries.CONTROL_TEXT),
    ]
    segments = check(spark, rows)
    bad = {(r.conv_id, r.nth) for r in segments.where("not in_order").collect()}
    assert bad == {(2, 0), (2, 1), (2, 2), (None, 0), (None, 1)}


def test_conversations(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    check(spark, rows)


def test_query_adds_the_control_conversation(spark, sf):
    got = {r.conv_id: r for r in queries.op2_chat(spark, sf).collect()}
    text = queries.CONTROL_TEXT
    assert got[-7].turns_sha256 == sha(f"user\n{text}\nassistant\n{text}\n")
    assert (got[-7].loss_chars, got[-7].loss_sha256) == (len(text), sha(text))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.format_chats(empty)).count() == 0


def test_one_hot_conversation_is_streamed(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(25_000)]
    check(spark, rows)

"""Prefix-target expansion of conversations."""

import hashlib

from hypothesis import given, settings, strategies as st

from tidewell.llm import chat

TURNS = "conv_id long, turn long, role string, text string, example string"
ROWS = [
    (1, 0, "user", "hi", "x"), (1, 1, "assistant", "yo </s>", "x"), (1, 2, "user", "<turn user>", "x"), (1, 3, "assistant", None, "x"),
    (1, 4, "user", "bye", "x"), (2, 0, None, "", "x"), (3, 5, "assistant", "\\[INST\\]", "x"), (3, 5, "assistant", "\\[INST\\]", "x"),
    (None, None, "assistant", "é🙂", "x"), (4, 0, "a>b\nc", "t" * 50_000, "x"), (4, None, "assistant", "first", "x"),
]


def by_hand(rows):
    convs = {}
    for conv, turn, role, text, _ in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in convs.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        upto = formatted = 0
        for k, (r, t) in enumerate(turns):
            upto += len(chat.format_turn(r, t))
            formatted += upto if r == "assistant" or k == len(turns) - 1 else 0
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        out.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(), formatted))
    return sorted(out, key=str)


def test_digests_equal_those_by_hand(spark):
    turns = spark.createDataFrame(ROWS, TURNS).repartition(4)
    assert sorted(map(tuple, chat.digests(chat.expand(turns)).collect()), key=str) == by_hand(ROWS)


def test_every_reply_is_an_example_with_all_turns_before_it(spark):
    rows = sorted(chat.expand(spark.createDataFrame(ROWS, TURNS)).where("conv_id = 1").collect(), key=lambda r: r["example"])
    assert [r["n_turns"] for r in rows] == [2, 4, 5]
    spans = [None if r["loss_start"] is None else r["text"][r["loss_start"] : r["loss_end"]] for r in rows]
    assert [s if s is None else chat.unescape(s) for s in spans] == ["yo </s>", "", None]
    assert chat.read_turns(rows[-1]["text"]) == [
        ("user", "hi"), ("assistant", "yo </s>"), ("user", "<turn user>"), ("assistant", ""), ("user", "bye")
    ]
    assert rows[2]["text"].startswith(rows[1]["text"]) and rows[1]["text"].startswith(rows[0]["text"])


def test_a_long_conversation_streams(spark):
    rows = [(9, k, "assistant" if k % 2 else "user", f"turn {k} " + "x" * 300, "x") for k in range(300)]
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    assert sorted(map(tuple, chat.digests(chat.expand(turns)).collect())) == by_hand(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], TURNS)
    assert chat.expand(none).count() == 0 and chat.digests(chat.expand(none)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(*[st.text(st.sampled_from("<>[]\\/turn \nINSTés|"), max_size=12)] * 2), max_size=4))
def test_round_trip(turns):
    text = "".join(chat.format_turn(r, t) for r, t in turns)
    assert chat.read_turns(text) == turns
    for _, t in turns:
        held = chat.escape(t)
        assert not any(mark in held for mark in ("</s>", "[INST]", "[/INST]", "</turn>", "<turn user>"))

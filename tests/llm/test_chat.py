import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseframe.llm import chat

MARKS = st.lists(st.sampled_from(["\\", "#", "###", "### ", ":", ": ", " ", "</turn>", " </turn>\n", "\n", "a", "é", "😀", "assistant"]), max_size=12).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(MARKS, MARKS), max_size=5))
def test_escapes_round_trip(turns):
    formatted = "".join(chat.HEAD + chat.escaped_role(r) + chat.MIDDLE + chat.escaped(t) + chat.END for r, t in turns)
    assert chat.read_pieces(formatted) == turns


@pytest.mark.parametrize("record, layout, turns", [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, "messages", [("user", "q"), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]}, "conversations", [("user", "q"), ("assistant", "")]),
    ({"prompt": "q", "completion": "a", "score": 3, "meta": {"x": [1]}}, "prompt", [("user", "q"), ("assistant", "a")]),
    ({"system": "s", "prompt": "q", "response": "a"}, "response", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"instruction": "i", "input": "", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "x", "output": "o"}, "instruction", [("user", "i"), ("user", "x"), ("assistant", "o")]),
    ({"question": "q", "answer": "a"}, "question", [("user", "q"), ("assistant", "a")]),
    # A turn row's role is the contract's role and stands as it is; only lists of turns have names of their own.
    ({"turn": 4, "role": "bot", "text": "t"}, "turn row", [("bot", "t")]),
    ({"messages": [{"role": "model", "content": "a"}, {"role": "tool", "content": "b"}]}, "messages", [("assistant", "a"), ("tool", "b")]),
    ({"nothing": 1}, "unknown", []), ([], "unknown", []), (None, "unknown", []), ({"messages": []}, "unknown", []),
])
def test_layouts(record, layout, turns):
    assert chat.turns_of(record) == (layout, turns)


def test_fingerprints_are_distinct():
    assert len(chat.BY_FINGERPRINT) == len({chat.schema_fingerprint(p) for m in chat.MAPPINGS for p in [chat._paths_of(m)[0]]}) + sum(
        2 ** len(chat._paths_of(m)[1]) - 1 for m in chat.MAPPINGS)


def test_digests_read_back(spark):
    said = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said), (1, 2, "assistant", "b\\"), (1, 1, "user", None), (1, 2, "assistant", "a"),
            (2, None, None, "x"), (3, 1, "assistant", "é😀" * 50_000), (None, 1, "user", "null conversation")]
    rows += [(4, i, ("user", "assistant")[i % 2], f"turn {i} ### : \n") for i in range(2500)]
    docs = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING")
    record = F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"})
    turns = chat.canonical_turns(docs.select("conv_id", "turn", record.alias("record")))
    assert turns.filter("layout = 'unknown'").count() == 0
    got = {r["conv_id"]: r for r in chat.conversation_digests(chat.format_turns(turns).repartition(5)).collect()}
    assert len(got) == 6
    for conv_id, r in got.items():
        own = sorted(((t is not None, t or 0, chat.escaped(x or ""), ro or "", x or "") for c, t, ro, x in rows if c == conv_id))
        said = "".join(f"{ro}\n{x}\n" for *_, ro, x in own)
        loss = "".join(x for *_, ro, x in own if ro == "assistant")
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (
            len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    bad = spark.createDataFrame([(9, 1, "{"), (9, 2, None), (9, 3, json.dumps({"prompt": "p", "completion": "c"}))], "conv_id LONG, turn LONG, record STRING")
    assert sorted((r["turn"], r["layout"]) for r in chat.canonical_turns(bad).collect()) == [(1, "unknown"), (2, "unknown"), (3, "prompt"), (3, "prompt")]
    assert chat.conversation_digests(chat.format_turns(turns.limit(0))).count() == 0


@pytest.mark.parametrize("record, layout, turns", [
    ({"instruction": "i", "input": "x", "output": "o", "text": "i x o"}, "instruction", [("user", "i"), ("user", "x"), ("assistant", "o")]),
    ({"prompt": "q", "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, "messages", [("user", "q"), ("assistant", "a")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "q"}, {"type": "image", "url": "u"}]}, {"role": "assistant", "content": "a"}]},
     "messages", [("user", 'q{"type": "image", "url": "u"}'), ("assistant", "a")]),
    ({"messages": [{"role": "user", "content": "q"}, 3]}, "unknown", []),
])
def test_fields_of_other_layouts_do_no_harm(record, layout, turns):
    assert chat.turns_of(record) == (layout, turns)


def test_unknown_records_are_rows(spark):
    rows = [(1, 1, json.dumps({"prompt": "p", "completion": "c"})), (1, 2, "{"), (2, 1, json.dumps({"x": 1}))]
    formatted = chat.format_turns(chat.canonical_turns(spark.createDataFrame(rows, "conv_id LONG, turn LONG, record STRING")))
    assert sorted((r["conv_id"], r["turn"], r["formatted"] is None) for r in formatted.collect()) == [(1, 1, False), (1, 1, False), (1, 2, True), (2, 1, True)]
    assert sorted((r["conv_id"], r["n_turns"]) for r in chat.conversation_digests(formatted).collect()) == [(1, 2), (2, 0)]

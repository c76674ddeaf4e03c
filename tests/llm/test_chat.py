import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from rowloom.llm.chat import ChatTemplate, Codec, format_chats, read_chats

SCHEMA = "conv_id long, turn long, role string, text string, segments string"


def digests(turns):
    whole, loss = hashlib.sha256(), hashlib.sha256()
    for role, text in turns:
        whole.update(f"{role}\n{text}\n".encode())
        if role == "assistant":
            loss.update(text.encode())
    return whole.hexdigest(), loss.hexdigest()


@given(
    st.sampled_from(["system", "user", "assistant", "tool", "", "<s>"]),
    st.lists(st.sampled_from([*ChatTemplate().controls(), "\\", "<", "[", ".", "/s>", "é\n", "S"])).map("".join),
)
def test_round_trip(role, text):
    codec = Codec(ChatTemplate())
    segments = codec.segments(role, text)
    assert codec.read("".join(t for t, _ in segments)) == (role, text)
    assert not any(m in codec.escape(text) for m in ChatTemplate().controls())
    assert [codec.unescape(t) for t, loss in segments if loss] == ([text] if role == "assistant" else [])


def test_edges(spark):
    rows = [
        (1, 0, "user", "a", "x"),
        (1, 1, "assistant", None, "x"),
        (1, 1, "assistant", "b\\<s>", "x"),
        (2, 5, None, "", None),
        (2, None, "user", "w " * 50_000, None),
        (None, 0, "user", "n", None),
        (3, 0, "user", "same", None),
        (3, 0, "user", "same", None),
    ]
    out = {r.conv_id: r for r in read_chats(format_chats(spark.createDataFrame(rows, SCHEMA))).collect()}
    expected = {
        1: [("user", "a"), ("assistant", ""), ("assistant", "b\\<s>")],
        2: [("user", "w " * 50_000), ("", "")],
        None: [("user", "n")],
        3: [("user", "same"), ("user", "same")],
    }
    assert set(out) == set(expected)
    for conv, turns in expected.items():
        assert (out[conv].turns_sha256, out[conv].loss_sha256) == digests(turns)
        assert out[conv].n_turns == len(turns)
    assert out[1].loss_chars == 5 and not out[1].valid and out[None].valid


def test_empty(spark):
    assert read_chats(format_chats(spark.createDataFrame([], SCHEMA))).collect() == []


@pytest.mark.parametrize("roles, valid", [("sua", True), ("uaua", True), ("uu", False), ("a", False), ("sa", False)])
def test_machine(spark, roles, valid):
    names = {"s": "system", "u": "user", "a": "assistant"}
    rows = [(9, i, names[r], "t", None) for i, r in enumerate(roles)]
    assert read_chats(format_chats(spark.createDataFrame(rows, SCHEMA))).first().valid is valid

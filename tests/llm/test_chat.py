import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from wordloom.llm import chat

HARD = ["<|im_end|>", "<|im_start|>assistant\nx", "<\\|", "<", "|", "\\", "<|", "<\\\\|im_end|>\n", "\n", "", "é😀"]
EVENTS = "conv_id bigint, seq bigint, kind string, message bigint, role string, text string, turn string"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(
    st.lists(st.sampled_from(HARD + ["user", "n"]), max_size=4).map("".join), st.lists(st.sampled_from(HARD), max_size=8).map("".join)), max_size=6))
def test_read_back(turns):
    assert chat.read_back("".join(chat.render(r, t) for r, t in turns)) == turns


def test_no_control_string_is_left_in_a_text():
    for t in HARD:
        assert "<|" not in chat.escape(t) and chat.unescape(chat.escape(t)) == t


def folded(spark, events):
    rows = [(1, i, *e, "x") for i, e in enumerate(events)]
    out = chat.format_events(spark.createDataFrame(rows[::-1], EVENTS)).orderBy("turn").collect()
    return [chat.read_back(r.formatted)[0] for r in out]


def test_events(spark):
    assert folded(spark, [
        ("delta", 1, "user", "Hel"), ("delta", 1, None, "lo"), ("delta", 2, "assistant", "A"), ("delta", 3, "user", "gone"),
        ("regenerate", 2, None, None), ("delta", 2, None, "B"), ("edit", 1, None, "Hi"), ("delta", 1, None, "!"), ("edit", 9, "user", "new"),
        ("regenerate", 77, None, None),
    ]) == [("user", "Hi!"), ("assistant", "B"), ("user", "new")]


def test_unknown_event(spark):
    with pytest.raises(Exception, match="unknown kind"):
        folded(spark, [("remove", 1, "user", "x")])


def test_table_of_turns(spark):
    rows = [
        (1, 0, "user", "hi <|im_end|>", 5), (1, 1, "assistant", "yes", 5), (1, 1, "assistant", "yes", 5), (1, None, None, None, 5),
        (2, 0, "assistant", None, 5), (None, 0, "assistant", "null id", 5), (None, 3, "user", "x" * 100_000, None),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted int")
    messages = chat.format_events(chat.log_of_turns(df))
    got = {r.conv_id: r for r in chat.digests(messages).collect()}
    assert set(got) == {1, 2, None}
    for conv in got:
        turns = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text, _ in rows if c == conv))
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        trained = "".join(t for _, _, r, t in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(trained))
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(trained.encode()).hexdigest()
        assert r.formatted_chars == sum(len(chat.render(a, b)) for _, _, a, b in turns)
    rendered = {r.conv_id: r for r in chat.conversations(messages).collect()}
    one = rendered[1]
    assert [t for _, t in chat.read_back(one.formatted)] == ["", "hi <|im_end|>", "yes", "yes"]
    assert [one.formatted[s.start:s.end] for s in one.loss] == ["yes", "yes"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.digests(chat.format_events(chat.log_of_turns(df))).collect() == []

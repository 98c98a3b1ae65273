import hashlib
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from gleanery.llm import chat, queries

MESSAGES = "tree long, id long, parent long, role string, text string, score double"


@given(st.lists(st.tuples(st.text(alphabet="\\<turn>/# :\nab"), st.text(alphabet="\\<turn>/# :\nab")), max_size=5))
def test_any_turns_can_be_read_back(turns):
    text, spans = chat.formatted(turns)
    assert chat.read_back(text) == turns
    said = [body for role, body in turns if role == "assistant"]
    assert [chat.unescaped(text[a:b]) for a, b in spans] == said


def test_broken_text_is_refused():
    with pytest.raises(ValueError):
        chat.read_back("<turn>### user: open")


def test_paths_of_branching_trees(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 2.0),
        (1, 4, 3, "user", "c", -5.0), (1, 5, 3, "user", None, 1.0), (None, 1, None, None, "x", None),
        (2, 1, 2, "u", "circle", 0.0), (2, 2, 1, "u", "circle", 0.0), (2, 3, 2, "u", "leaf", 0.0),
        (3, 1, 99, "user", "dangling", 0.0), (3, 1, 99, "user", "dangling", 0.0), (4, None, None, "user", "no id", 0.0),
    ]
    messages = spark.createDataFrame(rows, MESSAGES)
    got = {(r.tree, r.leaf): chat.read_back(r.text) for r in chat.conversations(messages).collect()}
    assert got == {
        (1, 2): [("user", "q"), ("assistant", "a")],
        (1, 4): [("user", "q"), ("assistant", "b"), ("user", "c")],
        (1, 5): [("user", "q"), ("assistant", "b"), ("user", "")],
        (None, 1): [("", "x")],
        (3, 1): [("user", "dangling")],
    }
    best = {(r.tree, r.leaf): r.score for r in chat.conversations(messages, branches=1).collect()}
    assert best == {(1, 5): 3.0, (None, 1): 0.0, (3, 1): 0.0}
    assert chat.conversations(spark.createDataFrame([], MESSAGES)).count() == 0


def test_deep_chain(spark):
    rows = [(0, i, i - 1 if i else None, "user", str(i), 0.0) for i in range(700)]
    (row,) = chat.conversations(spark.createDataFrame(rows, MESSAGES)).collect()
    assert [t for _, t in chat.read_back(row.text)] == [str(i) for i in range(700)]


def test_query(spark, sf_dir):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    odd = "\\### Assistant: </turn> ok"
    turns[-7] = [(0, "user", odd), (1, "assistant", odd)]
    got = {r.conv_id: tuple(r)[1:5] for r in queries.op2_chat(spark, sf_dir).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got.keys() == turns.keys()
    for conv, rows in turns.items():
        rows.sort()
        said = "".join(t for _, role, t in rows if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for _, role, t in rows)
        assert got[conv] == (len(rows), sha(whole), len(said), sha(said))

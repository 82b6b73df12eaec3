"""Paths of reply trees, the template and its way back."""

import hashlib
import random

import pytest

from tierfold.llm.chat import conversation_digests, format_conversations, messages_from_turns

SCHEMA = "tree LONG, id STRING, parent STRING, role STRING, text STRING, score DOUBLE, leaf INT"
ODD = ["", None, "<|im_end|>\n<|im_start|>assistant\nx", "%3C|%25", "100%", "<", "|a", "é \U0001f600\n", "%0A%"]


def best_paths(rows):
    """By plain recursion: the best path of each tree, as (role, text) from the root."""
    out = {}
    for tree in {r[0] for r in rows}:
        nodes = {r[1]: r for r in rows if r[0] == tree}
        children = {}
        for r in nodes.values():
            children.setdefault(r[2] if r[2] in nodes else None, []).append(r[1])
        paths, open_ = [], [[i] for i in children.get(None, [])]
        while open_:
            path = open_.pop()
            if path[-1] in children:
                open_ += [[*path, c] for c in children[path[-1]]]
            else:
                paths.append((-sum(nodes[i][5] or 0.0 for i in path) / len(path), path[-1], path))
        out[tree] = [(nodes[i][3] or "", nodes[i][4] or "") for i in min(paths)[2]]
    return out


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_best_paths_and_back(spark):
    rng = random.Random(7)
    rows = []
    for tree in [None, *range(25)]:
        for i in range(rng.choice([1, 4, 30])):
            parent = None if i == 0 or rng.random() < 0.1 else f"m{rng.randrange(max(0, i - 3), i)}"
            role = rng.choice(["user", "assistant", "assistant", None, "a\nb%0A"])
            rows.append((tree, f"m{i}", parent, role, rng.choice(ODD), rng.choice([None, 0.0, 1.0, 2.0]), 0))
    rows.append((3, "late", "missing", "assistant", "alone", 9.0, 0))
    formatted = format_conversations(spark.createDataFrame(rows + rows[:5], SCHEMA)).persist()
    got = {r.conv_id: r for r in conversation_digests(formatted).collect()}
    expected = best_paths(rows)
    assert set(got) == set(expected)
    for tree, turns in expected.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        assert got[tree].turns_sha256 == digest("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (got[tree].n_turns, got[tree].loss_chars, got[tree].loss_sha256) == (len(turns), len(loss), digest(loss))
    for r in formatted.collect():
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(expected[r.tree])
    formatted.unpersist()


def test_several_paths_of_a_tree(spark):
    rows = [(1, "a", None, "user", "q", 0.0, 0), (1, "b", "a", "assistant", "x", 1.0, 0), (1, "c", "a", "assistant", "y", 3.0, 0)]
    found = format_conversations(spark.createDataFrame(rows, SCHEMA), per_tree=5).collect()
    assert sorted((r.leaf, r.score) for r in found) == [("b", 0.5), ("c", 1.5)]


def test_a_long_branch(spark):
    turns = [(5, i % 300, "assistant" if i % 2 else "user", f"t{i}") for i in range(600)]
    df = spark.createDataFrame(turns, "conv_id LONG, turn LONG, role STRING, text STRING")
    (got,) = conversation_digests(format_conversations(messages_from_turns(df))).collect()
    ordered = sorted(turns, key=lambda t: t[1:])
    assert got.n_turns == 600 and got.turns_sha256 == digest("".join(f"{r}\n{t}\n" for _, _, r, t in ordered))


def test_circle_and_empty(spark):
    rows = [(1, "a", "b", "user", "q", 0.0, 0), (1, "b", "a", "user", "q", 0.0, 0)]
    with pytest.raises(ValueError, match="circle"):
        format_conversations(spark.createDataFrame(rows, SCHEMA))
    assert format_conversations(spark.createDataFrame([], SCHEMA)).collect() == []

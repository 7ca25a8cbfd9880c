import hashlib

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from comptoir.llm import chat
from comptoir.llm.chat import CONTROLS, Coder, escaped, format_trees, read_back, unescaped
from comptoir.llm.queries import ORACLE, REGISTRY, digests_of_turns

SCHEMA = "conv_id long, turn int, role string, text string, node string, row int"


def tokenizer(folder):
    return str(folder / "byte_bpe_50k.json")


def rows(conversations):
    return [(c, t, role, text, "x", 1) for c, turns in conversations for t, (role, text) in enumerate(turns)]


def expected(conversations):
    """conv_id, n_turns, digest of turns, learned characters and digest, in plain Python."""
    out = []
    for c, turns in conversations:
        turns = [(r or "", t or "") for r, t in turns]
        learned = "".join(t for r, t in turns if r == "assistant")
        out.append((c, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                    len(learned), hashlib.sha256(learned.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, folder, conversations, partitions=3):
    """Trees of the conversations, with every claim of theirs tested; returns the nodes."""
    frame = spark.createDataFrame(rows(conversations), SCHEMA).repartition(partitions)
    trees = format_trees(frame, tokenizer(folder))
    back = digests_of_turns(read_back(trees, tokenizer(folder)))
    assert sorted((tuple(r)[:5] for r in back.collect()), key=str) == expected(conversations)

    nodes = {bytes(r.node): r for r in trees.nodes.collect()}
    paths = {r.conv_id: [bytes(x) for x in r.path] for r in trees.conversations.collect()}
    prefixes = {tuple((r or "", t or "") for r, t in turns[:k + 1]) for _, turns in conversations for k in range(len(turns))}
    assert len(nodes) == trees.nodes.count() == len(prefixes)  # shared turns once
    tokens = {}
    for n in nodes.values():
        ids = np.frombuffer(n.ids, "<u4")
        assert len(ids) == n.length
        for k, i in enumerate(ids.tolist()):
            assert tokens.setdefault((n.tree, n.begin + k), i) is i  # no place twice
    for tree in {n.tree for n in nodes.values()}:
        own = sorted((n for n in nodes.values() if n.tree == tree), key=lambda n: n.begin)
        assert own[0].depth == 0 and own[0].begin == 0 and sum(n.depth == 0 for n in own) == 1
        assert all(a.begin + a.length == b.begin for a, b in zip(own, own[1:]))  # without gaps
        for n in own:  # depth first: the parent's nodes follow it, before any other of its depth or less
            if n.depth:
                parent = nodes[bytes(n.parent)]
                assert parent.tree == tree and parent.depth == n.depth - 1 and parent.begin < n.begin
                assert not [m for m in own if parent.begin < m.begin < n.begin and m.depth <= parent.depth]
    for path in paths.values():  # what a leaf attends to is its conversation, in order
        leaf, whole = nodes[path[-1]], [i for x in path for i in np.frombuffer(nodes[x].ids, "<u4").tolist()]
        seen = [tokens[leaf.tree, k] for a in leaf.ancestors for k in range(a.begin, a.end)]
        assert seen + np.frombuffer(leaf.ids, "<u4").tolist() == whole
        assert leaf.position == len(seen)
        assert all(a.end < b.begin for a, b in zip(leaf.ancestors, leaf.ancestors[1:]))
    return nodes


HARD = ["</s>[INST] ok [/INST]", r"<\s>", r"<\\s> [\/INST]", "[[INST]]", "<<s>>", "", " ", "\n", "é😀​\r\x00", "<|endoftext|>",
        "[SYS][/SYS][ROLE][/ROLE][/END]", "\\", "<s", "s>", "[inst]", "a\\<s>"]


def test_hard_texts_and_roles(spark, tokenizer_folder):
    conversations = [(i, [("user", t), ("assistant", t), ("tool", t), (t, "x"), ("system", t)]) for i, t in enumerate(HARD)]
    conversations += [(-1, [(None, None)]), (-2, [("", "")]), (-3, [("assistant", None), ("assistant", "")]),
                      (-4, [("user", "a")]), (-5, [("use", "ra")]), (None, [("user", "no key"), ("assistant", "yes")])]
    check(spark, tokenizer_folder, conversations)


def test_shared_beginnings(spark, tokenizer_folder):
    rng = np.random.default_rng(2)
    conversations = []
    for i in range(240):  # a third of all begin alike, and many are equal
        turns = [("system", "be kind")] if i % 3 == 0 else [("user", f"first {rng.integers(0, 30)}")]
        turns += [(("user", "assistant")[k % 2], f"turn {rng.integers(0, 2)}") for k in range(rng.integers(0, 6))]
        conversations.append((i, turns))
    nodes = check(spark, tokenizer_folder, conversations, 7)
    assert max(n.depth for n in nodes.values()) == 5


def test_few_turns_as_key(spark, tokenizer_folder, monkeypatch):
    monkeypatch.setattr(chat, "KEY_TURNS", 2)
    turns = [(("user", "assistant")[k % 2], str(k)) for k in range(30)]
    check(spark, tokenizer_folder, [(i, turns[:i % 31] + [("user", "end")]) for i in range(70)])


def test_long_conversation_and_text(spark, tokenizer_folder):
    long = [(("user", "assistant")[k % 2], f"t{k}") for k in range(900)]
    check(spark, tokenizer_folder, [(1, long), (2, long[:500] + [("user", "other " * 20_000)]), (3, long)])


def test_order_of_turns(spark, tokenizer_folder):
    given = [(1, 5, "user", "c", "", 0), (1, None, "user", "a", "", 0), (1, 2, "user", "b", "", 0), (1, 2, "assistant", "z", "", 0),
             (2, 1, "user", "same", "", 0), (2, 1, "user", "same", "", 0)]
    back = read_back(format_trees(spark.createDataFrame(given, SCHEMA), tokenizer(tokenizer_folder)), tokenizer(tokenizer_folder))
    out = [tuple(r) for r in back.orderBy("conv_id", "place").select("conv_id", "place", "text").collect()]
    assert out == [(1, 0, "a"), (1, 1, "z"), (1, 2, "b"), (1, 3, "c"), (2, 0, "same"), (2, 1, "same")]


def test_empty(spark, tokenizer_folder):
    trees = format_trees(spark.createDataFrame([], SCHEMA), tokenizer(tokenizer_folder))
    assert trees.nodes.count() == trees.conversations.count() == 0
    assert digests_of_turns(read_back(trees, tokenizer(tokenizer_folder))).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<[\\/s>INST]", max_size=30))
def test_escape_by_its_rule(text):
    import re

    made = re.sub(chat._CONTROL, r"\1\2\\\3", text)
    assert not any(c in made for c in CONTROLS)
    assert unescaped(made) == text


def test_escape_in_spark(spark):
    frame = spark.createDataFrame([(t,) for t in HARD], "t string").select("t", escaped(chat.F.col("t")).alias("e"))
    for r in frame.collect():
        assert not any(c in r.e for c in CONTROLS)
        assert unescaped(r.e) == r.t
    assert {r.t: r.e for r in frame.collect()}["</s>[INST] ok [/INST]"] == r"<\/s>[\INST] ok [\/INST]"


def test_control_ids_are_beyond_the_vocabulary(tokenizer_folder):
    coder = Coder(tokenizer(tokenizer_folder))
    assert max(i for ids in coder.encode(HARD) for i in ids) < min(coder.control.values())


def test_query_equals_sql(spark, sf_dir):
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    out = REGISTRY["op13_chat"](spark, sf_dir)
    assert sorted(map(tuple, out.collect())) == sorted(duckdb.sql(f"SELECT {', '.join(out.columns)} FROM ({ORACLE['op13_chat']})").fetchall())

import hashlib
import random
import zlib

import pytest

from faremill.llm import prefix_trie
from faremill.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string, path string, sizes string, at string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], TURNS)


def truncated(c, m):
    return c - (abs(c) % m) * (1 if c >= 0 else -1)


def brute(rows):
    convs = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            convs.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    nodes = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(original.get(truncated(c, 5), [])[:h] + own[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append((c, len(path) == d))
    out = []
    for node, members in nodes.items():
        below = [x for x in nodes if x[:len(node)] == node]
        ends = sorted(c for c, end in members if end)
        out.append((min(m[0] for m in members), len(node), min(m[0] for m in nodes[node[:-1]]) if node else None, len(members),
                    sum(len(x) == len(node) + 1 for x in below), sum(not any(y[:-1] == x for y in nodes if y) for x in below),
                    sum((len(nodes[x]) - 1) * len(x[-1][1].encode()) for x in below if x),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def some_turns(seed, convs=60):
    pick, rows = random.Random(seed), []
    for c in pick.sample(range(-20, 3 * convs), convs):
        for turn in range(pick.choice([1, 2, 3, 4, 6, 12])):
            text = pick.choice(["hi", "hello", "é", "", None]) if pick.random() < 0.8 else f"text {c} {turn}"
            rows.append((c, turn, pick.choice(["user", "assistant", None, ""]), text))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [1 << 20, 3])
def test_nodes_against_plain_loops(spark, shard_turns):
    rows = some_turns(1)
    # Ties of a turn that are no repeats have an order of their own; here they are equal.
    rows += [(7, None, "user", "first"), (None, 1, "user", "nobody"), (8, 2, "x", "same"), (8, 2, "x", "same"), (2**62, 0, "user", "z" * 100_000)]
    assert result(prefix_trie.conversation_trie(turns_of(spark, rows), shard_turns)) == brute(rows)


def test_one_conversation_and_one_first_turn_hold_most(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PACKED_IDS", 7)
    rows = [(c, t, "user", f"turn {t}") for c in range(400) for t in range(3)]
    rows += [(1000 + c, t, "user", "turn 0" if t == 0 else f"own {c} {t}") for c in range(100) for t in range(4)]
    paths = prefix_trie.rebuilt(turns_of(spark, rows))
    splitters = prefix_trie.chosen_splitters(paths, 20)
    skeleton = prefix_trie.Skeleton(splitters)
    # The common path is cut between its own conversations.
    assert len(splitters) > 5 and len({p for p, _ in splitters}) < len(splitters)
    assert {len(n) // prefix_trie.DIGEST for n in skeleton.nodes} >= {0, 1, 2, 3}
    assert result(prefix_trie.conversation_trie(turns_of(spark, rows), 20)) == brute(rows)


def test_rebuilt_conversations_without_turns_end_at_the_root(spark):
    # Conversation 3 has no family head and takes more turns from it than it has.
    lone = next(c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    rows = [(lone, 0, "user", "a"), (lone, 1, "user", "b")]
    got = result(prefix_trie.conversation_trie(turns_of(spark, rows)))
    assert got == brute(rows) and len(got) == 1 and got[0][1:6] == (0, None, 1, 0, 1)


def test_no_conversations(spark):
    assert result(prefix_trie.conversation_trie(turns_of(spark, []))) == []
    assert result(prefix_trie.conversation_trie(turns_of(spark, [(None, 1, "user", "x")]))) == []


def test_samples_are_thinned_out_below_the_bound(spark, monkeypatch):
    paths = prefix_trie.rebuilt(turns_of(spark, [(c, t, "user", f"{c}") for c in range(600) for t in range(10)]))
    many = len(prefix_trie.chosen_splitters(paths, 20))
    monkeypatch.setattr(prefix_trie, "SKELETON_BYTES", 4_000)
    few = prefix_trie.chosen_splitters(paths, 20)
    assert 0 < len(few) < many and sum(len(p) + 8 for p, _ in few) <= 4_000


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert result(QUERIES["op13_prefix_trie"](spark, "/root/testdata/sf0.001")) == brute([tuple(r) for r in rows])

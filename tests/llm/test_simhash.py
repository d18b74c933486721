import random

import numpy as np
import xxhash

from faremill.llm import simhash
from faremill.llm.components import components
from faremill.llm.queries import QUERIES


def brute_fingerprint(text, words=3):
    tokens = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        tokens = tokens.replace(space, " ")
    tokens = [t for t in tokens.split(" ") if t]
    shingles = [" ".join(tokens[i:i + words]) for i in range(len(tokens) - words + 1)] or [" ".join(tokens)] * bool(tokens)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius=2):
    """Smallest id reachable, by comparing everything with everything."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    label = list(range(len(ids)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= radius):
            a, b = sorted((root(i), root(int(j))))
            label[b] = a
    return {ids[i]: ids[root(i)] for i in range(len(ids))}


def near_prints(count, seed):
    """Chains and clouds of close fingerprints."""
    pick, prints, current = random.Random(seed), {}, 0
    for i in range(count):
        current = pick.getrandbits(64) if i % 25 == 0 else current ^ (1 << pick.randrange(64)) ^ (1 << pick.randrange(64)) * (i % 3 > 0)
        prints[i * 7 % count] = current
    return prints


def test_fingerprints():
    texts = ["", " \t\n", "One", "one two", "ONE two\x0bthree", "É é A a", "a\x1cb c\xa0d e f", "x " * 3000 + "y"]
    assert [simhash.fingerprint_of(t, 3) for t in texts] == [brute_fingerprint(t) for t in texts]
    assert simhash.fingerprint_of("a b c d e f", 5) == brute_fingerprint("a b c d e f", 5)


def test_tree_search_finds_all_within_the_radius():
    values = np.unique(np.array(list(near_prints(600, 5).values()), np.uint64))
    query, node = simhash.BKTree(values).search(values, 2)
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    assert set(zip(query.tolist(), node.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(close))))


def test_groups_of_fingerprints_also_in_split_shards(spark):
    prints = near_prints(500, 9)
    expected = brute_groups(prints)
    rows = [(i, int(np.uint64(v).view(np.int64))) for i, v in prints.items()]
    distinct = {}
    for i, v in rows:
        distinct[v] = min(i, distinct.get(v, i))
    frame = spark.createDataFrame([(v, i) for v, i in distinct.items()], "fingerprint long, rep long")
    for shard in (4096, 8):
        links = simhash.fingerprint_links(frame, 2, shard)
        found = {r.node: r.component for r in components(links).collect()}
        assert {i: found.get(distinct[v], distinct[v]) for i, v in rows} == expected


def test_one_hot_segment(spark):
    """All fingerprints share two of three segments, so that a shard holds all of them."""
    rows = [(i << 3, i) for i in range(300)]
    frame = spark.createDataFrame(rows, "fingerprint long, rep long")
    found = {r.node: r.component for r in components(simhash.fingerprint_links(frame, 1, 16)).collect()}
    assert {i: found.get(i, i) for i in range(300)} == brute_groups({i: v for v, i in rows}, 1)


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(400, 460)]
    frame = spark.createDataFrame(chain + star + [(7, 7), (None, 3)], "u long, v long")
    found = {r.node: r.component for r in components(frame).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 400 for i in [*range(400, 460), 500]}
    assert components(frame.limit(0)).collect() == []


def test_edge_rows(spark):
    rows = [(5, None, "x"), (3, "", "x"), (9, "a b c d", "y"), (9, "a b c d", "y"), (4, "A B\nC  D", "z"), (None, "a b c d", "n"),
            (None, "only here", "n"), (8, "q " * 20_000, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    found = sorted({(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}, key=str)
    assert found == sorted([(5, 3), (3, 3), (9, 4), (4, 4), (None, 4), (None, None), (8, 8)], key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 4, None, None, 8], key=str)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    prints = {i: brute_fingerprint(t) for i, t in docs.items()}
    expected = {(i, f"{prints[i]:016x}", c) for i, c in brute_groups(prints).items()}
    assert {tuple(r) for r in QUERIES["op10_simhash_bk"](spark, "/root/testdata/sf0.01").collect()} == expected

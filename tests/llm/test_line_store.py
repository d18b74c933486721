import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from faremill.llm import line_store
from faremill.llm.cuckoo import CuckooFilter, Full
from faremill.llm.line_store import LineStore
from faremill.llm.queries import QUERIES
from faremill.session import scratch_path

DOCS = "doc_id long, text string, key string, hash long, keys string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, "clash") for i, t in rows], DOCS)


def fold(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, least_docs=3, least_chars=20):
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(fold(line)) >= least_chars:
                holders.setdefault(fold(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or len(holders.get(fold(x), ())) < least_docs or max(holders[fold(x)]) == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def result(docs, store):
    return sorted((tuple(r) for r in line_store.deduped(docs, store).collect()), key=str)


def some_rows(seed, count=150):
    pick = random.Random(seed)
    common = [f"this line stands in many documents {i}" for i in range(12)] + ["short", "", "   ", "x" * 19, "x" * 20, "É" * 20]
    rows = []
    for i in range(count):
        lines = [pick.choice(common) if pick.random() < 0.7 else f"only here: number {i} {j} of all" for j in range(pick.randrange(8))]
        lines = [pick.choice([str, str.upper, lambda x: f"\t {x}\r", lambda x: f"{x} "])(x) for x in lines]
        rows.append((i * 3, "\n".join(lines)))
    return rows


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 900))
def test_a_filter_never_denies_what_it_holds(seed, count):
    hashes = np.random.default_rng(seed).integers(0, 2**64, count, np.uint64)
    held = CuckooFilter(256)
    held.insert(hashes)
    assert held.contains(hashes).all() and len(held) == count
    gone, left = hashes[: count // 2], hashes[count // 2:]
    held = CuckooFilter.load(held.dump())
    held.delete(gone)
    assert held.contains(left).all() and len(held) == len(left)
    held.delete(left)
    assert not held.table.any()


def test_a_filter_says_when_it_is_full_and_denies_most_others():
    held = CuckooFilter(1 << 10)
    held.insert(np.arange(3600, dtype=np.uint64))
    assert held.contains(np.arange(10_000, 60_000, dtype=np.uint64)).mean() < 0.002
    with pytest.raises(Full):
        held.insert(np.arange(3600, 3800, dtype=np.uint64))
    with pytest.raises(KeyError):
        CuckooFilter(16).delete(np.array([5], np.uint64))


def test_equal_hashes_are_counted_as_often_as_they_come():
    held = CuckooFilter(1 << 8)
    held.insert(np.array([7, 7, 7, 9], np.uint64))
    held.delete(np.array([7, 7], np.uint64))
    assert held.contains(np.array([7, 9], np.uint64)).all()
    held.delete(np.array([7], np.uint64))
    assert held.contains(np.array([7, 9], np.uint64)).tolist() == [False, True]


@pytest.mark.parametrize("deliveries", [1, 3])
def test_documents_against_plain_loops(spark, deliveries):
    rows = some_rows(4) + [(None, "this line stands in many documents 1\nx"), (1000, None), (1001, ""), (1002, "\n\n"),
                           (3, "this line stands in many documents 2"), (3, "this line stands in many documents 2"),
                           (2000, "\n".join(f"this line stands in many documents {i % 12}" for i in range(20_000)))]
    docs = docs_of(spark, rows)
    store = line_store.load(docs, scratch_path(spark, "lines"), deliveries)
    assert result(docs, store) == brute(rows)


def test_deliveries_can_be_taken_back(spark):
    first, second = some_rows(5, 60), [(1_000 + i, t) for i, t in some_rows(6, 60)]
    path = scratch_path(spark, "lines")
    alone = LineStore.open(spark, path).insert(docs_of(spark, first))
    both = alone.insert(docs_of(spark, second))
    assert result(docs_of(spark, first + second), both) == brute(first + second)
    again = both.insert(docs_of(spark, second[:30]))
    assert sorted(map(str, again.counts.collect())) == sorted(map(str, both.counts.collect()))
    ids = spark.createDataFrame([(i,) for i, _ in second] + [(None,), (77_777,)], "doc_id long")
    back = again.delete(ids)
    for name in ("refs", "counts"):
        assert sorted(map(str, getattr(back, name).collect())) == sorted(map(str, getattr(alone, name).collect()))
    for one, other in zip(*(sorted(s.filters.collect()) for s in (alone, back))):
        kept = [CuckooFilter.load(bytes(r["filter"])) for r in (one, other)]
        assert len(kept[0]) == len(kept[1]) == back.counts.filter(f"shard = {one['shard']}").count()
    assert result(docs_of(spark, first), back) == brute(first)
    assert LineStore.open(spark, path).version == back.version


def test_the_exact_counts_decide_where_a_filter_errs(spark, monkeypatch):
    # A filter that knows everything sends every line to the exact tables.
    monkeypatch.setattr(line_store.CuckooFilter, "contains", lambda self, hashes: np.ones(len(hashes), bool))
    rows = some_rows(7, 60)
    docs = docs_of(spark, rows)
    store = line_store.load(docs, scratch_path(spark, "lines"), 2)
    assert result(docs, store) == brute(rows)


def test_shards_double_before_filters_are_full(spark, monkeypatch):
    monkeypatch.setattr(line_store, "BUCKETS", 16)
    monkeypatch.setattr(line_store, "CuckooFilter", type("Small", (CuckooFilter,), {"__init__": lambda self, b=64: CuckooFilter.__init__(self, b)}))
    store, rows = LineStore.open(spark, scratch_path(spark, "lines")), some_rows(8, 80)
    for at in range(0, 80, 40):
        store = store.insert(docs_of(spark, rows[at:at + 40]))
    assert store.shards > 1 and store.filters.count() == store.counts.select("shard").distinct().count()
    assert result(docs_of(spark, rows), store) == brute(rows)


def test_no_documents(spark):
    docs = docs_of(spark, [])
    store = line_store.load(docs, scratch_path(spark, "lines"))
    assert result(docs, store) == [] and store.counts.isEmpty()
    nameless = docs_of(spark, [(None, "x" * 30)] * 5)
    assert {r[2] for r in result(nameless, line_store.load(nameless, scratch_path(spark, "lines")))} == {0}


def test_query(spark):
    rows = QUERIES["op11_line_store"](spark, "/root/testdata/sf0.001").collect()
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(texts)]
    assert sorted(map(tuple, rows)) == sorted(want) and any(r["n_dropped"] for r in rows)

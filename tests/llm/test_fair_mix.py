import math
import re

import pytest
from pyspark.sql import functions as F

from faremill.llm import fair_mix
from faremill.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(5, 2, 1), most=3, share=1.0):
    """Share out by weight, stop the full ones, share the excess again until none is above."""
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = sum(sizes.values()) * share, set(order), {}
    while open_:
        rate = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if sizes[s] * most <= rate * weight[s]}
        if not full:
            target |= {s: rate * weight[s] for s in open_}
            break
        for s in full:
            target[s] = sizes[s] * most
            left -= target[s]
        open_ -= full
    return target


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string, copies string")


def mix_rows(spark, docs):
    sizes = fair_mix.sized(docs)
    return fair_mix.with_copies(sizes, fair_mix.mix_plan(sizes)).collect()


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 1000, None: 50}, {"a": 1, "b": 1, "c": 1}, {"a": 5, "b": 0, None: 700}, {"z": 9},
    {f"s{i}": (i * 37) % 91 + 1 for i in range(20)}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in fair_mix.source_targets(rows).collect()}
    expected = brute_targets(sizes)
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[s], expected[s], rel_tol=1e-9, abs_tol=1e-9) for s in found)


@pytest.mark.parametrize("bucket_rows", [2000, 7])
def test_mix_is_the_start_of_the_sorted_queue(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(fair_mix, "BUCKET_ROWS", bucket_rows)
    rows = [(i, "w " * (i * 13 % 29), ["a", "b", None, "c"][min(3, i % 7)], "s", "c") for i in range(200)]
    docs = documents(spark, rows)
    found = mix_rows(spark, docs)
    sizes = {}
    for r in found:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    target, queue = brute_targets(sizes), []
    for source, total in sizes.items():
        mine = sorted((r for r in found if r.source == source and r.size), key=lambda r: r.shuffled)
        for epoch in range(3):
            upto = epoch * total
            for r in mine:
                if upto < target[source]:
                    queue.append(((upto + r.size) / target[source], source or "~", r.shuffled, r.doc_id, r.size))
                upto += r.size
    taken, served = {}, 0
    for _, _, _, doc_id, size in sorted(queue):
        served += size
        if served > sum(sizes.values()):
            break
        taken[doc_id] = taken.get(doc_id, 0) + 1
    assert {r.doc_id: r.copies for r in found if r.copies} == taken
    largest = max(r.size for r in found)
    for source in sizes:
        got = sum(r.size * r.copies for r in found if r.source == source)
        assert abs(got - target[source]) <= 2 * largest
    assert max(r.copies for r in found) <= 3
    out = fair_mix.mixed(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == taken


def test_edge_rows(spark):
    rows = [(1, None, "a", None, None), (2, "", "a", None, None), (3, " \t\x0b", None, None, None), (None, "x y", "b", None, None),
            (4, "x\x1cy z", "b", None, None), (4, "x\x1cy z", "b", None, None), (5, "long " * 30_000, "c", None, None)]
    found = mix_rows(spark, documents(spark, rows))
    assert sorted(r.size for r in found) == [0, 0, 0, 2, 2, 2, 30_000]
    assert {r.copies for r in found if r.size == 0} == {0}
    assert len({r.copies for r in found if r.doc_id == 4}) == 1
    empty = documents(spark, []).limit(0)
    assert mix_rows(spark, empty) == [] and fair_mix.mixed(empty).collect() == []
    blank = documents(spark, rows[:3])
    assert [r.copies for r in mix_rows(spark, blank)] == [0, 0, 0] and fair_mix.mixed(blank).collect() == []


def test_query(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    size = {d.doc_id: len(WORD.findall(d.text or "")) for d in docs}
    source = {d.doc_id: d.source for d in docs}
    total = {}
    for i, s in source.items():
        total[s] = total.get(s, 0) + size[i]
    target = brute_targets(total)
    found = QUERIES["op6_fair_mix"](spark, path).collect()
    assert sorted(r.doc_id for r in found) == sorted(size)
    taken = dict.fromkeys(total, 0)
    for r in found:
        assert (r["size"], r.source_size) == (size[r.doc_id], total[source[r.doc_id]])
        assert math.isclose(r.target, target[source[r.doc_id]], rel_tol=1e-9)
        assert r.taken in {r["size"] * n for n in range(4)}
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - target[s]) <= max(size.values()) for s in total)
    assert sum(taken.values()) <= sum(total.values())
    again = QUERIES["op6_fair_mix"](spark, path).agg(F.sum(F.hash("doc_id", "taken"))).first()
    assert again == QUERIES["op6_fair_mix"](spark, path).agg(F.sum(F.hash("doc_id", "taken"))).first()

import random
import re
from itertools import permutations

import numpy as np
import pytest

from faremill.llm import filter_audit
from faremill.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, mask string, good string"
LABELS = "doc_id long, quality int, toxic int, good string"
LONG = " ".join(f"w{i}" for i in range(220))


def brute_fails(docs):
    firsts = {}
    for doc_id, text, *_ in docs:
        if doc_id is not None:
            firsts[text or ""] = min(firsts.get(text or "", doc_id), doc_id)
    for doc_id, text, _, source, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words),
                 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search(r"[#$%&*|]", text)),
                 doc_id is not None and doc_id > firsts[text]]
        yield doc_id, source or "", dict(zip("ABCDE", fails))


def brute_audit(docs, labels):
    good = {d for d, quality, *_ in labels if quality == 1 and d is not None}
    toxic = {d for d, _, mark, *_ in labels if mark == 1 and d is not None}
    facts, rows = list(brute_fails(docs)), {}
    for part in {p for _, p, _ in facts}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = [f for f in facts if f[1] == part]
            before = []
            for step, letter in enumerate(order, 1):
                gone = [f for f in left if f[2][letter]]
                left = [f for f in left if not f[2][letter]]
                unique = sum(f[1] == part and f[2][letter] and sum(f[2].values()) == 1 for f in facts)
                rows[part, "".join(order), step] = [
                    len(left), len(gone), sum(f[2][letter] for f in before), unique,
                    sum(f[0] in good for f in gone), sum(f[0] in toxic for f in gone)]
                shapley[letter] += len(gone)
                before += gone
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                rows[part, "".join(order), step].append(shapley[letter])
    return rows


def as_rows(report):
    return {(r["part"], r["filter_order"], r["step"]): [r[m] for m in filter_audit.MEASURES] for r in report.collect()}


def document(doc_id, text, source="s"):
    return (doc_id, text, "en", source, 0, "clash", "clash", "clash")


def test_removal_steps_are_the_smallest_failing_place():
    places, steps = filter_audit.removal_steps(4)
    for at, order in enumerate(permutations(range(4))):
        assert [order[p] for p in places[at]] != [] and [order.index(f) for f in range(4)] == places[at].tolist()
        for mask in range(1, 16):
            assert steps[mask, at] == next(i for i, f in enumerate(order) if mask >> f & 1)
    assert (steps[0] >= 4).all()


def test_audit_of_documents_against_plain_loops(spark):
    pick = random.Random(3)
    texts = [None, "", " \t\n", LONG, LONG + " #", LONG.upper(), "x " * 300, "A" * 50, "a|b", LONG + " éÉ", "one\x1cword " * 150,
             " ".join(str(i) for i in range(70_000))]
    docs = [document(i if i % 11 else None, pick.choice(texts), pick.choice(["s", "", None, "t"])) for i in range(120)]
    docs += [document(500, LONG, "a"), document(500, LONG, "a"), document(500, LONG, "b"), document(1000, None, "b"), document(-3, LONG, "t")]
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1, None]), "x") for i in range(0, 130, 2)]
    labels += [(4, 1, 0, "x"), (4, 0, 1, "x"), (None, 1, 1, "x"), (500, 1, 1, "x")]
    report = filter_audit.documents_audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert as_rows(report) == brute_audit(docs, labels)


def test_one_source_and_one_text_hold_most_rows(spark):
    docs = [document(i, LONG, "hot") for i in range(3000)] + [document(5000 + i, f"{LONG} {i}", f"s{i % 7}") for i in range(50)]
    got = as_rows(filter_audit.documents_audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS)))
    assert len(got) == 8 * 600
    assert got["hot", "EABCD", 1] == [1, 2999, 0, 2999, 0, 0, 120 * 2999]


def test_no_documents_give_no_parts(spark):
    report = filter_audit.documents_audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS))
    assert report.collect() == []
    assert [f.simpleString().split(":")[1] for f in report.schema][1:3] == ["string", "int"]


def test_other_filters(spark):
    masks = spark.createDataFrame([("p", 3, True, None, 5), ("p", 0, None, None, 2), ("p", 2, False, True, 1), ("p", 2, False, True, 1)],
                                  "part string, mask int, good boolean, toxic boolean, n long")
    got = as_rows(filter_audit.filter_audit(masks, "XY"))
    assert got == {("p", "XY", 1): [4, 5, 0, 0, 5, 0, 5], ("p", "XY", 2): [2, 2, 5, 2, 0, 2, 9],
                   ("p", "YX", 1): [2, 7, 0, 2, 5, 2, 9], ("p", "YX", 2): [2, 0, 5, 0, 0, 0, 5]}


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_of_random_weights(seed):
    weights = np.random.default_rng(seed).integers(0, 9, (3, 32))
    counts = filter_audit.audit_counts(weights, weights // 2, weights // 3, 5)
    assert (counts["kept"][:, :, -1] == weights[:, :1]).all()
    assert (counts["removed"].sum(axis=2) + counts["kept"][:, :, -1] == weights.sum(axis=1)[:, None]).all()


def test_query(spark):
    assert QUERIES["op12_filter_audit"](spark, "/root/testdata/sf0.001").groupBy("part").count().filter("count <> 600").count() == 0

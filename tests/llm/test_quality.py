import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from faremill.llm import common, quality
from faremill.llm.queries import QUERIES


def left_out(doc_id):
    """Whether a trusted document is one of those for the thresholds."""
    hashed = xxhash.xxh64(str(doc_id).encode(), seed=42).intdigest()
    return (hashed - (1 << 64 if hashed >> 63 else 0)) % quality.LEFT_OUT == 0


class BruteModel:
    """Interpolated modified Kneser-Ney over characters, from its formulas."""

    def __init__(self, texts, order=quality.ORDER):
        counts = Counter(g for t in texts for g in self.grams(t, order))
        self.orders = {}
        for k in range(order, 0, -1):
            of = Counter(counts.values())
            y = of[1] / (of[1] + 2 * of[2]) if of[1] + 2 * of[2] else None
            discounts = []
            for i in (1, 2, 3):
                d = i - (i + 1) * y * of[i + 1] / of[i] if y is not None and of[i] else None
                discounts.append(d if d is not None and 0 < d < i else 0.5)
            context = defaultdict(dict)
            for g, n in counts.items():
                context[g[:-1]][g[-1]] = n
            self.orders[k] = (context, discounts)
            if k > 1:
                counts = Counter(g[1:] for g in counts)

    @staticmethod
    def grams(text, order=quality.ORDER):
        padded = ("start",) * (order - 1) + tuple(text) + ("end",)
        return [padded[i:i + order] for i in range(len(padded) - order + 1)]

    def chance(self, gram):
        if not gram:
            return 1 / (len(self.orders[1][0][()]) + 1)
        context, discounts = self.orders[len(gram)]
        follow, below = context.get(gram[:-1]), self.chance(gram[1:])
        if follow is None:
            return below
        discount = lambda n: discounts[min(n, 3) - 1]
        total, n = sum(follow.values()), follow.get(gram[-1], 0)
        return ((n - discount(n)) / total if n else 0) + sum(map(discount, follow.values())) / total * below

    def score(self, text):
        logs = [-math.log(self.chance(g)) for g in self.grams(text)]
        mean = sum(logs) / len(logs)
        spread = max(sum(x * x for x in logs) / len(logs) - mean * mean, 0)
        return mean, mean - 2 * math.sqrt(spread / len(logs))


def words(seed, count):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice(["the", "an", "er", "in", "g", "é", "😀"]) for _ in range(pick.randint(1, 3))) for _ in range(count))


TRUSTED = [("en", words(i, 30)) for i in range(20)] + [("fr", words(100 + i, 5).upper()) for i in range(6)] + [(None, "left out"), ("de", ""), ("de", ""), ("de", "")]
ASKED = [("en", words(7, 12)), ("en", ""), ("en", "### $$$ 漢字"), ("fr", "THE AN"), ("de", "x"), ("zz", "unknown"), (None, "none"), ("en", None)]


@pytest.mark.parametrize("block_bytes", [quality.BLOCK_BYTES, 500])
def test_scores_equal_the_formulas_in_one_block_and_in_many(spark, block_bytes):
    rows = [(i, *r, 1) for i, r in enumerate(TRUSTED)] + [(100 + i, *r, 0) for i, r in enumerate(ASKED)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(r[0], r[3], 0) for r in rows], "doc_id long, quality int, toxic int")
    counted = {lang: [t for i, (x, t) in enumerate(TRUSTED) if x == lang and not left_out(i)] for lang in ("en", "fr", "de")}
    assert all(counted.values())
    brute = {lang: BruteModel(texts) for lang, texts in counted.items()}
    found = {r.row.doc_id: r for r in quality.scored(docs, labels, block_bytes=block_bytes).collect()}
    assert {i: (r.lang, r.text) for i, r in found.items()} == {r[0]: r[1:3] for r in rows}
    for i, lang, text, _ in rows:
        if lang not in brute:
            assert (found[i].log_perplexity, found[i].low) == (None, None)
        else:
            assert (found[i].log_perplexity, found[i].low) == pytest.approx(brute[lang].score(text or ""), rel=1e-9)


def test_long_texts_are_cut_into_windows(monkeypatch):
    texts = pa.array([words(i, 60) for i in range(5)] + ["", None])
    whole = [np.concatenate(c) for c in zip(*quality.windows(texts))]
    monkeypatch.setattr(quality, "WINDOW", 7)
    assert all((x == y).all() for x, y in zip(whole, [np.concatenate(c) for c in zip(*quality.windows(texts))]))


def test_held_grams_are_given_away_and_summed(spark, monkeypatch):
    texts = [words(i, 50) for i in range(8)]
    rows = [(0, 0, "0", None, None), *((0, 1, "0", "en", t) for t in texts), (1, 1, "0", "en", texts[0]), (1, 1, None, "en", texts[1])]
    batches = [pa.record_batch([pa.array([v], k) for v, k in zip(r, (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()))],
                               ["block", "kind", "id", "lang", "text"]) for r in rows]
    monkeypatch.setattr(quality, "HELD_GRAMS", 40)
    total = Counter()
    for found in quality._asked(iter(batches)):
        for r in found.to_pylist():
            assert r["n"] == 0 or r["block"] == 0
            total[r["hi"], r["lo"]] += r["n"]
    hi, lo, _ = next(quality.windows(pa.array(texts)))
    assert total == Counter(zip(hi.tolist(), lo.tolist()))


class Dealt(Exception):
    pass


@pytest.mark.parametrize("call, blocks", [(quality.judged, 2), (quality.verdicts, 1)])
def test_texts_that_come_back_are_dealt_to_smaller_blocks(spark, monkeypatch, call, blocks):
    def dealt(rows, number):
        raise Dealt(number)

    monkeypatch.setattr(quality, "_in_blocks", dealt)
    docs = spark.range(70).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.repeat(F.lit("ab "), 350_000).alias("text"))
    with pytest.raises(Dealt) as found:
        call(docs, spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"))
    assert found.value.args == (blocks,)


def test_scores_with_texts_are_written_in_small_row_groups(spark, monkeypatch):
    monkeypatch.setattr(quality, "ROW_GROUP_BYTES", 1 << 18)
    pick = random.Random(5)
    rows = [(i, "en", "".join(chr(pick.randrange(0x4E00, 0x4F00)) for _ in range(400))) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    files = quality.scored(docs, labels).inputFiles()
    groups = [g for f in files for m in [pq.ParquetFile(f.removeprefix("file://")).metadata] for g in map(m.row_group, range(m.num_row_groups))]
    assert sum(g.num_rows for g in groups) == len(rows)
    assert len(groups) > 1 and max(g.num_rows for g in groups) < len(rows) / 2


def test_a_task_gives_freed_memory_back_at_its_end(monkeypatch):
    said = []

    class Library:
        def malloc_trim(self, pad):
            said.append(("trim", pad))

    monkeypatch.setattr(common.ctypes, "CDLL", lambda name: Library())
    for batch in common.releasing(lambda batches: (b + 1 for b in batches))(iter([1, 2])):
        said.append(batch)
    assert said == [2, 3, ("trim", 0)]
    monkeypatch.setattr(common.ctypes, "CDLL", lambda name: object())
    assert list(common.releasing(lambda batches: batches)(iter([1]))) == [1]


def test_chances_of_all_characters_sum_to_one():
    brute = BruteModel([t for lang, t in TRUSTED if lang == "en"])
    letters = brute.orders[1][0][()]
    assert sum(brute.chance((*"then", c)) for c in letters) + brute.chance((*"then", "ꯍ")) == pytest.approx(1)


def test_grams_of_a_batch():
    hi, lo, row = (np.concatenate(c) for c in zip(*quality.windows(pa.array(["ab", "", None, "😀"]))))
    assert row.tolist() == [0, 0, 0, 1, 2, 3, 3]
    assert (hi[2], lo[2]) == (quality.START << 21 | quality.START, ord("a") << 42 | ord("b") << 21 | quality.END)
    assert lo[5] == quality.START << 42 | quality.START << 21 | ord("😀")


def test_thresholds_are_quantiles(spark):
    rows = [("a", i / 1000) for i in range(1000)] + [("b", 5.0), ("b", None)]
    found = {r.lang: r.threshold for r in quality.thresholds(spark.createDataFrame(rows, "lang string, low double"), 0.9).collect()}
    assert found["a"] == pytest.approx(0.9, abs=0.0021) and found["b"] == pytest.approx(5.001)


def test_edge_rows(spark):
    text = words(3, 40)
    rows = [(i, words(i, 40), "en", "x") for i in range(30)] + [(40, "#$% " * 50, "en", "x"), (40, "#$% " * 50, "en", "x"), (41, None, "en", "x"),
            (42, "", "en", "x"), (43, text, None, "x"), (44, text, "xx", "x"), (None, text, "en", "x"), (45, "an the " * 20_000, "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, rejected string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(25)] + [(40, 1, 0), (40, 0, 0), (41, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    found = quality.judged(docs, labels).select("row.*", "low", F.col("rejected").alias("gone")).collect()
    assert len(found) == len(rows)
    assert {r.gone for r in found if r.doc_id == 40} == {True}
    assert not any(r.gone for r in found if r.doc_id in (43, 44, None) or (r.doc_id or 99) < 25)
    assert all(r.low is None for r in found if r.doc_id in (43, 44))
    assert quality.judged(docs.limit(0), labels).collect() == []
    assert not any(r.rejected for r in quality.judged(docs, labels.limit(0)).collect())


def test_query_keeps_the_good_and_rejects_the_bad(spark):
    path = "/root/testdata/sf0.1"
    found = QUERIES["op9_kneser_ney"](spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").groupBy("quality", "toxic").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {(r.quality, r.toxic): r.kept for r in found}
    assert share[1, 0] > 0.985 and share[0, 0] < 0.1

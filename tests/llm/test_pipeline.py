import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from faremill.llm import fair_mix, quality
from faremill.llm.queries import tokenizer
from test_fair_mix import WORD, brute_targets
from test_quality import BruteModel, left_out
from test_simhash import brute_fingerprint, brute_groups

SMALL = "/root/testdata/sf0.001"
PRIVATE = re.compile(r"[^\s@]+@[^\s@]+\.[a-z]+|\b\d{13,19}\b|\b\d+\.\d+\.\d+\.\d+\b|\+\d \(\d+\) \d+-\d+|\b[0-9a-f]{40}\b")


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, and its input as the first."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(corpus_pipeline.written(stage(spark, found[-1], SMALL), name.replace(" ", "-")))
    return found


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_names_and_columns(spark, stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "simhash near-dedup", "pii", "mixing", "bpe"]
    assert all(df.columns == stages[0].columns for df in stages[:-1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_stage(spark, stages):
    docs, kept = rows(stages[0]), set(rows(stages[1]))
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    good = {r.doc_id for r in labels if r.quality == 1 and r.toxic == 0} & docs.keys()
    expected = set(docs)
    for lang in {docs[i].lang for i in good}:
        model = BruteModel([docs[i].text for i in good if docs[i].lang == lang and not left_out(i)])
        low = {i: model.score(d.text)[1] for i, d in docs.items() if d.lang == lang}
        apart = sorted(math.floor(low[i] / 0.001) for i in good if docs[i].lang == lang and left_out(i))
        if apart:
            limit = (apart[math.ceil(len(apart) * quality.QUANTILE) - 1] + 1) * 0.001
            expected -= {i for i, x in low.items() if x > limit}
    assert kept == expected and 0 < len(kept) < len(docs)


def test_near_copies_stage(stages):
    before, kept = rows(stages[1]), set(rows(stages[2]))
    groups = brute_groups({i: brute_fingerprint(r.text) for i, r in before.items()})
    assert kept == set(groups.values()) and len(kept) < len(before)


def test_private_data_stage(stages):
    before, after = rows(stages[2]), rows(stages[3])
    assert before.keys() == after.keys()
    for i, row in before.items():
        assert PRIVATE.sub("", row.text) == PRIVATE.sub("", after[i].text) and row[2:] == after[i][2:]
        assert not any(v in after[i].text for v in PRIVATE.findall(row.text))


def test_mixing_stage(spark, stages):
    before = rows(stages[3])
    size = {i: len(WORD.findall(r.text)) for i, r in before.items()}
    total = Counter()
    for i, r in before.items():
        total[r.source] += size[i]
    target, queue = brute_targets(dict(total)), []
    order = {r.doc_id: r.shuffled for r in fair_mix.sized(stages[3]).collect()}
    for source in total:
        mine = sorted((i for i, r in before.items() if r.source == source and size[i]), key=order.get)
        upto = 0
        for epoch in range(3):
            for i in mine:
                if upto < target[source]:
                    queue.append(((upto + size[i]) / target[source], source, order[i], i))
                upto += size[i]
    taken, served = Counter(), 0
    for *_, i in sorted(queue):
        served += size[i]
        if served > sum(total.values()):
            break
        taken[i] += 1
    assert Counter(r.doc_id for r in stages[4].collect()) == taken


def test_encoding_stage_and_run(spark, stages):
    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    expected = Counter()
    for r in stages[4].collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        expected[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()] += 1
    assert Counter(map(tuple, stages[5].collect())) == expected
    assert Counter(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == expected


def test_odd_and_no_documents(spark, tmp_path):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "words of a text", "en", "s", 4),
                                 (2, "words of a text", "en", "s", 4), (3, "a b " * 30_000, None, "s", 4)], table.schema)
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} <= {2, 3} and found
    table.limit(0).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).filter(F.lit(True)).collect() == []

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from faremill.llm import bpe
from faremill.llm.chunks import per_text
from faremill.llm.queries import QUERIES, tokenizer

PATH = tokenizer("byte_bpe_50k.json")
ODD = ["", "  a  b\n\n c \t\n d", "<|endoftext|>hi <|endoftext|> \n", "a b 　 c", "x'll  don't 123 4५६ 漢字 🎉🎉 é",
       " lead", "\nlead", "trail \n", "a" * 500, "\x1c \x1d a\x85b", "aaaa aaa aa a", "the the\nthe", "\x00"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts(count, seed):
    pick = random.Random(seed)
    return ["".join(pick.choice("ab  \n\t'stlre12.!é漢🎉ZΣ") for _ in range(pick.randint(0, 60))) for _ in range(count)]


def test_ids_and_texts_equal_those_of_the_library(library):
    texts = ODD + random_texts(3000, 1)
    encoder = bpe.PrefixBPE(PATH)
    ids, ends = encoder.encode(pa.array(texts))
    expected = library.encode_batch(texts, add_special_tokens=False)
    assert [list(x) for x in per_text(ids, ends)] == [e.ids for e in expected]
    assert encoder.decode(ids, ends) == [library.decode(e.ids, skip_special_tokens=False) for e in expected]


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_PAIRS", 3)
    monkeypatch.setattr(bpe, "MOST_STEPS", 3)
    encoder = bpe.PrefixBPE(PATH)
    encoder.codes.remembered = 5
    texts = random_texts(300, 2) + ["some ordinary words here", "some other words there"]
    for _ in range(2):
        ids, ends = encoder.encode(pa.array(texts))
        assert [list(x) for x in per_text(ids, ends)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(1, "some words", "x"), (1, "some words", "x"), (None, None, None), (2, "", "y"), (3, "word " * 40_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = sorted(map(tuple, bpe.round_trip(docs, PATH).collect()), key=str)
    expected = []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == sorted(expected, key=str)
    back = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert sorted(map(tuple, back.collect()), key=str) == sorted([(r[0], r[1] or "") for r in rows], key=str)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(empty, PATH).collect() == []
    assert bpe.decode(bpe.encode(empty, PATH), PATH).schema == T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def test_query_against_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    found = {r.doc_id: r for r in QUERIES["op8_bpe_prefixes"](spark, "/root/testdata/sf0.001").collect()}
    assert found.keys() == docs.keys()
    for doc_id, text in docs.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert found[doc_id].n_tokens == len(ids)
        assert found[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()

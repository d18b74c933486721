import random
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from faremill.llm import simple8b, token_files
from faremill.llm.queries import QUERIES, tokenizer

PATH = tokenizer("word_bpe_49k.json")
RANDOM = np.random.default_rng(1)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("count", [0, 1, 59, 60, 61, 1023, 1024, 1025, 5000])
@pytest.mark.parametrize("values", [
    lambda n: RANDOM.integers(0, 49408, n), lambda n: RANDOM.integers(0, 2, n), lambda n: np.zeros(n),
    lambda n: RANDOM.integers(0, 1 << 63, n), lambda n: np.full(n, (1 << 64) - 1, np.uint64), lambda n: 2.0 ** RANDOM.uniform(0, 63, n)])
def test_packed_ids_come_back(monkeypatch, count, values):
    monkeypatch.setattr(simple8b, "_AT_ONCE", 2)
    ids = np.asarray(values(count)).astype(np.uint64)
    words, offsets, escapes = simple8b.pack(ids)
    assert len(offsets) == -(-count // 1024) + 1 and offsets[-1] == len(words)
    assert (simple8b.unpack(words, offsets, escapes, count) == ids).all()


def test_a_word_holds_as_many_ids_as_fit():
    words, offsets, escapes = simple8b.pack(np.array([1] * 60 + [49407] * 4 + [1 << 61], np.uint64))
    assert [int(w >> np.uint64(60)) for w in words[:1]] == [1] and len(escapes) == 1
    assert len(words) == 1 + 2 + 1


def test_a_cut_file_is_refused():
    data = token_files.file_bytes(np.array([1]), np.array([3]), np.array([5, 6, 1]))
    assert [a.tolist() for a in token_files.read_bytes(data)] == [[1], [3], [5, 6, 1]]
    for broken in (data[:-8], data[8:], data[:16] + data[24:]):
        with pytest.raises(ValueError):
            token_files.read_bytes(broken)


def expected(library, rows):
    at, found = 0, []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        found.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return found


def digests(tokens):
    return sorted(map(tuple, tokens.select("doc_id", "start", "n_tokens", F.crc32("ids")).collect()), key=lambda r: (r[1], r[0] or 0))


def test_odd_texts(spark, library):
    texts = ["", None, "  A  b\n\nc\td ", "Don't, İstanbul. ΣΑΣ Σ, é é", "<|endoftext|> x <|startoftext|>y", "a\x85b c　d", "漢字, 12 345.", "word, " * 30_000, ".", ",."]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string").repartition(4)
    for size in (4 << 20, 10):
        assert digests(token_files.token_files(docs, PATH, file_ids=size)) == expected(library, rows)


def test_repeats_null_ids_and_no_rows(spark, library):
    rows = [(None, "first"), (3, "same text"), (3, "same text"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert digests(token_files.token_files(docs, PATH)) == expected(library, rows)
    assert token_files.token_files(docs.limit(0), PATH).collect() == []


def test_query_against_the_library(spark, library):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = sorted(map(tuple, QUERIES["op4_simple8b"](spark, "/root/testdata/sf0.001").collect()))
    assert found == expected(library, rows)


def test_signs_are_parted_after_what_stays_a_letter():
    before = re.compile(token_files._CLOSED)
    for letter in map(chr, range(0x110000 - 0x800)):
        if before.match(f"{letter}, "):
            assert unicodedata.normalize("NFC", letter) == letter and all(c.isalnum() for c in letter.lower())


def test_signs_after_words(library):
    pick = random.Random(11)
    parts = ["a", "Z", "é", "ß", "İ", "Σ", "e\u0301", "7", "'s", "'", ",", ".", "...", "?!", ";", ":", " ", " ", "\n", "\u0338", "<", "-", "漢", "\u200d", "ʼ"]
    texts = ["".join(pick.choices(parts, k=pick.randrange(1, 30))) for _ in range(3000)]
    tokenizer = token_files.WordTokenizer(PATH)
    for some in (texts[:1500], [*texts[1500:], "A, <|ENDOFTEXT|>, b. <|endoftext|>, C."]):
        ids, ends = tokenizer.encode(pa.array(some))
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == [e.ids for e in library.encode_batch(some, add_special_tokens=False)]


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(token_files, "_PIECES", 20)
    monkeypatch.setattr(token_files, "_PIECE_LETTERS", 30)
    tokenizer = token_files.WordTokenizer(PATH)
    tokenizer.codes.remembered = 15
    texts = [f"word{i} other, and {'long' * (i % 90)} {i % 7}" for i in range(300)]
    for at in range(0, 300, 20):
        part = texts[at:at + 20] + texts[:5]
        ids, ends = tokenizer.encode(pa.array(part))
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
    assert len(tokenizer.pieces) < 200 and all(len(p) <= 30 for p in tokenizer.pieces)

"""Token ids as binary files of Simple-8b blocks, written and read back.

A file holds whole documents in order: a header, the packed words, the start of every block,
the escaped values, the ids and lengths of the documents, and a trailer with the counts. A
table next to the files, the manifest, names the files of finished tasks; a task that is run
again writes under another name, and only the file that its result names is part of the set.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from faremill.llm import simple8b
from faremill.llm.bpe import byte_letters
from faremill.llm.chunks import ChunkCodes, texts_of
from faremill.llm.common import bounded_batches, written
from faremill.session import scratch_path
from faremill.sources.stores import write_file

# Fixed values of the format.
MAGIC = b"IDS8B\x00\x00\x01"
COUNTS = np.dtype("<i8")
WORD = np.dtype("<u8")
NO_ID = np.iinfo(np.int64).min

END_ID = 1
FILE_IDS = 1 << 20
# Pieces remembered, each of at most so many letters.
_PIECES = 400_000
_PIECE_LETTERS = 100
# Signs that end a word before a space, after digits and letters of which no Unicode version doubts
# and that stay letters when they are lowered, which the dotted capital I (0130) does not.
_CLOSED = "([0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f])([,.;:!?]+) "


class _Pieces(dict):
    """Ids of pieces by their letters, worked out at the first mention."""

    def __init__(self, ids):
        super().__init__()
        self.ids = ids

    def __missing__(self, piece: str) -> tuple[int, ...]:
        found = self.ids(piece)
        if len(piece) <= _PIECE_LETTERS:
            self[piece] = found
        return found

    def trim(self) -> None:
        """Leave the newer half where there are too many."""
        if len(self) > _PIECES:
            newer = list(islice(self.items(), len(self) // 2, None))
            self.clear()
            self.update(newer)


class WordTokenizer:
    """Ids of texts by the library, for a vocabulary that drops white space.

    Such a tokenizer treats what spaces and line feeds separate independently. A chunk of
    ordinary characters is normalized and cut as its file says, and the library's model merges
    each distinct piece once; any other chunk goes through the library as a whole.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.cut, self.model = regex.compile(pattern).findall, self.library.model
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.pieces = _Pieces(self._piece)
        self.codes = ChunkCodes(self._chunks)

    def _piece(self, piece: str) -> tuple[int, ...]:
        spelt = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return tuple([t.id for t in self.model.tokenize(spelt)])

    def _chunk(self, chunk: str) -> Sequence[int]:
        # The library lowers letter by letter, without regard to where in a word they stand.
        low = chunk.lower() if chunk.isascii() else "".join(map(str.lower, unicodedata.normalize("NFC", chunk)))
        if low.isalpha():
            return self.pieces[low]
        if not chunk.isprintable() or any(s in chunk for s in self.special):
            return self.library.encode(chunk, add_special_tokens=False).ids
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.cut(low))))

    def _chunks(self, chunks: list[str]) -> list[Sequence[int]]:
        self.pieces.trim()
        return list(map(self._chunk, chunks))

    def encode(self, texts: pa.Array):
        """Ids of texts one after another, and where each text ends."""
        lines = pc.replace_substring(texts_of(texts), "\n", " ")
        if not any(pc.any(pc.match_substring(lines, sign, ignore_case=True)).as_py() for sign in self.special):
            # Fewer chunks differ once letters are low and closing signs stand alone, which they
            # are to the tokenizer anyway.
            lines = pc.ascii_lower(pc.replace_substring_regex(lines, _CLOSED, r"\1 \2 "))
        return self.codes.ids(pc.split_pattern(lines, " "))


@functools.lru_cache(maxsize=2)
def loaded(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def file_bytes(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, block_ids: int = simple8b.BLOCK_IDS) -> bytes:
    words, offsets, escapes = simple8b.pack(ids, block_ids)
    counts = np.array([len(ids), len(doc_ids), len(offsets) - 1, len(words), len(escapes), block_ids], COUNTS)
    parts = [words.astype(WORD), offsets.astype(COUNTS), escapes.astype(WORD), doc_ids.astype(COUNTS), lengths.astype(COUNTS), counts]
    return b"".join([MAGIC, *(p.tobytes() for p in parts), MAGIC])


def read_bytes(data: bytes):
    """(doc_ids, lengths, ids) of a file; raises ValueError unless it is whole."""
    if data[:8] != MAGIC or data[-8:] != MAGIC:
        raise ValueError("not a whole file of token ids")
    total, docs, blocks, words, escapes, block_ids = np.frombuffer(data, COUNTS, 6, len(data) - 56).tolist()
    if len(data) != 8 * (words + blocks + 1 + escapes + 2 * docs + 6 + 2):
        raise ValueError("a file of token ids has another size than its trailer says")
    at, parts = 8, []
    for kind, count in ((WORD, words), (COUNTS, blocks + 1), (WORD, escapes), (COUNTS, docs), (COUNTS, docs)):
        parts.append(np.frombuffer(data, kind, count, at))
        at += 8 * count
    return parts[3], parts[4], simple8b.unpack(parts[0], parts[1], parts[2], total, block_ids)


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int = END_ID, file_ids: int = FILE_IDS,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of every whole text, `end_id` after each, in ascending order of doc_id.

    Returns the manifest: file, part, number, ids, docs, ordered by (part, number). Null and
    empty texts have the end id only. Null ids come first; rows of one id are in the order of
    a hash, then of the text, so that a very frequent id is no single task.
    """
    spark = docs.sparkSession
    bounded_batches(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, context = loaded(path), TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        held, size, number = [], 0, 0

        def flush():
            nonlocal held, size, number
            doc_ids, lengths, ids = (np.concatenate(c) for c in zip(*held))
            name = f"{folder}/part-{part:06d}-{number:04d}-{attempt}.ids"
            write_file(name, file_bytes(doc_ids, lengths, ids))
            row = pa.RecordBatch.from_pylist(
                [{"file": name, "part": part, "number": number, "ids": len(ids), "docs": len(doc_ids)}], schema=kind)
            held, size, number = [], 0, number + 1
            return row

        for batch in batches:
            flat, ends = tokenizer.encode(batch.column(1))
            ids = np.insert(flat, ends, end_id)
            lengths = np.diff(ends, prepend=0) + 1
            doc_ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            held.append((doc_ids, lengths, ids))
            size += len(ids)
            if size >= file_ids:
                yield flush()
        if held:
            yield flush()

    kind = pa.schema([("file", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("ids", pa.int64()), ("docs", pa.int64())])
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = ["doc_id", F.xxhash64("text"), "text"]
    ranged = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    return written(ranged.mapInArrow(write, "file string, part int, number int, ids long, docs long"), "manifest")


def read_tokens(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """part, number, at, doc_id, n_tokens, ids (binary, little-endian 32 bits): documents read from the files.

    `at` counts the ids of the file before the document.
    """
    bounded_batches(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # This worker may have written before; reading needs nothing of what it remembers.
        loaded.cache_clear()
        for batch in batches:
            for row in range(batch.num_rows):
                doc_ids, lengths, ids = read_bytes(batch.column(2)[row].as_py())
                ends, raw = np.cumsum(lengths), memoryview(ids.astype("<u4").tobytes())
                offsets = pa.array(np.concatenate([[0], 4 * ends]), pa.int32())
                count = len(doc_ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column(0)[row].as_py()] * count, pa.int32()), pa.array([batch.column(1)[row].as_py()] * count, pa.int32()),
                    pa.array(ends - lengths), pa.array(doc_ids, mask=doc_ids == NO_ID), pa.array(lengths),
                    pa.Array.from_buffers(pa.binary(), count, [None, offsets.buffers()[1], pa.py_buffer(raw)])],
                    ["part", "number", "at", "doc_id", "n_tokens", "ids"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    named = manifest.select(F.element_at(F.split("file", "/"), -1).alias("name"), "part", "number")
    whole = files.join(named, "name").select("part", "number", "content")
    return whole.mapInArrow(read, "part int, number int, at long, doc_id long, n_tokens long, ids binary")


def starts(manifest: DataFrame) -> DataFrame:
    """part, number, before: the ids of all files before each file."""
    # One window over the table of files, a row per FILE_IDS ids.
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.select("part", "number", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("before"))


def token_files(docs: DataFrame, path: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """doc_id, start, n_tokens, ids of every document, read back from files written for it."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-ids")
    manifest = write_tokens(docs, path, folder, end_id, file_ids)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    return read_tokens(spark, manifest, folder).join(starts(manifest), ["part", "number"]).select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids")


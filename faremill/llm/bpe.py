"""Byte-level BPE by dynamic programming over prefixes.

The encoding of every prefix of a piece ends with one certain token. That token is the
longest token matching at the end of the prefix which the encoding of what is before it can
precede: it starts the piece, or the last token stored there and it are a compatible pair,
that is, encoding the two together gives back just these two. A trie of the
vocabulary with suffix links yields the matches, in place of a suffix automaton: what is asked
are the whole tokens that end at a place, and those are the marked states on its suffix links,
while an automaton of all factors of the tokens would have to sort them out. Back-pointers from
the whole piece give the ids. The work is linear in the piece, however long.

Whether two tokens are compatible follows from their merge trees. In the order of the merge
ranks the token left of the border and the one right of it grow up the two trees; they are
incompatible if the rule that joins what stands at the border comes before the next growth.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.chunks import ChunkCodes, per_text, texts_of
from faremill.llm.common import bounded_batches

# White space, and how the byte-level scheme cuts a text into pieces.
SPACE = r"\t-\r \x85\xa0  -     　"
PIECES = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
          rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
_SPACES_RE2 = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}"
_NEVER = 1 << 60
# Remembered answers; beyond that they are found anew.
MOST_PAIRS = 1_000_000
MOST_STEPS = 1_500_000


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: printable Latin-1 for itself, the rest in order from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class SuffixMatches:
    """Which tokens end at each position of a text: a trie of the tokens with suffix links.

    A state is the longest suffix read that starts a token; `ending` lists the tokens that
    are suffixes of it, the longest first. Steps that follow links are kept once resolved.
    """

    def __init__(self, tokens: Iterable[tuple[int, bytes]]):
        self.step: dict[int, int] = {}
        self.link, own, depth, byte_of = [0], [()], [0], [0]
        children: list[list[int]] = [[]]
        for token, raw in tokens:
            state = 0
            for byte in raw:
                key = state << 8 | byte
                state = self.step.get(key, -1)
                if state < 0:
                    state = self.step[key] = len(own)
                    children[key >> 8].append(state)
                    children.append([])
                    own.append(())
                    self.link.append(0)
                    depth.append(depth[key >> 8] + 1)
                    byte_of.append(byte)
            own[state] = ((token, len(raw)),)
        self.ending = own
        level = children[0]
        while level:
            for state in level:
                for child in children[state]:
                    self.link[child] = self._next(self.link[state], byte_of[child])
                self.ending[state] += self.ending[self.link[state]]
            level = [child for state in level for child in children[state]]

    def _next(self, state: int, byte: int) -> int:
        while (found := self.step.get(state << 8 | byte, -1)) < 0 and state:
            state = self.link[state]
        return max(found, 0)

    def resolve(self, state: int, byte: int) -> int:
        found = self._next(state, byte)
        if len(self.step) < MOST_STEPS:
            self.step[state << 8 | byte] = found
        return found


class PrefixBPE:
    """Encoder and decoder for one vocabulary file of the byte-level kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocabulary = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes: dict[int, bytes] = {i: bytes(letters[c] for c in s) for s, i in vocabulary.items() if s not in self.special}
        self.bytes |= {i: s.encode() for s, i in self.special.items()}
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            left, right = vocabulary[a], vocabulary[b]
            self.pair_rank[left, right] = rank
            self.parts.setdefault(vocabulary[a + b], (left, right, rank))
        self._right_edge, self._left_edge = {}, {}
        self.compatible: dict[int, bool] = {}
        self.stable: dict[int, bool] = {}
        self.matches = SuffixMatches(
            (i, self.bytes[i]) for s, i in vocabulary.items() if s not in self.special and self._stable(i))
        self.pieces = regex.compile(PIECES)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.unsafe = "|".join([_SPACES_RE2, *map(regex.escape, self.special)])
        self.token_bytes = pa.array([self.bytes.get(i, b"") for i in range(max(self.bytes) + 1)], pa.large_binary())
        self.token_digits = pa.array([f"{i}," for i in range(max(self.bytes) + 1)], pa.large_string())
        self.codes = ChunkCodes(self._chunks)

    def _edge(self, token: int, side: int, known: dict) -> list[tuple[int, int]]:
        """The tokens on one edge of a merge tree, the leaf first, each with the rank that makes the next."""
        found = known.get(token)
        if found is None:
            edge, above, at = [], _NEVER, token
            while at in self.parts:
                edge.append((at, above))
                above, at = self.parts[at][2], self.parts[at][side]
            edge.append((at, above))
            found = known[token] = edge[::-1]
        return found

    def _meet(self, a: int, b: int) -> int:
        """The rank at which tokens a and b side by side merge over their border, or never."""
        left, right = self._edge(a, 1, self._right_edge), self._edge(b, 0, self._left_edge)
        i = j = 0
        while True:
            (x, grow_x), (y, grow_y) = left[i], right[j]
            rank = self.pair_rank.get((x, y), _NEVER)
            # Of equal rules the leftmost goes first: growth on the left, then the border.
            if rank < grow_x and rank <= grow_y:
                return rank
            if grow_x == grow_y == _NEVER:
                return _NEVER
            if grow_x <= grow_y:
                i += 1
            else:
                j += 1

    def _stable(self, token: int) -> bool:
        """Whether the bytes of a token encode to that token."""
        if token not in self.parts:
            return True
        known = self.stable.get(token)
        if known is None:
            left, right, rank = self.parts[token]
            known = self._stable(left) and self._stable(right) and self._meet(left, right) == rank
            self.stable[token] = known
        return known

    def _fits(self, pair: int) -> bool:
        if len(self.compatible) > MOST_PAIRS:
            self.compatible.clear()
        known = self.compatible[pair] = self._meet(pair >> 32, pair & 0xFFFFFFFF) == _NEVER
        return known

    def encode_pieces(self, pieces: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Ids of pieces. In sorted order, what two share at their start is done once."""
        coded: dict[bytes, list[int]] = {}
        compatible, step, ending = self.compatible, self.matches.step, self.matches.ending
        states, last, size, before = [0], [], [], b""
        for piece in sorted(pieces):
            same = 0
            for x, y in zip(before, piece):
                if x != y:
                    break
                same += 1
            del states[same + 1:], last[same:], size[same:]
            state, at, before = states[same], same, piece
            for byte in piece[same:]:
                state = step.get(state << 8 | byte, -1)
                if state < 0:
                    state = self.matches.resolve(states[-1], byte)
                states.append(state)
                for token, length in ending[state]:  # the longest first
                    if length > at:
                        break
                    pair = last[at - length] << 32 | token
                    fits = compatible.get(pair)
                    if fits is None:
                        fits = self._fits(pair)
                    if fits:
                        break
                last.append(token)
                size.append(length)
                at += 1
            ids, at = [], len(piece) - 1
            while at >= 0:
                ids.append(last[at])
                at -= size[at]
            coded[piece] = ids[::-1]
        return coded

    def _join(self, cut: list[list[str]]) -> list[list[int]]:
        coded = self.encode_pieces({p.encode() for pieces in cut for p in pieces})
        return [[i for p in pieces for i in coded[p.encode()]] for pieces in cut]

    def _chunks(self, chunks: list[str]) -> list[list[int]]:
        """Chunks after a line feed start with it; any other follows a space."""
        findall, cut = self.pieces.findall, []
        for chunk in chunks:
            if chunk.isalpha():
                cut.append([" " + chunk])
            elif chunk.startswith("\n"):
                cut.append(["\n", *findall(chunk[1:])])
            else:
                cut.append(findall(" " + chunk))
        return self._join(cut)

    def _plain(self, text: str) -> list[int]:
        return self._join([self.pieces.findall(text)])[0]

    def whole(self, text: str) -> list[int]:
        """Ids of any text; strings of special tokens become their ids."""
        if not self.cut:
            return self._plain(text)
        return [i for part in self.cut.split(text) if part
                for i in ([self.special[part]] if part in self.special else self._plain(part))]

    def encode(self, texts: pa.Array):
        """Ids of texts one after another, and where each text ends.

        Where no two white-space characters touch, a text is cut before every space and line
        feed without changing its pieces, and distinct chunks are encoded once.
        """
        texts = texts_of(texts)
        unsafe = pc.match_substring_regex(texts, self.unsafe).to_numpy(zero_copy_only=False).astype(bool)
        safe_texts = texts.filter(pa.array(~unsafe))
        marked = pc.binary_join_element_wise(
            pa.scalar("\n", pa.large_string()), pc.replace_substring(safe_texts, "\n", " \n"), pa.scalar("", pa.large_string()))
        flat, ends = self.codes.ids(pc.split_pattern(marked, " "))
        # The line feed put before the first chunk is one token.
        keep = np.ones(len(flat), bool)
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        keep[starts] = False
        flat, ends = flat[keep], ends - np.arange(1, len(ends) + 1)
        if not unsafe.any():
            return flat, ends
        easy = iter(per_text(flat, ends))
        coded = [np.array(self.whole(t), np.int32) if hard else next(easy)
                 for t, hard in zip(_strings(texts, unsafe), unsafe)]
        return np.concatenate(coded), np.cumsum([len(c) for c in coded])

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of ids one after another; bytes that are no UTF-8 become replacement characters."""
        taken = self.token_bytes.take(pa.array(ids))
        at = np.concatenate([[0], _byte_ends(taken)[ends]]) if len(ends) else []
        data = memoryview(taken.buffers()[2]) if len(ids) else memoryview(b"")
        return [str(data[a:b], "utf-8", "replace") for a, b in zip(at[:-1], at[1:])]

    def digits(self, ids: np.ndarray, ends: np.ndarray) -> list[memoryview]:
        """Decimal ids joined by commas, one value per text."""
        taken = self.token_digits.take(pa.array(ids))
        at = np.concatenate([[0], _byte_ends(taken)[ends]]) if len(ends) else []
        data = memoryview(taken.buffers()[2]) if len(ids) else memoryview(b"")
        return [data[a:max(a, b - 1)] for a, b in zip(at[:-1], at[1:])]


def _strings(texts: pa.Array, wanted: np.ndarray):
    return (texts[i].as_py() if w else None for i, w in enumerate(wanted))


def _byte_ends(taken: pa.Array) -> np.ndarray:
    return np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)


@functools.lru_cache(maxsize=2)
def loaded(path: str) -> PrefixBPE:
    """One encoder per worker and file."""
    return PrefixBPE(path)


def _packed(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int32()))


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of every row; a null or empty text has no ids."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _packed(*bpe.encode(batch.column(1)))], ["doc_id", "ids"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, f"doc_id {kind}, ids array<int>").withColumnRenamed("doc_id", doc_id)


def decode(tokens: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, text of every row of ids; null ids are none."""
    bounded_batches(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            lists = batch.column(1)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)).astype(np.int64)
            texts = bpe.decode(lists.flatten().to_numpy(zero_copy_only=False), ends)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = tokens.schema[doc_id].dataType.simpleString()
    return tokens.select(F.col(doc_id), F.col(ids)).mapInArrow(run, f"doc_id {kind}, text string").withColumnRenamed("doc_id", doc_id)


def round_trip(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, encoded and decoded in one pass.

    The first digest is of the decimal ids joined by commas, the second of the decoded text.
    Null and empty texts have no ids; repeated rows repeat; no rows give no rows.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            ids, ends = bpe.encode(batch.column(1))
            counts = np.diff(ends, prepend=0)
            coded = [hashlib.sha256(d).hexdigest() for d in bpe.digits(ids, ends)]
            back = [hashlib.sha256(t.encode()).hexdigest() for t in bpe.decode(ids, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("doc_id", doc_id)

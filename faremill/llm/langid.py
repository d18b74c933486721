"""The language of a text by cross-parsing against labelled text.

For each language a suffix automaton is built over a sample of its labelled text: whole texts,
and windows at hashed places of those that are too long, so that no language is left out. A text is
parsed against each: a phrase is the longest match that starts where the last one ended, found
by following the automaton until no transition fits. The language that needs the fewest
phrases per letter wins.

Texts are parsed without case, with everything between letters as one space, and in pieces of
`PIECE` letters, at whose end a phrase ends in all languages alike. All pieces of a batch are
parsed against all languages side by side, a letter at a time.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faremill.llm.common import bounded_batches, text_of, written

# The automata hold at most this many letters each, and in all, but never fewer than LEAST_LETTERS each.
SAMPLE_LETTERS = 24_000
ALL_LETTERS = 400_000
LEAST_LETTERS = 256
MOST_BYTES = 256 << 20
SAMPLE_TEXTS = 200
SHARES = 64
LONGEST_SAMPLE = 12_000
PIECE = 512
UNKNOWN = "und"
_LANES = 8192


@functools.cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def spelled(texts: list[str]):
    """(code points, ends) of texts in lower case: letters, with 0 for what is between them."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ends = np.cumsum([len(t) for t in low], dtype=np.int64)
    codes[~_letters()[codes]] = 0
    gap_before = np.ones(len(codes), bool)
    gap_before[1:] = codes[:-1] == 0
    gap_before[ends[:-1][ends[:-1] < len(codes)]] = True
    kept = (codes > 0) | ~gap_before
    return codes[kept], np.concatenate([[0], np.cumsum(kept)])[ends]


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """The transitions of the suffix automaton of a sequence."""
    steps, link, length = [{}], [-1], [0]
    last = 0
    for code in codes:
        new = len(steps)
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and code not in steps[at]:
            steps[at][code] = new
            at = link[at]
        if at >= 0:
            target = steps[at][code]
            if length[at] + 1 == length[target]:
                link[new] = target
            else:
                copy = len(steps)
                steps.append(dict(steps[target]))
                link.append(link[target])
                length.append(length[at] + 1)
                while at >= 0 and steps[at].get(code) == target:
                    steps[at][code] = copy
                    at = link[at]
                link[target] = link[new] = copy
        last = new
    return steps


def parse_table(steps: list[dict[int, int]], alphabet: np.ndarray) -> np.ndarray:
    """The transitions as rows of state, letter (its place in the alphabet) and next state; the number of states is at the end."""
    state = np.repeat(np.arange(len(steps)), [len(s) for s in steps])
    letter = np.searchsorted(alphabet, np.fromiter((c for s in steps for c in s), np.int64))
    target = np.fromiter((t for s in steps for t in s.values()), np.int64)
    return np.append(np.stack([state, letter, target], axis=1).ravel(), len(steps)).astype(np.int32)


def packed(state: np.ndarray, letter: np.ndarray, target: np.ndarray, states: int, width: int):
    """(base, owner, next): the transition of a state by a letter is at base + letter, if the state owns that place.

    Rows are laid over each other so that no two use one place: the fullest first, each round of
    them at drawn places, of which those stay that meet no other. The draws are seeded, so the
    same transitions give the same arrays; their size is four places a transition and one alphabet.
    """
    draw = np.random.default_rng(0)
    room = 4 * len(state) + 1
    base = np.zeros(states, np.int32)
    owner, after = np.full(room + width, -1, np.int32), np.zeros(room + width, np.int32)
    sizes = np.bincount(state, minlength=states)[state]
    least = 1 << max(int(sizes.max(initial=1)).bit_length() - 1, 0)
    waiting = np.zeros(0, np.int64)
    while least:
        waiting = np.flatnonzero((sizes >= least) & (sizes < 2 * least))
        while len(waiting):
            rows, mine = np.unique(state[waiting], return_inverse=True)
            drawn = draw.integers(0, room, len(rows))
            places = drawn[mine] + letter[waiting]
            claims = np.full(len(owner), -1, np.int32)
            claims[places] = mine
            met = (claims[places] != mine) | (owner[places] >= 0)
            free = np.bincount(mine, met, len(rows)) == 0
            stay = free[mine]
            base[rows[free]] = drawn[free]
            owner[places[stay]], after[places[stay]] = state[waiting[stay]], target[waiting[stay]]
            waiting = waiting[~stay]
        least >>= 1
    return base, owner, after


class Parser:
    """Counts phrases of texts against several automata.

    All transitions are in arrays of 32 bits, four places for each and four bytes a state: at most
    some 110 bytes a learned letter, whatever the alphabets. More than `MOST_BYTES` is an error.
    """

    def __init__(self, languages: list[str], alphabet: np.ndarray, tables: list[np.ndarray]):
        self.languages, self.alphabet = languages, alphabet
        first = np.cumsum([0] + [int(t[-1]) for t in tables])
        self.roots = first[:-1].astype(np.int32)
        rows = [t[:-1].reshape(-1, 3) + np.array([f, 0, f], np.int32) for t, f in zip(tables, self.roots)]
        state, letter, target = np.concatenate(rows or [np.zeros((0, 3), np.int32)]).T
        size = 32 * len(state) + 4 * int(first[-1])
        if size > MOST_BYTES:
            raise ValueError(f"{len(languages)} languages need {size} bytes of transitions, more than the {MOST_BYTES} that are sent to tasks")
        self.base, self.owner, self.after = packed(state, letter, target, int(first[-1]), len(alphabet) + 1)

    def _follow(self, state: np.ndarray, symbol: np.ndarray):
        """(next state, whether there is one)."""
        place = self.base[state] + symbol
        return self.after[place], self.owner[place] == state

    def phrases(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        counts = np.zeros((len(ends), len(self.languages)), np.int64)
        if not len(codes):
            return counts
        at = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        symbols = np.where(self.alphabet[at] == codes, at, len(self.alphabet))
        starts = np.concatenate([[0], ends[:-1]])
        pieces = -(-(ends - starts) // PIECE)
        owner = np.repeat(np.arange(len(ends)), pieces)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = starts[owner] + number * PIECE
        length = np.minimum(ends[owner] - begin, PIECE)
        order = np.argsort(-length, kind="stable")
        for low in range(0, len(order), _LANES):
            lanes = order[low:low + _LANES]
            found = self._parse(symbols, begin[lanes], length[lanes])
            np.add.at(counts, owner[lanes], found.T)
        return counts

    def _parse(self, symbols: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        longest = int(length[0])
        grid = symbols[np.minimum(begin[None, :] + np.arange(longest)[:, None], len(symbols) - 1)]
        live = np.searchsorted(-length, -np.arange(longest), side="left")
        root = np.repeat(self.roots[:, None], len(begin), axis=1)
        state, ended = root.copy(), np.zeros(root.shape, np.int64)
        for step in range(longest):
            n = live[step]
            at, symbol = state[:, :n], np.broadcast_to(grid[step, :n], (len(root), n))
            value, found = self._follow(at, symbol)
            # Where none fits, the phrase ends and the letter starts the next; one that no phrase starts with is its own.
            lost = np.nonzero(~found)
            top = root[lost]
            fresh, starts = self._follow(top, symbol[lost])
            value[lost] = np.where(starts, fresh, top)
            ended[:, :n][lost] += np.where(starts, 1, 1 + (at[lost] != top))
            state[:, :n] = value
        return ended + (state != root)

    def best(self, texts: list[str]):
        """(language, score) of each text: fewest phrases per letter, and how far ahead of the next."""
        codes, ends = spelled(texts)
        counts = self.phrases(codes, ends)
        known = np.concatenate([[0], np.cumsum(codes > 0)])
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        letters = known[ends] - known[starts]
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        winner = counts.argmin(axis=1)
        ranked = np.sort(counts, axis=1)
        lead = np.ones(len(texts)) if counts.shape[1] == 1 else 1 - ranked[:, 0] / np.maximum(ranked[:, 1], 1)
        none = letters == 0
        return [UNKNOWN if n else self.languages[w] for n, w in zip(none, winner)], np.where(none, 0.0, lead)


def sample_texts(labelled: DataFrame) -> DataFrame:
    """lang, h, text: different texts of each language, the first by a hash of the text; a long one as a window at a hashed place.

    Ranked are the hashes alone; the texts of the chosen ones are fetched after that. The first
    of each of `SHARES` shares of a language go on to its last ranking, so no task ranks a
    whole language.
    """
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", F.xxhash64("text").alias("h"), "text")
    chosen = rows.select("lang", "h", F.pmod("h", F.lit(SHARES)).alias("share")).distinct()
    for keys in (["lang", "share"], ["lang"]):
        first = Window.partitionBy(*keys).orderBy("h")
        chosen = chosen.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= SAMPLE_TEXTS).drop("n")
    # Windows are taken of the letters, so that there are some in each.
    letters = F.regexp_replace("text", r"[^\p{L}]+", " ")
    place = F.pmod(F.col("h"), F.length("letters") - LONGEST_SAMPLE + 1).cast("int") + 1
    cut = rows.join(chosen, ["lang", "h"], "left_semi").withColumn("letters", F.when(F.length("text") > LONGEST_SAMPLE, letters))
    cut = cut.withColumn("text", F.when(F.length("letters") > LONGEST_SAMPLE, F.substr("letters", place, F.lit(LONGEST_SAMPLE))).otherwise(
        F.coalesce("letters", "text")))
    return cut.groupBy("lang", "h").agg(F.min("text").alias("text"))


def _build(bound: int):
    def build(sample: pd.DataFrame) -> pd.DataFrame:
        codes: list[np.ndarray] = []
        left = bound
        for h, text in sample.sort_values("h")[["h", "text"]].itertuples(index=False):
            spelt, _ = spelled([text])
            if left < 2:
                break
            if len(spelt) + 1 > left:  # a window of what does not fit, no more than a quarter, so that others have a place
                size = min(bound // 4, left - 1)
                place = h % (len(spelt) - size + 1)
                spelt = spelt[place:place + size]
            if spelt.any():
                codes.append(np.append(spelt, 0))
                left -= len(spelt) + 1
        whole = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        if not len(whole):
            return pd.DataFrame({"lang": [], "alphabet": [], "parsed": []})
        alphabet = np.unique(whole)
        table = parse_table(automaton(whole.tolist()), alphabet)
        return pd.DataFrame({"lang": [sample["lang"].iloc[0]], "alphabet": [alphabet.tolist()], "parsed": [table.tobytes()]})

    return build


def _widened(alphabet: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Transitions by the letters of one language as those by all letters."""
    wide = table.copy()
    wide[1:-1:3] = np.searchsorted(alphabet, own)[table[1:-1:3]]
    return wide


def train(labelled: DataFrame) -> Parser:
    """A parser from (lang, text): a bounded sample per language, an automaton per language in a task of its own."""
    sample = written(sample_texts(labelled), "samples")
    languages = sample.select("lang").distinct().count()
    bound = max(min(SAMPLE_LETTERS, ALL_LETTERS // max(languages, 1)), LEAST_LETTERS)
    # A row per language: three transitions a letter at most, of 12 bytes.
    built = sorted(sample.groupBy("lang").applyInPandas(
        _build(bound), "lang string, alphabet array<long>, parsed binary").collect(), key=lambda r: r.lang)
    alphabet = np.unique(np.concatenate([np.array(r.alphabet, np.int64) for r in built])) if built else np.zeros(1, np.int64)
    tables = [_widened(alphabet, np.array(r.alphabet), np.frombuffer(r.parsed, np.int32)) for r in built]
    return Parser([r.lang for r in built], alphabet, tables)


def with_language(docs: DataFrame, parser: Parser, text: str = "text", name: str = "language") -> DataFrame:
    """docs with a struct (lang_pred, score) from the text alone.

    Texts that are null or have no letter are `und` with score 0, and so is every text where
    nothing was learned. Ties go to the language that sorts first. Repeated rows agree.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(parser)

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            languages, scores = shared.value.best(part.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(languages, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return docs.withColumn(name, predict(text_of(docs[text])))


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept out of what is learned; an unknown id is neither learned from nor held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def languages_of(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document of (doc_id, text, lang)."""
    known = docs.filter(F.col("doc_id").isNotNull() & ~held_out()).select(F.col("lang").cast("string").alias("lang"), "text")
    parser = train(known)
    rows = with_language(docs.select("doc_id", "text"), parser)
    return rows.select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score")

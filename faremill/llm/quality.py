"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is one of characters: n-grams of order 5 per language, over code points, with the text
padded at both ends. It keeps growing with the corpus. Counts come from the trusted documents but
a quarter of them, told by a hash of the id, which is left out for the thresholds. Lower orders count how
many different characters come before an n-gram; each order has three discounts from its own
counts of counts, and hands the mass it saves to the order below.

All n-grams, those of the model and those asked for, are sharded by language and n-gram, and what
one is worth comes from joins between the shards, order by order. Documents are dealt to blocks of
some 128 MB of text, or 64 where the texts come back with their scores. A block asks once for each
different n-gram in it, however often it occurs, the answers are joined to the questions, and then
stream through a task ahead of the texts of the block. Nothing is sent to the driver or to all tasks.

A document is judged by the lower end of an interval around its log perplexity, two standard
errors of its characters wide to each side, since the mean of a short text says little. It is
rejected when even that is above a quantile of the same for the left-out documents of its language.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.llm.common import bounded_batches, releasing, written

# An n-gram is two numbers: `lo` has its last three characters, `hi` those before.
ORDER = 5
BITS = 21
START, END = 0x110000, 0x110001
KEYS = ["lang", "hi", "lo"]

BLOCK_BYTES = 128 << 20
# Where texts come back with their scores, a task holds its block sorted and a row group of what it writes.
TEXT_BLOCK_BYTES = 64 << 20
ROW_GROUP_BYTES = 16 << 20
BATCH_BYTES = 4 << 20
WINDOW = 1 << 19
HELD_GRAMS = 2_000_000
LEFT_OUT = 4
QUANTILE = 0.99
ERRORS = 2.0
BIN = 0.001
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """`written`, with the shuffle files of the job deleted after it: the table stands for them."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        return written(df, name, **options)
    finally:
        spark.conf.set(CLEANUP, before)


def windows(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hi, lo, row): the n-gram that ends at each character and at the end of each text, in bounded pieces."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + ORDER
    ends = np.cumsum(lengths)
    codes = np.full(int(ends[-1]) if len(ends) else 0, START, np.uint32)
    inside = np.ones(len(codes), bool)
    for i in range(ORDER - 1):
        inside[ends - lengths + i] = False
    real = inside.copy()
    inside[ends - 1] = False
    codes[inside] = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)
    codes[ends - 1] = END
    for low in range(ORDER - 1, len(codes), WINDOW):
        high = min(low + WINDOW, len(codes))
        part = codes[low - ORDER + 1:high].astype(np.int64)
        triples = part[:-2] << 2 * BITS | part[1:-1] << BITS | part[2:]
        keep = real[low:high]
        row = np.searchsorted(ends, np.arange(low, high), side="right")
        yield _before(part, high - low)[keep], triples[ORDER - 3:][keep], row[keep]


def _before(part: np.ndarray, size: int) -> np.ndarray:
    """The first ORDER - 3 characters of the n-grams that start at the first `size` places."""
    return reduce(lambda found, i: found << BITS | part[i:i + size], range(ORDER - 3), np.zeros(size, np.int64))


def distinct(hi: np.ndarray, lo: np.ndarray):
    """(hi, lo, which): the different pairs, and the place of each pair among them."""
    first, last = (pa.array(a).dictionary_encode() for a in (hi, lo))
    pairs = pa.array(first.indices.to_numpy().astype(np.int64) << 32 | last.indices.to_numpy()).dictionary_encode()
    found = pairs.dictionary.to_numpy()
    return first.dictionary.to_numpy()[found >> 32], last.dictionary.to_numpy()[found & 0xFFFFFFFF], pairs.indices.to_numpy()


def _languages(column: pa.Array):
    """(code of each row, languages): rows without a language have none (-1)."""
    coded = column.cast(pa.string()).dictionary_encode()
    return pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def _summed(tables: list[pa.Table]) -> list[pa.Table]:
    found = pa.concat_tables(tables).group_by(["block", *KEYS]).aggregate([("n", "sum")]).rename_columns(["block", *KEYS, "n"])
    return [found.cast(tables[0].schema)]


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(block, kind, rows) of a batch sorted by its first two columns."""
    blocks, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
    for low, high in zip([0, *cuts], [*cuts, len(blocks)]):
        if high > low:
            yield blocks[low], kinds[low], batch.slice(low, high - low)


def _grams(block: int, part: pa.RecordBatch, trusted: pa.Array) -> Iterator[pa.Table]:
    """The different n-grams of some rows (.., id, lang, text) by language and window, with their number in trusted texts."""
    which, names = _languages(part.column("lang"))
    counted = pc.is_in(part.column("id"), value_set=trusted).to_numpy(zero_copy_only=False).astype(np.int64)
    for code, name in enumerate(names):
        mine = np.flatnonzero(which == code)
        for hi, lo, row in windows(part.column("text").take(pa.array(mine))):
            hi, lo, place = distinct(hi, lo)
            n = np.bincount(place, counted[mine][row], len(hi)).astype(np.int64)
            yield pa.table([pa.array(np.full(len(hi), block), pa.int32()), pa.array([name] * len(hi), pa.string()),
                            pa.array(hi), pa.array(lo), pa.array(n)], ["block", *KEYS, "n"])


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (block, kind, id, lang, text), counted ids first in each block: the different n-grams of a block."""
    at, ids, held, rows, least = None, [], [], 0, HELD_GRAMS
    for batch in batches:
        for block, kind, part in _runs(batch):
            if block != at:
                at, ids, trusted = block, [], None
            if kind == 0:
                ids.append(part.column("id"))
                continue
            trusted = pa.concat_arrays(ids) if trusted is None and ids else pa.array([], pa.string()) if trusted is None else trusted
            for found in _grams(block, part, trusted):
                held.append(found)
                rows += len(found)
        if rows > least:
            held = _summed(held)
            rows = len(held[0])
            least = rows + HELD_GRAMS
            if rows > 2 * HELD_GRAMS:  # what is given away here is summed by the shuffle
                yield from held[0].to_batches(100_000)
                held, rows, least = [], 0, HELD_GRAMS
    if held:
        yield from _summed(held)[0].to_batches(100_000)


def _discounts(grams: DataFrame) -> DataFrame:
    """lang, d1, d2, d3: the discounts of an order; where a count of counts is zero, those of absolute discounting by a half."""
    n = grams.filter("n > 0").groupBy("lang").agg(*(F.sum((F.col("n") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)))
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    found = [i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}")) for i in (1, 2, 3)]
    return n.select("lang", *(
        F.when((d > 0) & (d < i), d).otherwise(F.lit(0.5)).alias(f"d{i}") for i, d in zip((1, 2, 3), found)))


def _suffix(order: int) -> list[Column]:
    """hi, lo of the last `order` characters."""
    low = (1 << min(order, 3) * BITS) - 1
    high = (1 << max(order - 3, 0) * BITS) - 1
    return [F.col("hi").bitwiseAND(high).alias("hi"), F.col("lo").bitwiseAND(low).alias("lo")]


def _context() -> list[Column]:
    """The n-gram without its last character."""
    last = F.col("hi").bitwiseAND((1 << BITS) - 1)
    return [F.shiftright("hi", BITS).alias("before"), F.shiftleft(last, 2 * BITS).bitwiseOR(F.shiftright("lo", BITS)).alias("context")]


def log_chances(grams: DataFrame) -> DataFrame:
    """lang, hi, lo, value: minus the log probability of each n-gram of (lang, hi, lo, n).

    n is the count in trusted text, 0 for those only asked for. Those of a language without
    trusted text are left out.
    """
    orders = {ORDER: grams}
    for order in range(ORDER - 1, 0, -1):  # asked are also all endings; a seen one counts the different characters before it
        orders[order] = _table(orders[order + 1].select("lang", *_suffix(order), F.col("n")).groupBy(*KEYS).agg(
            F.sum((F.col("n") > 0).cast("long")).alias("n")), f"grams{order}")
    below = None
    for order in range(1, ORDER + 1):
        capped = F.least("n", F.lit(3))
        discount = F.when(capped == 1, F.col("d1")).when(capped == 2, F.col("d2")).when(capped == 3, F.col("d3")).otherwise(0.0)
        seen = orders[order].join(_discounts(orders[order]), "lang").select(*KEYS, *_context(), "n", discount.alias("discount"))
        totals = seen.filter("n > 0").groupBy("lang", "before", "context").agg(
            F.sum("n").alias("total"), F.sum("discount").alias("saved"), F.count(F.lit(1)).alias("kinds"))
        found = seen.join(totals, ["lang", "before", "context"], "left")
        own = (F.col("n") - F.col("discount")) / F.col("total")
        share = F.col("saved") / F.col("total")
        if below is None:  # what is left goes to all characters, and one unseen one, alike
            chance = own + share / (F.col("kinds") + 1)
        else:
            found = found.withColumns({"end_hi": _suffix(order - 1)[0], "end_lo": _suffix(order - 1)[1]}).join(
                below.select("lang", F.col("hi").alias("end_hi"), F.col("lo").alias("end_lo"), F.col("chance").alias("lower")), ["lang", "end_hi", "end_lo"])
            chance = F.when(F.col("total").isNull(), F.col("lower")).otherwise(own + share * F.col("lower"))
        below = _table(found.select(*KEYS, chance.alias("chance")), f"chances{order}")
    return below.select(*KEYS, (-F.log("chance")).alias("value"))


ANSWERS = "block int, kind int, name string, his array<long>, los array<long>, values array<double>"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers (block, lang, hi, lo, value) by the batch, as rows of arrays per block and language."""
    for batch in batches:
        which, names = _languages(batch.column(1))
        blocks, *columns = (batch.column(i).to_numpy() for i in (0, 2, 3, 4))
        order = np.lexsort((columns[1], columns[0], which, blocks))
        cuts = np.flatnonzero((np.diff(blocks[order]) != 0) | (np.diff(which[order]) != 0)) + 1
        rows = np.split(order, cuts) if len(order) else []
        lists = [pa.ListArray.from_arrays(np.concatenate([[0], cuts, [len(order)]]).astype(np.int32), c[order]) for c in columns] if rows else []
        if rows:
            yield pa.RecordBatch.from_arrays([
                pa.array([blocks[r[0]] for r in rows], pa.int32()), pa.array([0] * len(rows), pa.int32()),
                pa.array([names[which[r[0]]] for r in rows], pa.string()), *lists], ["block", "kind", "name", "his", "los", "values"])


class Answers:
    """What the n-grams of one language in a block are worth."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        hi, lo, values = (np.concatenate(c) for c in zip(*parts))
        self.his, self.los = np.unique(hi), np.unique(lo)
        keys = self._keys(hi, lo)
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], values[order]

    def _keys(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.his, hi) * len(self.los) + np.searchsorted(self.los, lo)

    def of(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """All n-grams of the block were asked for, so each is here."""
        return self.values[np.searchsorted(self.keys, self._keys(hi, lo))]


def scores_of(texts: pa.Array, answers: Answers) -> tuple[np.ndarray, np.ndarray]:
    """(mean, low) of each text."""
    count, total, square = (np.zeros(len(texts)) for _ in range(3))
    for hi, lo, row in windows(texts):
        hi, lo, place = distinct(hi, lo)
        values = answers.of(hi, lo)[place]
        count += np.bincount(row, minlength=len(texts))
        total += np.bincount(row, values, len(texts))
        square += np.bincount(row, values * values, len(texts))
    mean = total / count
    spread = np.maximum(square / count - mean * mean, 0)
    return mean, mean - ERRORS * np.sqrt(spread / count)


def _scored(with_text: bool):
    """Rows (block, kind, name, his, los, values, row, lang, text), answers first in each block, to scored rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, answers = None, {}, {}
        for batch in batches:
            for block, kind, part in _runs(batch):
                if block != at:
                    at, parts, answers = block, {}, {}
                if kind == 0:
                    for i, name in enumerate(part.column(2).to_pylist()):
                        parts.setdefault(name, []).append(tuple(part.column(c)[i].values.to_numpy() for c in (3, 4, 5)))
                    continue
                which, names = _languages(part.column(7))
                mean, least = np.full(len(part), np.nan), np.full(len(part), np.nan)
                for code, name in enumerate(names):
                    if name in parts:
                        answers[name] = Answers(parts.pop(name))
                    if name in answers:
                        mine = np.flatnonzero(which == code)
                        mean[mine], least[mine] = scores_of(part.column(8).take(pa.array(mine)), answers[name])
                none = np.isnan(mean)
                kept = {"row": part.column(6), "lang": part.column(7)} | ({"text": part.column(8)} if with_text else {})
                yield pa.RecordBatch.from_arrays([*kept.values(), pa.array(mean, mask=none), pa.array(least, mask=none)], [*kept, "log_perplexity", "low"])

    return run


def thresholds(scores: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """lang, threshold: the quantile of (lang, low) per language.

    The scores are counted in bins of a fixed width, so the result does not depend on how the
    rows are dealt out, and no task sorts a language.
    """
    bins = scores.filter("low IS NOT NULL").groupBy("lang", F.floor(F.col("low") / BIN).alias("bin")).count()
    upto = Window.partitionBy("lang").orderBy("bin")
    everything = Window.partitionBy("lang")
    return (
        bins.withColumn("upto", F.sum("count").over(upto)).withColumn("total", F.sum("count").over(everything))
        .filter(F.col("upto") >= F.col("total") * quantile)
        .groupBy("lang").agg(((F.min("bin") + 1) * BIN).alias("threshold"))
    )


def trusted_ids(labels: DataFrame) -> DataFrame:
    """_id, left_out: ids labelled good and not toxic. An id labelled twice must be so each time."""
    good = labels.groupBy(F.col("doc_id").cast("string").alias("_id")).agg(
        F.min(F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))).alias("good")).filter("good AND _id IS NOT NULL")
    return good.select("_id", (F.pmod(F.xxhash64("_id"), F.lit(LEFT_OUT)) == 0).alias("left_out"))


def _in_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    return rows.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "kind")


def scored(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", lang: str = "lang", text: str = "text",
           columns: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """row (of `columns` of docs, all but the text if not given), lang, text (if `columns` is not given), log_perplexity, low.

    Texts move twice, once to meet their labels and be taken apart, once to meet the answers;
    the files of the first shuffle are gone by the second.
    """
    spark = docs.sparkSession
    bounded_batches(spark, BATCH_BYTES)
    size = docs.agg(F.sum(F.octet_length(docs[text]))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    # Rows without an id cannot be labelled, and are dealt by their text.
    block = lambda key: F.pmod(F.hash(key), F.lit(blocks)).cast("int").alias("block")
    name = docs[doc_id].cast("string")
    dealt = block(F.coalesce(name, F.concat(F.lit("no id "), F.xxhash64(docs[text]).cast("string"))))
    rest = columns or [c for c in docs.columns if c != text]
    packed = docs.select(dealt, F.lit(1).alias("kind"), name.alias("id"), docs[lang].cast("string").alias("lang"), docs[text].alias("text"),
                         F.struct(*(docs[c] for c in rest)).alias("row"))
    counted = trusted_ids(labels).filter("NOT left_out").select(block(F.col("_id")), F.lit(0).alias("kind"), F.col("_id").alias("id"))
    marked = counted.unionByName(packed.filter("lang IS NOT NULL").drop("row"), allowMissingColumns=True)
    asked = _table(_in_blocks(marked, blocks).mapInArrow(releasing(_asked), "block int, lang string, hi long, lo long, n long"), "asked")
    values = log_chances(_table(asked.groupBy(*KEYS).agg(F.sum("n").alias("n")), "grams"))
    answers = _table(asked.select("block", *KEYS).join(values, KEYS).select("block", *KEYS, "value").mapInArrow(releasing(_packed), ANSWERS), "answers")
    texts = packed.select("block", "kind", "row", "lang", "text")
    stream = _in_blocks(answers.unionByName(texts, allowMissingColumns=True), blocks)
    kind = f"row {texts.schema['row'].dataType.simpleString()}, lang string{'' if columns else ', text string'}, log_perplexity double, low double"
    scores = stream.mapInArrow(releasing(_scored(not columns)), kind)
    return _table(scores, "scores", **{"parquet.block.size": str(ROW_GROUP_BYTES)})


def _decided(scores: DataFrame, labels: DataFrame, doc_id: str) -> DataFrame:
    """The scores with threshold and rejected."""
    left_out = trusted_ids(labels).filter("left_out")
    apart = scores.select(F.col("row").getField(doc_id).cast("string").alias("id"), "lang", "low")
    # Labels grow with the documents; the join shuffles at every size.
    limits = _table(thresholds(apart.join(left_out.hint("shuffle_hash"), F.col("id") == F.col("_id"), "left_semi")), "thresholds")
    rejected = F.coalesce(F.col("low") > F.col("threshold"), F.lit(False))
    return scores.join(limits.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang"), "left").drop("_lang").withColumn("rejected", rejected)


def verdicts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """doc_id, lang, log_perplexity, low, threshold, rejected: one row per row of docs, as `judged` decides."""
    found = _decided(scored(docs, labels, doc_id, lang, text, columns=[doc_id]), labels, doc_id)
    return found.select(F.col("row").getField(doc_id).alias("doc_id"), "lang", "log_perplexity", "low", "threshold", "rejected")


def judged(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", lang: str = "lang", text: str = "text",
           block_bytes: int = TEXT_BLOCK_BYTES) -> DataFrame:
    """row (all columns of docs), log_perplexity, low, threshold, rejected.

    A document is rejected if `low` is above the threshold of its language. One without a
    language, or of a language without trusted text, has neither and is kept: there is nothing
    to hold against it. A language of whose trusted documents none was left out has no threshold,
    and keeps all. Null and empty texts are scored as the empty text. Repeated rows are
    judged alike; no rows give no rows.
    """
    found = _decided(scored(docs, labels, doc_id, lang, text, block_bytes=block_bytes), labels, doc_id)
    row = F.struct(*((F.col("text") if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns))
    return found.select(row.alias("row"), "log_perplexity", "low", "threshold", "rejected")

"""What each filter of a chain takes away, for every order of the filters.

A document is a mask: the filters it fails. Its removal step under an order is the smallest
place, in that order, of a filter it fails. Written as matrices, that is a product in which
plus and minimum stand for times and plus: masks (0 where a filter fails, no way otherwise)
by the places of the filters in each order (the inverse permutations). The product holds one
row per mask, at most 2**filters of them, and one column per order, whatever the number of
documents. Documents only give weights: how many of a part have each mask, and how many of
these are good or toxic. All counts per order and step are then sums of weights scattered by
the removal step.

The corpus is read once, in one pass that leaves a narrow row per document. Copies are found
by the digest of the text; the first of them is marked by a join on digest and id together,
so that thousands of copies of one text are spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import text_of, written

# Fixed values of the five filters.
SPACES = r"[\x20\x09-\x0D]+"
FEWEST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 2
SYMBOLS = r"[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = "ABCDE"

MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_NO_STEP = 1 << 20


def removal_steps(filters: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, steps): place of each filter in each order, and the removal step of each mask.

    Orders are the permutations in lexicographic order. Bit f of a mask is set where filter f
    fails; steps count from 0, and a mask without a failure has a step beyond all.
    """
    orders = np.array(list(permutations(range(filters))), np.int64).reshape(-1, filters)
    places = np.argsort(orders, axis=1)
    fails = (np.arange(1 << filters)[:, None] >> np.arange(filters)) & 1
    cost = np.where(fails == 1, 0, _NO_STEP)
    steps = np.full((1 << filters, len(orders)), _NO_STEP, np.int64)
    for f in range(filters):
        np.minimum(steps, cost[:, f, None] + places[None, :, f], out=steps)
    return places, steps


def audit_counts(weights: np.ndarray, good: np.ndarray, toxic: np.ndarray, filters: int) -> dict[str, np.ndarray]:
    """Measures [part, order, step] of the documents per [part, mask], all and labelled ones."""
    places, steps = removal_steps(filters)
    masks, orders = steps.shape
    fails = ((np.arange(masks)[:, None] >> np.arange(filters)) & 1).astype(bool)
    which = np.arange(orders)

    def scattered(values: np.ndarray) -> np.ndarray:
        """[part, order, step]: values [part, mask] added up at the removal step of the mask."""
        out = np.zeros((len(values), orders, filters + 1), np.int64)
        for mask in range(masks):
            out[:, which, np.minimum(steps[mask], filters)] += values[:, mask, None]
        return out[:, :, :filters]

    removed = scattered(weights)
    failing = np.zeros_like(removed)
    for f in range(filters):
        # What fails a filter fails it at the filter's own place, removed before or there.
        failing[:, which, places[:, f]] += weights[:, fails[:, f]].sum(axis=1)[:, None]
    unique, shapley = np.zeros_like(removed), np.zeros_like(removed)
    for f in range(filters):
        unique[:, which, places[:, f]] = weights[:, 1 << f][:, None]
        by_filter = removed[:, which, places[:, f]].sum(axis=1)
        shapley[:, which, places[:, f]] = by_filter[:, None]
    return {
        "kept": weights.sum(axis=1)[:, None, None] - np.cumsum(removed, axis=2), "removed": removed,
        "redundant": failing - removed, "unique_fails": unique, "good_lost": scattered(good),
        "toxic_lost": scattered(toxic), "shapley": shapley,
    }


def filter_audit(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """part, filter_order, step and the measures, zeros included, for every part and order.

    `masks` has part, mask (bit f set where filter f fails), good and toxic (booleans) and n
    (documents, long), in any number of rows per part; null labels count as false. At most
    2**filters times 4 rows of a part are left after the sums that run before the shuffle, so
    a part that holds most documents is no larger than another. Without rows the result is
    empty. Filters may be up to 7: the orders are all permutations.
    """
    filters = len(letters)
    size = 1 << filters
    names = ["".join(order) for order in permutations(letters)]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                yield _rows(batch.slice(at, 16))

    def _rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = batch.num_rows
        counts = [np.array(batch.column(i + 1).flatten(), np.int64).reshape(parts, size) for i in range(3)]
        found = audit_counts(*counts, filters)
        columns = [
            pa.array(np.repeat(np.arange(parts), len(names) * filters)), pa.array(np.tile(np.repeat(np.arange(len(names)), filters), parts)),
            pa.array(np.tile(np.arange(1, filters + 1, dtype=np.int32), parts * len(names)))]
        columns[0] = batch.column(0).take(columns[0])
        columns[1] = pa.array(names).take(columns[1])
        return pa.RecordBatch.from_arrays([*columns, *(pa.array(found[m].ravel()) for m in MEASURES)],
                                          ["part", "filter_order", "step", *MEASURES])

    def per_mask(condition: Column | None) -> Column:
        """Documents per mask, as an array in the order of the masks."""
        held = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
        return F.array(*(F.coalesce(F.sum(F.when(held & (F.col("mask") == m), F.col("n"))), F.lit(0)).cast("long") for m in range(size)))

    # First one row per mask and label, which the tasks that read the masks add up already;
    # then one row per part.
    few = masks.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    spread = few.groupBy("part").agg(
        per_mask(None).alias("weights"), per_mask(F.col("good")).alias("good"), per_mask(F.col("toxic")).alias("toxic"))
    measures = ", ".join(f"{m} long" for m in MEASURES)
    return spread.mapInArrow(measured, f"part string, filter_order string, step int, {measures}")


def text_mask(text: str | Column = "text") -> Column:
    """Bits 0 to 3 of a text (int): too few words, repeated words, capitals, symbols. Null is empty.

    Words are maximal runs of anything but the six ASCII white spaces, compared as they are.
    """
    whole = text_of(text)

    def bit(condition: Column, at: int) -> Column:
        return F.when(condition, F.lit(1 << at)).otherwise(F.lit(0))

    def of_counts(counts: Column) -> Column:
        words, distinct = counts["words"].cast("long"), counts["different"].cast("long")
        return bit(words < FEWEST_WORDS, 0) + bit(100 * distinct < LEAST_DISTINCT_PERCENT * words, 1)

    words = F.array_remove(F.split(whole, SPACES), "")
    # A one-element array binds the list of words, so that it is cut once.
    counted = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("words"), F.size(F.array_distinct(w)).alias("different")))
    points = F.length(whole).cast("long")
    capitals = points - F.length(F.translate(whole, CAPITALS, ""))
    return (F.element_at(F.transform(counted, of_counts), 1)
            + bit(100 * capitals > MOST_CAPITALS_PERCENT * points, 2) + bit(whole.rlike(SYMBOLS), 3))


def document_masks(docs: DataFrame, labels: DataFrame, part: str = "source", doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """part, mask, good, toxic, n of documents under the five filters A to E.

    E fails where a row with a smaller doc_id has the same text, wherever it is; null and empty
    texts are the same. Rows that repeat one doc_id are rows of their own, and none of them is
    smaller than another. A row without a doc_id is neither smaller nor larger than any row and
    has no labels. A document is good where any of its label rows has quality 1, toxic where any
    has toxic 1. Null parts and empty ones are one part.
    """
    rows = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(doc_id).cast("long").alias("doc_id"),
        F.unhex(F.sha2(text_of(text), 256)).alias("digest"), text_mask(text).alias("mask"))
    # Rows repeated as they are become one here; their texts are not read again.
    rows = written(rows.groupBy("part", "doc_id", "digest", "mask").agg(F.count("*").alias("n")), "filter-masks")
    named, nameless = rows.filter("doc_id IS NOT NULL"), rows.filter("doc_id IS NULL")
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select("digest", "doc_id", F.lit(True).alias("is_first"))
    marks = labels.select("doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    marks = marks.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    # Both tables grow with the documents: they are shuffled at every size.
    marked = named.join(first.hint("shuffle_merge"), ["digest", "doc_id"], "left").join(marks.hint("shuffle_merge"), "doc_id", "left")
    copy = F.when(F.col("is_first"), F.lit(0)).otherwise(F.lit(1 << 4))

    def out(df: DataFrame, mask: Column, good: Column, toxic: Column) -> DataFrame:
        return df.select("part", mask.alias("mask"), good.alias("good"), toxic.alias("toxic"), "n")

    no = F.lit(False)
    whole = out(marked, F.col("mask") + copy, F.coalesce("good", no), F.coalesce("toxic", no))
    return whole.unionByName(out(nameless, F.col("mask"), no, no))


def documents_audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The audit of the five filters over whole documents; see `document_masks` and `filter_audit`."""
    return filter_audit(document_masks(docs, labels, part), LETTERS)



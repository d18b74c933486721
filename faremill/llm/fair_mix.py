"""Mixing sources to target weights by weighted fair queueing.

Every document gets a virtual finish time: the words of its source up to its own end, in a
shuffled order, over the target of the source. A source that must give more than it has is
queued again from its start. Sorted by finish time, the queue of every source advances in
proportion to its target at every moment; the mix is the start of that queue up to the budget.

Running sums over a hot source, or over the whole queue, never go through one task: the rows
are cut into buckets of the hash, or of the finish time, whose sums are accumulated first,
and a window runs inside each bucket only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.llm.common import text_of, written

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
BUCKET_ROWS = 2000
# Fixed value: what counts as a word.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column = "text") -> Column:
    """Words of a text (long); null has none."""
    return F.coalesce(F.regexp_count(text_of(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0,
                   most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size, target of (source, source_size).

    Sources in order of code points, null last, take the weights in turn and share `share` of
    all words by weight. A target stops at `most_epochs` times the size of its source; what is
    over is shared again, by weight, between the others, until none is above. That fixed point
    is found by one sort: a source is full when its size over its weight is at or below the
    level at which all words are shared out, and the sources fill in that order. Sources
    without words get nothing. Rows are one per source.
    """
    # One window over the table of sources orders it; its rows are sources, not documents.
    ranked = sources.withColumn("at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("at") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("room", F.col("source_size") * F.lit(float(most_epochs)))
    filling = Window.orderBy(F.col("room") / F.col("weight"), "at")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy("at")
    level = ranked.select(
        "*", F.coalesce(F.sum("room").over(before), F.lit(0.0)).alias("full_room"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("full_weight"),
        F.sum("weight").over(everything).alias("all_weight"),
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("budget"))
    # Were this source the first that is not full, all not yet full would stand at this level.
    rate = (F.col("budget") - F.col("full_room")) / (F.col("all_weight") - F.col("full_weight"))
    level = level.withColumn("rate", rate)
    is_open = F.col("room") > F.col("rate") * F.col("weight")
    settled = F.first(F.when(is_open, F.col("rate")), ignorenulls=True).over(
        filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return level.withColumn("settled", settled).select(
        "source", "source_size",
        F.when(F.col("settled").isNull(), F.col("room"))
        .otherwise(F.least("room", F.col("settled") * F.col("weight"))).alias("target"))


def _running(rows: DataFrame, keys: list[str], bucket: str, order: list[str], value: str, name: str) -> DataFrame:
    """rows with the running sum of `value` per keys, accumulated over buckets first."""
    same = F.lit(True)
    sums = rows.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col(bucket).alias("_bucket"),
                         F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn("_inside", F.sum(value).over(inside))
        .join(starts, same & (F.col(bucket) == F.col("_bucket")))
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_start", "_inside", "_bucket", *(f"_{k}" for k in keys))
    )


def queue(units: DataFrame, targets: DataFrame, buckets: int, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """source, shuffled, size, epoch, finish: one row per unit and time it is queued.

    `units` has source, shuffled (a hash that orders the source) and size > 0; `targets` comes
    from `source_targets`. The queue of a source ends with the unit that reaches its target.
    """
    hashed = units.withColumn("hash_bucket", F.shiftright("shuffled", 64 - _bits(buckets)))
    summed = _running(hashed, ["source"], "hash_bucket", ["shuffled"], "size", "upto")
    joined = summed.join(
        targets.select(F.col("source").alias("_source"), "source_size", "target"),
        F.col("source").eqNullSafe(F.col("_source"))).filter("target > 0")
    times = joined.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(most_epochs - 1))))
    end = F.col("epoch") * F.col("source_size") + F.col("upto")
    return times.filter(end - F.col("size") < F.col("target")).select(
        "source", "shuffled", "size", "epoch", (end / F.col("target")).alias("finish"))


def take(queued: DataFrame, budget: int, buckets: int) -> DataFrame:
    """The start of the queue, by finish time, source and hash, whose words fit the budget."""
    binned = queued.withColumn("time_bucket", F.floor(F.col("finish") * buckets).cast("long"))
    summed = _running(binned.withColumn("queue", F.lit(0)), ["queue"], "time_bucket",
                      ["finish", F.col("source").asc_nulls_last(), "shuffled", "epoch"], "size", "served")
    return summed.filter(F.col("served") <= budget).drop("queue", "time_bucket")


def _bits(buckets: int) -> int:
    return max(1, min(32, (max(buckets, 2) - 1).bit_length()))


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17) -> DataFrame:
    """doc_id, source, size, shuffled of every row; equal rows share their hash."""
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(docs[text]).alias("size"),
        F.xxhash64(F.lit(seed), docs[doc_id], docs[text]).alias("shuffled"))


def mix_plan(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0,
             most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size, target, full_epochs, upto: what the mix takes of each source.

    A source gives all its documents `full_epochs` times, and once more those whose hash is at
    or below `upto` (null: none). Rows with one hash, that is repeated rows, are one unit and
    come or stay together; documents without words are never queued.
    """
    sources = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    targets = written(source_targets(sources, weights, share, most_epochs), "targets")
    units = written(
        sizes.filter("size > 0").groupBy("source", "shuffled").agg(F.sum("size").alias("size")), "units")
    total, rows = sources.agg(F.sum("source_size")).first()[0] or 0, units.count()
    buckets = max(2, rows // BUCKET_ROWS)
    served = take(queue(units, targets, buckets, most_epochs), int(total * share), buckets)
    # Within a source the queue is ordered by epoch, then hash: its end says it all.
    ends = served.groupBy("source").agg(
        F.max(F.struct("epoch", "shuffled")).alias("last")).select(F.col("source").alias("_source"), "last")
    return targets.join(ends, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "source_size", "target", F.coalesce("last.epoch", F.lit(0)).alias("full_epochs"),
        F.col("last.shuffled").alias("upto"))


def with_copies(docs: DataFrame, plan: DataFrame, name: str = "copies", source: str = "source",
                size: str = "size", shuffled: str = "shuffled") -> DataFrame:
    """docs with how often the mix takes each row, and source_size and target of its source."""
    plan = plan.select(F.col("source").alias("_source"), "source_size", "target", "full_epochs", "upto")
    copies = F.col("full_epochs") + F.coalesce((F.col(shuffled) <= F.col("upto")).cast("int"), F.lit(0))
    return (
        docs.join(plan, F.col(source).eqNullSafe(F.col("_source")), "left")
        .withColumn(name, F.when(F.col(size) > 0, copies).otherwise(F.lit(0)))
        .drop("_source", "full_epochs", "upto")
    )


def mixed(docs: DataFrame, seed: int = 17, weights: Sequence[float] = WEIGHTS, share: float = 1.0,
          most_epochs: int = MOST_EPOCHS, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix, all their columns, a row for each time one is taken.

    Null sources are a source of their own, after all others. Null and blank texts have no
    words and are not taken. Repeated rows are taken or left together. No rows give no rows.
    """
    plan = written(mix_plan(written(sized(docs, doc_id, text, source, seed), "sizes"), weights, share, most_epochs), "plan")
    packed = docs.select(F.struct(*docs.columns).alias("row"), docs[source].alias("source"), word_count(docs[text]).alias("size"),
                         F.xxhash64(F.lit(seed), docs[doc_id], docs[text]).alias("shuffled"))
    taken = with_copies(packed, plan).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")

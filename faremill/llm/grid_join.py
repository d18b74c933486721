"""Near-duplicate vectors by an epsilon grid order join.

A cosine of at least t between unit vectors is a distance of at most eps = sqrt(2 - 2t).
Different vectors are projected on their leading principal directions and sorted by label,
then by the cells of a grid of width eps over these. The sorted sequence is cut into blocks.
The join is recursive: it starts with the whole sequence against itself and splits intervals
into `FAN` parts each, and two intervals are dropped as soon as the boxes around them are more
than eps apart, or share no label. What is left are pairs of blocks, whose vectors are compared
as matrices. Boxes live in the space of projections, where distances are never longer than the
real ones, so no link is lost, whatever sample the directions were learned from.

Equal vectors are one in all this, with the number of their ids; a pair of blocks returns the
number of links of each vector and a star of each group, never a list of all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import bounded_batches, written
from faremill.llm.components import components
from faremill.llm.simhash import merge
from faremill.llm.vectors import matrix, unit, usable

SAMPLE = 10_000
GRID = 4
BOX = 12
BLOCK = 512
FAN_BITS = 4
_SLACK = 1e-6
_NEAR = 1e-9


def directions(rows: np.ndarray) -> np.ndarray:
    """All principal directions of the rows, the leading one first (columns)."""
    centred = rows - rows.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred)
    return vectors[:, np.argsort(-values)]


def _project(bases: dict[int, np.ndarray], eps: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(0).offsets.to_numpy())
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                rows = unit(matrix(part.column(0)))
                places = rows @ bases.get(int(size), np.eye(int(size)))[:, :BOX]
                cells = np.floor(places[:, :GRID] / eps).astype(np.int32)
                places = np.pad(places, ((0, 0), (0, BOX - places.shape[1])))
                offsets = lambda a: pa.array(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(part), size), pa.int32()), part.column(1), pa.ListArray.from_arrays(offsets(cells), cells.ravel()),
                    pa.ListArray.from_arrays(offsets(places), places.ravel()), part.column(2), part.column(3), part.column(0)],
                    ["size", "label", "cells", "places", "rep", "copies", "embedding"])

    return run


def _blocks(block: int):
    names = ["number", "size", "label", "low", "high", "reps", "copies", "vectors"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, seq, held = TaskContext.get().partitionId() << 32, 0, None

        def flush(table: pa.Table):
            nonlocal seq
            places = matrix(table.column("places").combine_chunks())
            vectors = matrix(table.column("embedding").combine_chunks())
            row = {"number": first + seq, "size": table.column("size")[0].as_py(), "label": table.column("label")[0].as_py(),
                   "low": places.min(axis=0).tolist(), "high": places.max(axis=0).tolist(),
                   "reps": table.column("rep").to_numpy().astype("<i8").tobytes(), "copies": table.column("copies").to_numpy().astype("<i8").tobytes(),
                   "vectors": vectors.astype("<f8").tobytes()}
            seq += 1
            return pa.RecordBatch.from_pylist([row], schema=kind)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while len(held):
                key = [np.asarray(held.column(c).to_numpy()) for c in ("size", "label")]
                differs = np.flatnonzero((key[0] != key[0][0]) | (key[1] != key[1][0]))
                end = int(differs[0]) if len(differs) else len(held)
                if end < block and end == len(held):
                    break
                end = min(end, block)
                yield flush(held.slice(0, end))
                held = held.slice(end)
        if held is not None and len(held):
            yield flush(held)

    kind = pa.schema([("number", pa.int64()), ("size", pa.int32()), ("label", pa.int64()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())),
                      ("reps", pa.binary()), ("copies", pa.binary()), ("vectors", pa.binary())])
    assert kind.names == names
    return run


def near_blocks(blocks: DataFrame, eps: float) -> DataFrame:
    """a, b: numbers of the blocks that may hold links, a <= b, by descending from the whole sequence."""
    edges = [F.col(side).getItem(i).alias(f"{side}{i}") for i in range(BOX) for side in ("low", "high")]
    # One key for label and size: they must agree, so an interval needs to know its first and last only.
    boxes = blocks.select(F.col("number").alias("id"), F.col("size").alias("size0"), F.col("size").alias("size1"),
                          F.col("label").alias("label0"), F.col("label").alias("label1"), *edges)
    parts, longest = blocks.agg(F.max(F.shiftright("number", 32)), F.max(F.col("number").bitwiseAND((1 << 32) - 1))).first()
    if parts is None:
        return blocks.select(F.col("number").alias("a"), F.col("number").alias("b"))
    bits = max(int(longest).bit_length(), 1)
    dense = F.shiftleft(F.shiftright("id", 32), bits).bitwiseOR(F.col("id").bitwiseAND((1 << 32) - 1))
    boxes = written(boxes.withColumn("node", dense), "boxes")
    depth = max(1, -(-(int(parts).bit_length() + bits) // FAN_BITS))
    lows = [c for c in boxes.columns if c.startswith("low") or c in ("size0", "label0")]
    highs = [c for c in boxes.columns if c.startswith("high") or c in ("size1", "label1")]
    pairs = blocks.sparkSession.createDataFrame([(0, 0)], "a long, b long")
    for level in range(depth - 1, -1, -1):
        node = F.shiftright("node", FAN_BITS * level)
        nodes = boxes.groupBy(node.alias("n")).agg(*(F.min(c).alias(c) for c in lows), *(F.max(c).alias(c) for c in highs))
        nodes = nodes.withColumn("up", F.shiftright("n", FAN_BITS))
        x, y = (nodes.select(*(F.col(c).alias(f"{side}_{c}") for c in nodes.columns)) for side in "xy")
        gap = lambda i: F.greatest(F.lit(0.0), F.col(f"x_low{i}") - F.col(f"y_high{i}"), F.col(f"y_low{i}") - F.col(f"x_high{i}"))
        apart = sum((gap(i) * gap(i) for i in range(BOX)), F.lit(0.0))
        meets = lambda key: (F.col(f"x_{key}0") <= F.col(f"y_{key}1")) & (F.col(f"y_{key}0") <= F.col(f"x_{key}1"))
        pairs = pairs.join(x, F.col("a") == F.col("x_up")).join(y, F.col("b") == F.col("y_up")).filter(
            (F.col("x_n") <= F.col("y_n")) & meets("size") & meets("label") & (apart <= eps * eps)
        ).select(F.col("x_n").alias("a"), F.col("y_n").alias("b"))
    ids = boxes.select("node", "id")
    return (pairs.join(ids.select(F.col("node").alias("a"), F.col("id").alias("ia")), "a")
            .join(ids.select(F.col("node").alias("b"), F.col("id").alias("ib")), "b").select(F.col("ia").alias("a"), F.col("ib").alias("b")))


def _compare(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                same = row["a"] == row["b"]
                reps = [np.frombuffer(row[f"reps_{s}"], "<i8") for s in "ab"]
                copies = [np.frombuffer(row[f"copies_{s}"], "<i8") for s in "ab"]
                rows = [np.frombuffer(row[f"vectors_{s}"], "<f8").reshape(len(r), -1) for s, r in zip("ab", reps)]
                hits = linked(rows[0], rows[1], least)
                if same:
                    np.fill_diagonal(hits, False)
                yield _found(reps, copies, hits, same)

    return run


def linked(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Which rows of x and y have a cosine of at least `least`."""
    cosine = unit(x) @ unit(y).T
    hits = cosine >= least
    for i, j in zip(*np.nonzero(np.abs(cosine - least) < _NEAR)):  # the last digits decide: as the measure is written
        hits[i, j] = np.dot(x[i], y[j]) / math.sqrt(np.dot(x[i], x[i]) * np.dot(y[j], y[j])) >= least
    return hits


def _found(reps, copies, hits: np.ndarray, same: bool) -> pa.RecordBatch:
    one, other = np.nonzero(hits)
    label = np.arange(len(reps[0]) + (0 if same else len(reps[1])))
    ids = reps[0] if same else np.concatenate(reps)
    order = np.argsort(ids, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    merge(label, place[one], place[other + (0 if same else len(reps[0]))])
    moved = np.flatnonzero(label != np.arange(len(label)))
    ids = ids[order]
    counts = [(hits * copies[1][None, :]).sum(axis=1)] + ([] if same else [(hits * copies[0][:, None]).sum(axis=0)])
    counted, number = np.concatenate(reps[:len(counts)]), np.concatenate(counts)
    some = number > 0
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([counted[some], ids[moved]])),
        pa.array(np.concatenate([np.zeros(some.sum(), np.int64), ids[label[moved]]]), mask=np.arange(some.sum() + len(moved)) < some.sum()),
        pa.array(np.concatenate([number[some], np.zeros(len(moved), np.int64)]))], ["u", "v", "n"])


def near_vectors(vectors: DataFrame, least: float = 0.98, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector of (vec_id, embedding, label).

    Vectors link when their labels are equal and not null and their cosine, in double
    precision, is at least `least`. A vector that cannot be used (null, empty, zero, null or
    non-finite components), without a label or without an id links with nothing, nor do vectors
    of different lengths. Equal rows are one vector. No rows give no rows.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select("vec_id", F.col("embedding"), F.col("label").cast("long").alias("label")).distinct()
    rows = written(rows.withColumn("usable", usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()), "vectors")
    distinct = written(rows.filter("usable").groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "distinct-vectors")
    eps = math.sqrt(max(2 - 2 * least, 0)) + _SLACK
    sample = distinct.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("embedding").toArrow().column(0).combine_chunks()
    sizes = np.diff(sample.offsets.to_numpy()) if len(sample) else np.zeros(0, int)
    bases = {int(s): directions(unit(matrix(sample.filter(pa.array(sizes == s))))) for s in np.unique(sizes)}
    placed = distinct.select("embedding", "label", "rep", "copies").mapInArrow(
        _project(bases, eps), "size int, label long, cells array<int>, places array<double>, rep long, copies long, "
        f"embedding {vectors.schema['embedding'].dataType.simpleString()}")
    order = ["size", "label", "cells", "rep"]
    blocks = written(placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _blocks(block), "number long, size int, label long, low array<double>, high array<double>, reps binary, copies binary, vectors binary"), "blocks")
    pairs = written(near_blocks(blocks, eps), "block-pairs")
    sides = [blocks.select(F.col("number").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("reps", "copies", "vectors"))) for s in "ab"]
    work = pairs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "a", "b").join(sides[0], "a").join(sides[1], "b")
    found = written(work.mapInArrow(_compare(least), "u long, v long, n long"), "vector-links")
    counts = found.filter("v IS NULL").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("n"))
    groups = components(found.filter("v IS NOT NULL").select("u", "v")).withColumnRenamed("node", "rep")
    known = distinct.join(counts, "rep", "left").join(groups, "rep", "left").select(
        "label", "embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked_rows = rows.filter("usable").join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked_rows.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))

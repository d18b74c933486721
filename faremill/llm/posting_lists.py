"""Approximate nearest neighbours by balanced posting lists.

Centroids come from a bounded sample that is halved again and again, each time at the median
of its leading direction, so that all leaves are of one size. Every vector goes to the posting
list of its nearest centroid, and, near a boundary, to those of others that are hardly
farther. Centroids are few enough to be searched in memory, by a best-first walk over a graph
of their neighbours. A query reads all lists whose centroids are within a ratio of the distance
of the `LEAST_LISTS`-th nearest, however many they are, and compares itself with all vectors in
them. The ratio is measured in the job: a sample of the queries is compared with all vectors,
and the ratio is the smallest that reaches `RECALL` of what is nearest to them. (The very
nearest centroid is no measure: it can be the query itself, at no distance.)

Equal vectors are one entry with the smallest ids that can matter, so a very common vector
is no long list; a list that is long all the same is cut into blocks, each a task's work.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faremill.llm.common import bounded_batches, written
from faremill.llm.vectors import matrix, unit, usable

# The sample and the centroids are bounded, and so is what is broadcast: MOST_LISTS rows.
SAMPLE = 20_000
LIST = 256
MOST_LISTS = 8192
NEIGHBOURS = 16
# Where a walk starts to look; a search that needs more goes on until it has all within its ratio.
BEAM = 80
REPLICAS = 6
BOUNDARY = 1.08
LEAST_LISTS = 4
# The ratio of distances is chosen for this recall of so many queries, over and above the error of the sample.
RECALL = 0.98
SAMPLE_QUERIES = 512
BLOCK = 2048
QUERY_BLOCK = 512


def balanced_centroids(rows: np.ndarray, lists: int) -> np.ndarray:
    """Unit centroids of leaves of equal size."""
    leaves = [rows]
    while len(leaves) < lists:
        halves = []
        for leaf in leaves:
            if len(leaf) < 2:
                halves.append(leaf)
                continue
            centred = leaf - leaf.mean(axis=0)
            lead = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            order = np.argsort(centred @ lead, kind="stable")
            halves += [leaf[order[:len(leaf) // 2]], leaf[order[len(leaf) // 2:]]]
        if len(halves) == len(leaves):
            break
        leaves = halves
    means = np.stack([leaf.mean(axis=0) for leaf in leaves])
    return unit(np.where(np.abs(means).max(axis=1, keepdims=True) > 0, means, np.stack([leaf[0] for leaf in leaves])))


class CentroidGraph:
    """Centroids linked to their nearest, with one entry; searched best first, many vectors at a time."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        count = len(centroids)
        reach = min(NEIGHBOURS, count - 1)
        links = np.zeros((count, reach + 1), np.int64)
        for low in range(0, count, 1024):
            likeness = centroids[low:low + 1024] @ centroids.T
            likeness[np.arange(len(likeness)), np.arange(low, low + len(likeness))] = -np.inf
            links[low:low + 1024, :reach] = np.argsort(-likeness, axis=1, kind="stable")[:, :reach]
        links[:, reach] = (np.arange(count) + 1) % count  # a ring, so that all can be reached
        self.links = links
        # Entries spread over all centroids: leaves of the halving are in its order.
        self.entries = np.unique(np.linspace(0, count - 1, min(count, BEAM)).astype(np.int64))

    def distances(self, rows: np.ndarray) -> np.ndarray:
        """The distance of each row to each centroid."""
        return np.sqrt(np.maximum(2 - 2 * rows @ self.centroids.T, 0))

    def search(self, rows: np.ndarray, beam: int = BEAM):
        """(centroids, distances): for each row the nearest found, nearest first; -1 and inf where there are fewer."""
        count = len(self.centroids)
        beam = min(beam, count)
        many = np.arange(len(rows))
        held = np.repeat(self.entries[None, :], len(rows), axis=0)
        gap = 1 - rows @ self.centroids[self.entries].T
        seen = np.zeros((len(rows), count), bool)
        seen[:, self.entries] = True
        opened = np.zeros(held.shape, bool)
        while True:
            order = np.argsort(gap, axis=1, kind="stable")[:, :beam]
            held, gap, opened = (np.take_along_axis(a, order, 1) for a in (held, gap, opened))
            waiting = np.where(opened | ~np.isfinite(gap), np.inf, gap)
            best = waiting.argmin(axis=1)
            active = np.flatnonzero(np.isfinite(waiting[many, best]))
            if not len(active):
                return np.where(np.isfinite(gap), held, -1), np.sqrt(np.maximum(2 * gap, 0))
            opened[active, best[active]] = True
            next_ = self.links[held[active, best[active]]]
            new = ~seen[active[:, None], next_]
            seen[active[:, None], next_] = True
            far = np.where(new, 1 - np.einsum("ijk,ik->ij", self.centroids[next_], rows[active]), np.inf)
            # The ring may name a neighbour twice; the second is dropped.
            twice = (next_[:, -1:] == next_[:, :-1]).any(axis=1)
            far[twice, -1] = np.inf
            wide = np.full((len(rows), next_.shape[1]), np.inf)
            wide[active] = far
            names = np.zeros((len(rows), next_.shape[1]), np.int64)
            names[active] = next_
            held, gap = np.concatenate([held, names], axis=1), np.concatenate([gap, wide], axis=1)
            opened = np.concatenate([opened, np.zeros(names.shape, bool)], axis=1)


def closures(graph: CentroidGraph, rows: np.ndarray) -> list[list[int]]:
    """The lists of each row: the nearest, and others hardly farther that are not nearer to a chosen one than to the row."""
    found, far = graph.search(rows)
    chosen = []
    for names, gaps in zip(found, far):
        mine = [int(names[0])]
        for name, gap in zip(names[1:], gaps[1:]):
            if name < 0 or gap > BOUNDARY * gaps[0] or len(mine) == REPLICAS:
                break
            apart = np.sqrt(np.maximum(2 - 2 * graph.centroids[mine] @ graph.centroids[name], 0))
            if (apart >= gap).all():
                mine.append(int(name))
        chosen.append(mine)
    return chosen


def _reach(ranked: np.ndarray) -> np.ndarray:
    """What the ratio refers to: the distance of the LEAST_LISTS-th nearest centroid, given the nearest first."""
    return ranked[:, min(LEAST_LISTS, ranked.shape[1]) - 1]


def probes(graph: CentroidGraph, rows: np.ndarray, ratio: float) -> list[list[int]]:
    """The lists that each query reads: all within the ratio. Where a walk ends before it, all centroids are measured."""
    found, far = graph.search(rows)
    limits = _limit(_reach(far), ratio)
    chosen = [names[(names >= 0) & (gaps <= limit)].tolist() for names, gaps, limit in zip(found, far, limits)]
    if found.shape[1] < len(graph.centroids):
        for i in np.flatnonzero((far <= limits[:, None]).all(axis=1)):
            gaps = graph.distances(rows[i:i + 1])[0]
            chosen[i] = np.flatnonzero(gaps <= _limit(np.partition(gaps, LEAST_LISTS - 1)[LEAST_LISTS - 1], ratio)).tolist()
    return chosen


def _limit(reach, ratio: float):
    """A hair more than the ratio allows, as two ways of adding up one distance can differ in their last digits."""
    return np.where(np.isinf(ratio), np.inf, reach * (ratio if np.isfinite(ratio) else 1.0) * (1 + 1e-9) + 1e-7)


def _needed(graph, ids: np.ndarray, rows: np.ndarray, top: int):
    """For rows (lists, embedding, ids) of a task: the nearest to each sampled query, and the ratio at which it reads one of their lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps = graph.value.distances(rows)
        reach = _reach(np.sort(gaps, axis=1))
        for batch in batches:
            for low in range(0, len(batch), 4096):
                part = batch.slice(low, 4096)
                scores = rows @ unit(matrix(part.column(1))).T
                # An entry can be the query itself, so one more than asked for is kept.
                floor = -np.partition(-scores, min(top, scores.shape[1] - 1), axis=1)[:, min(top, scores.shape[1] - 1)]
                at_q, at_v = np.nonzero(scores >= floor[:, None])
                lists, theirs = part.column(0).to_pylist(), part.column(2).to_pylist()
                out = []
                for q, v in zip(at_q.tolist(), at_v.tolist()):
                    gap = gaps[q, lists[v]].min()
                    ratio = 0.0 if gap <= reach[q] else gap / reach[q] if reach[q] > 0 else np.inf
                    out += [(q, i, scores[q, v], ratio) for i in theirs[v] if i != ids[q]]
                columns = zip(*out) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))], ["q", "vec_id", "score", "ratio"])

    return run


def measured_ratio(graph, listed: DataFrame, asked: DataFrame, top: int) -> float:
    """The smallest ratio at which a sample of the queries finds RECALL of its nearest vectors.

    `listed` has lists, embedding, ids of all entries. The sample is compared with every one.
    """
    sample = asked.orderBy(F.xxhash64("query_id", "embedding"), "query_id").limit(SAMPLE_QUERIES).select("query_id", "embedding").toArrow()
    if not len(sample):
        return 1.0
    ids, rows = sample.column(0).to_numpy(), unit(matrix(sample.column(1).combine_chunks()))
    near = listed.mapInArrow(_needed(graph, ids, rows, top), "q long, vec_id long, score double, ratio double")
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    ratios = np.sort(near.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= top).select("ratio").toArrow().column(0).to_numpy())
    if not len(ratios):
        return 1.0
    # Two standard errors of the sample more.
    aim = min(RECALL + 2 * np.sqrt(RECALL * (1 - RECALL) / len(ratios)), 1.0)
    return float(max(ratios[min(int(np.ceil(aim * len(ratios))), len(ratios)) - 1], 1.0))


def _listed(graph, choose):
    """Rows with the lists chosen for them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                lists = choose(graph.value, unit(matrix(part.column(0))))
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32())), *part.columns], ["lists", *part.schema.names])

    return run


def _in_blocks(rows: DataFrame, size: int, key: str) -> DataFrame:
    """rows with a block number within their list, so that a block has about `size` rows."""
    counts = rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("blocks"))
    return rows.join(counts, "list").withColumn("block", F.pmod(F.xxhash64(key), F.col("blocks")).cast("int")).drop("blocks")


def _nearest(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                mine, theirs = (batch.column(c)[i].values for c in (0, 1))
                q, v = matrix(mine.field("embedding")), matrix(theirs.field("embedding"))
                scores = (q @ v.T) / (np.sqrt((q * q).sum(axis=1))[:, None] * np.sqrt((v * v).sum(axis=1))[None, :])
                keep = min(top + 1, scores.shape[1])
                floor = -np.partition(-scores, keep - 1, axis=1)[:, keep - 1]
                at_q, at_v = np.nonzero(scores >= floor[:, None])  # all ties at the end come along
                ids = theirs.field("ids").take(pa.array(at_v))
                lengths = np.diff(ids.offsets.to_numpy())
                yield pa.RecordBatch.from_arrays([
                    mine.field("query_id").take(pa.array(np.repeat(at_q, lengths))), ids.flatten(), pa.array(np.repeat(scores[at_q, at_v], lengths))],
                    ["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, top: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the `top` nearest found of each query, its own id left out.

    `vectors` has vec_id, embedding and `queries` query_id, embedding. Nearness is the cosine
    in double precision, ties go to the smaller vec_id. Vectors that are null, empty, zero or
    hold null or non-finite components take no part, nor do those without an id or of another
    length than most. Equal rows are one vector. No rows give no rows.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    kind = vectors.schema["embedding"].dataType.simpleString()
    rows = vectors.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select("vec_id", "embedding")
    common = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # Of equal vectors only the smallest ids can be among the nearest: one more than asked for, as one may be the query.
    smallest = Window.partitionBy("embedding").orderBy("vec_id")
    entries = written(
        rows.filter(F.size("embedding") == common["n"]).distinct().withColumn("n", F.row_number().over(smallest)).filter(F.col("n") <= top + 1)
        .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "entries")
    count = entries.count()
    sample = entries.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(SAMPLE).select("embedding").toArrow().column(0).combine_chunks()
    lists = int(min(max(count // LIST, 1), MOST_LISTS))
    graph = spark.sparkContext.broadcast(CentroidGraph(balanced_centroids(unit(matrix(sample)), lists)))
    listed = written(entries.mapInArrow(_listed(graph, closures), f"lists array<int>, embedding {kind}, ids array<long>"), "listed")
    posted = listed.select(F.explode("lists").alias("list"), "embedding", "ids")
    asked = queries.filter(usable(F.col("embedding")) & F.col("query_id").isNotNull() & (F.size("embedding") == common["n"])).select(
        "embedding", "query_id").distinct()
    ratio = measured_ratio(graph, listed, asked, top)
    reading = functools.partial(probes, ratio=ratio)
    asked = written(asked.mapInArrow(_listed(graph, reading), f"lists array<int>, embedding {kind}, query_id long").select(
        F.explode("lists").alias("list"), "embedding", "query_id"), "probes")
    v = _in_blocks(posted, BLOCK, "ids").groupBy("list", "block").agg(F.collect_list(F.struct("embedding", "ids")).alias("theirs"))
    q = _in_blocks(asked, QUERY_BLOCK, "query_id").groupBy("list", "block").agg(F.collect_list(F.struct("embedding", "query_id")).alias("mine"))
    pairs = q.select("list", F.col("block").alias("part"), "mine").join(v, "list").select("mine", "theirs", "list", "part", "block")
    spread = pairs.select("mine", "theirs").mapInArrow(_nearest(top), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    own = spread.filter("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return own.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")

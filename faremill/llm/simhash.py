"""Near duplicates by SimHash fingerprints and BK-trees.

Fingerprints within r bits of each other agree on one of r + 1 segments of their bits. So
every distinct fingerprint is dealt to one shard per segment, by the hash of that segment.
A shard becomes a BK-tree: children are keyed by their integer Hamming distance to the
parent, and a search follows only the edges within the radius. Trees reach their queries
through the shuffle on the shard, not through a broadcast by the driver, which would have to
gather the fingerprints of all documents. A shard beyond `SHARD` members is cut into parts,
and every pair of parts is searched. A shard returns a star of each of its groups, never all
its pairs.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import bounded_batches, text_of, written
from faremill.llm.components import components

SEED = 42
SHARD = 4096
BITS = 64
_CHUNK = 1 << 16
_SEARCH_PAIRS = 1 << 20


def fingerprint_of(text: str, words: int) -> int:
    """The fingerprint of one text; zero when it has no word."""
    # bytes.lower changes A-Z only, and bytes.split cuts at 0x20 and 0x09-0x0D only.
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    size = min(words, len(tokens))
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(size))))
    total = len(tokens) - size + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, total)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, total, _CHUNK):
        part = hashes[at:at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = 3, name: str = "fingerprint") -> DataFrame:
    """docs with a long column: the SimHash of the whole text. A null text counts as empty."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint_of(t, words) for t in texts], np.uint64)
        return pd.Series(values.view(np.int64))

    return docs.withColumn(name, simhash(text_of(docs[text])))


class BKTree:
    """A BK-tree over distinct fingerprints, built and searched a level at a time."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.child = np.full((len(values), BITS + 1), -1, np.int32)
        waiting, parent = np.arange(1, len(values)), np.zeros(max(len(values) - 1, 0), np.int64)
        while len(waiting):
            distance = np.bitwise_count(values[waiting] ^ values[parent]).astype(np.int64)
            edge = parent * (BITS + 1) + distance
            taken, first, group = np.unique(edge, return_index=True, return_inverse=True)
            node = waiting[first]
            self.child.ravel()[taken] = node
            rest = np.ones(len(waiting), bool)
            rest[first] = False
            waiting, parent = waiting[rest], node[group][rest]

    def search(self, queries: np.ndarray, radius: int):
        """Pairs (query index, node index) within the radius."""
        found_query, found_node = [], []
        query, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        while len(query):
            distance = np.bitwise_count(queries[query] ^ self.values[node]).astype(np.int64)
            hit = distance <= radius
            found_query.append(query[hit])
            found_node.append(node[hit])
            next_query, next_node = [], []
            for step in range(-radius, radius + 1):
                edge = distance + step
                inside = (edge >= 0) & (edge <= BITS)
                child = self.child[node[inside], edge[inside]]
                known = child >= 0
                next_query.append(query[inside][known])
                next_node.append(child[known].astype(np.int64))
            query, node = np.concatenate(next_query), np.concatenate(next_node)
        return np.concatenate(found_query), np.concatenate(found_node)


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of linked elements; `label` points to the smallest position of a set."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped


def _shard_links(radius: int):
    def links(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("rep", kind="stable")
        values = shard["fingerprint"].to_numpy().view(np.uint64)
        reps = shard["rep"].to_numpy()
        label = np.arange(len(values))
        tree_at = np.flatnonzero(shard["in_tree"].to_numpy())
        query_at = np.flatnonzero(~shard["in_tree"].to_numpy())
        if not len(query_at):
            query_at = tree_at
        if len(tree_at):
            tree = BKTree(values[tree_at])
            step = max(1, _SEARCH_PAIRS // len(tree_at))
            for at in range(0, len(query_at), step):
                part = query_at[at:at + step]
                query, node = tree.search(values[part], radius)
                merge(label, part[query], tree_at[node])
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"u": reps[moved], "v": reps[label[moved]]})

    return links


def fingerprint_links(distinct: DataFrame, radius: int = 2, shard: int = SHARD) -> DataFrame:
    """u, v: links between `rep` values that join all fingerprints within `radius` bits.

    `distinct` has long columns fingerprint (distinct) and rep (its id, not null). The links
    hold the same groups as all pairs within the radius, but not each pair.
    """
    spark = distinct.sparkSession
    total = distinct.count()
    shards = max(1, (radius + 1) * total // shard)
    cuts = [BITS * i // (radius + 1) for i in range(radius + 2)]
    segments = F.array(*(
        F.struct(F.lit(i).alias("segment"),
                 F.shiftrightunsigned("fingerprint", low).bitwiseAND((1 << (high - low)) - 1).alias("value"))
        for i, (low, high) in enumerate(zip(cuts, cuts[1:]))))
    dealt = (
        distinct.select("fingerprint", "rep", F.explode(segments).alias("s"))
        .withColumn("shard", F.pmod(F.xxhash64("s.segment", "s.value"), F.lit(shards)))
        .select("shard", "fingerprint", "rep")
    )
    # A shard of chance members has about `shard` of them; twice that tells a hot value.
    parts = dealt.groupBy("shard").count().select("shard", F.ceil(F.col("count") / (2 * shard)).cast("int").alias("parts"))
    placed = dealt.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("fingerprint", F.lit(1)), F.col("parts")).cast("int"))
    pairs = placed.select("shard", "fingerprint", "rep", "part", F.explode(F.expr("sequence(0, parts - 1)")).alias("other"))
    grouped = pairs.select(
        "shard", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        (F.col("part") <= F.col("other")).alias("in_tree"), "fingerprint", "rep")
    bounded_batches(spark)
    return grouped.groupBy("shard", "low", "high").applyInPandas(_shard_links(radius), "u long, v long")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: id, fingerprint (long), component_id (smallest id reachable).

    Null and blank texts have fingerprint zero and are linked like any other. Repeated rows
    count as one document. A null id is kept and joins its group, but never names it: a group
    of null ids only has a null component. No rows give no rows.
    """
    printed = written(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                                       "text", words).select("doc_id", "fingerprint"), "fingerprints")
    return printed.join(fingerprint_groups(printed, radius), "fingerprint").select(
        F.col("doc_id").alias(doc_id), "fingerprint", "component_id")


def fingerprint_groups(printed: DataFrame, radius: int = 2) -> DataFrame:
    """fingerprint, component_id of every distinct fingerprint of (doc_id, fingerprint)."""
    distinct = written(printed.groupBy("fingerprint").agg(F.min("doc_id").alias("rep")), "distinct-fingerprints")
    groups = components(fingerprint_links(distinct.filter("rep IS NOT NULL"), radius))
    return distinct.join(groups, distinct["rep"] == groups["node"], "left").select(
        "fingerprint", F.coalesce("component", "rep").alias("component_id"))


def keep_one(docs: DataFrame, words: int = 3, radius: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without near copies: of each group the rows of the smallest id stay.

    Rows that repeat an id stay or go together; a group without any id is kept whole.
    """
    groups = near_duplicates(docs, words, radius, doc_id, text)
    gone = groups.filter(F.col(doc_id) != F.col("component_id")).select(F.col(doc_id).alias("gone")).distinct()
    # The ids that go grow with the documents; the join shuffles at every size.
    return docs.join(gone.hint("shuffle_hash"), docs[doc_id] == gone["gone"], "left_anti")

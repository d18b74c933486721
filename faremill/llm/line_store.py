"""Line dedup that can be taken back: sharded cuckoo filters over exact reference counts.

A store is a folder with versions. A version has three tables:

- `refs`: shard, hash, key, doc_id: one row per document that holds a line, the exact record;
- `counts`: shard, hash, key, n_docs, keeper: its sums per line, keeper the largest doc_id;
- `filters`: shard, filter: a cuckoo filter over the hashes of all keys in `counts`.

A line is known by its key, 128 bits of the SHA-256 of the folded line; the first half of it
deals keys to shards and goes into the filters. New lines are asked of the filter of
their shard first. What it denies is new for certain and is counted from the delivery alone;
only what it may know is joined with the exact counts, which also decide about its errors.
A key whose last document goes is deleted from its filter, which exact counts make safe. So
a delivery can be inserted, and any document deleted again, and the store is the same as one
that never saw it.

Every step writes a new version next to the last one and names it when it is whole; a step
that dies is done again from the version before.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm.common import bounded_batches, text_of, written
from faremill.llm.cuckoo import BUCKETS, MOST_LOAD, SLOTS, CuckooFilter
from faremill.session import scratch_path

# Fixed value: the white space stripped at both ends.
STRIPPED = b" \t\n\x0b\x0c\r"
KEY_BYTES = 16
LEAST_CHARS = 20
LEAST_DOCS = 3
# Filters start this full; they are built anew, in twice the shards, before MOST_LOAD.
FIRST_LOAD = 0.7
DELIVERIES = 2

REFS = "shard int, hash long, key binary, doc_id long"
COUNTS = "shard int, hash long, key binary, n_docs long, keeper long"
FILTERS = "shard int, filter binary"


def line_keys(text: bytes, least_chars: int = LEAST_CHARS) -> list[bytes | None]:
    """The key of every line of a text, None for lines below `least_chars` code points.

    Lines are compared stripped, with A to Z lowered and all other letters as they are, which
    is what lowering bytes does.
    """
    keys: list[bytes | None] = []
    for line in text.lower().split(b"\n"):
        line = line.strip(STRIPPED)
        long = len(line) >= least_chars and (line.isascii() or len(line.decode("utf-8", "replace")) >= least_chars)
        keys.append(hashlib.sha256(line).digest()[:KEY_BYTES] if long else None)
    return keys


def references(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """hash, key, doc_id: every line of `least_chars` code points or more, once per document.

    The hash is the first half of the key. Documents without an id hold no references, for
    they could not be told apart.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), []
            counts = []
            for whole in batch.column(1):
                own = set(line_keys(whole.as_py(), least_chars)) - {None}
                keys.extend(own)
                counts.append(len(own))
            halves = np.frombuffer(b"".join(keys), ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves[::2]), pa.array(keys, pa.binary()), pa.array(np.repeat(np.array(ids, np.int64), counts))],
                ["hash", "key", "doc_id"])

    bounded_batches(docs.sparkSession)
    rows = docs.filter(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"), text_of(text).cast("binary").alias("text"))
    return rows.mapInArrow(cut, "hash long, key binary, doc_id long").distinct()


def _shard(shards: int) -> Column:
    return F.pmod(F.col("hash"), F.lit(shards)).cast("int")


def _shards_for(keys: int, load: float) -> int:
    return 1 << max(0, math.ceil(math.log2(max(keys, 1) / (load * BUCKETS * SLOTS))))


class LineStore:
    """The versions of one store; `path` is a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, shards: int = 0, version: str | None = None):
        self.spark, self.path, self.shards, self.version = spark, path.rstrip("/"), shards, version

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> LineStore:
        """The last whole version of a store, or an empty one."""
        store = cls(spark, path)
        heads = spark._jvm.org.apache.hadoop.fs.Path(f"{store.path}/heads")
        files = heads.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(heads):
            head = spark.read.schema("number long, version string, shards int").json(f"{store.path}/heads").orderBy(F.desc("number")).first()
            store.version, store.shards = head["version"], head["shards"]
        return store

    def _table(self, name: str, schema: str) -> DataFrame:
        if self.version is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{self.version}/{name}")

    @property
    def refs(self) -> DataFrame:
        return self._table("refs", REFS)

    @property
    def counts(self) -> DataFrame:
        return self._table("counts", COUNTS)

    @property
    def filters(self) -> DataFrame:
        return self._table("filters", FILTERS)

    def probe(self, refs: DataFrame) -> DataFrame:
        """hash, key, doc_id with `known`: whether the filter of the shard may hold the hash."""
        def ask(lines: pa.Table, own: pa.Table) -> pa.Table:
            hashes = lines["hash"].to_numpy().view(np.uint64)
            held = CuckooFilter.load(own["filter"][0].as_py()) if own.num_rows else CuckooFilter(1)
            return lines.select(["hash"]).filter(pa.array(held.contains(hashes)))

        # Distinct hashes are asked: a line that most documents hold is one question.
        asked = refs.select("hash").distinct().withColumn("shard", _shard(self.shards))
        answers = asked.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(ask, "hash long")
        known = written(answers, "known-lines").withColumn("known", F.lit(True))
        return refs.join(known.hint("shuffle_hash"), "hash", "left").withColumn("known", F.coalesce("known", F.lit(False)))

    def _filters(self, shards: int, came: DataFrame, gone: DataFrame, counts: DataFrame) -> DataFrame:
        """Filters with hashes added and deleted; built from the counts where the shards change."""
        def change(key, own: pa.Table, changes: pa.Table) -> pa.Table:
            held = CuckooFilter.load(own["filter"][0].as_py()) if own.num_rows else CuckooFilter()
            hashes, left = changes["hash"].to_numpy().view(np.uint64), changes["gone"].to_numpy()
            held.delete(hashes[left])
            held.insert(hashes[~left])
            return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([held.dump()], pa.binary())})

        if shards != self.shards:
            changes, own = counts.select("hash", F.lit(False).alias("gone")), self.spark.createDataFrame([], FILTERS)
        else:
            changes = came.select("hash", F.lit(False).alias("gone")).unionByName(gone.select("hash", F.lit(True).alias("gone")))
            own = self.filters
        changes = changes.withColumn("shard", _shard(shards))
        return own.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(change, FILTERS)

    def _commit(self, refs: DataFrame, counts: DataFrame, came: DataFrame, gone: DataFrame) -> LineStore:
        """Write a version. `counts` are the new ones; `came` and `gone` the keys that changed."""
        version = scratch_path(self.spark, "v").rsplit("/", 1)[1]
        folder = f"{self.path}/{version}"
        counts.drop("shard").write.parquet(f"{folder}/all-counts")
        counts = self.spark.read.parquet(f"{folder}/all-counts")
        keys = counts.count()
        shards = self.shards
        if not shards or keys > MOST_LOAD * 0.95 * shards * BUCKETS * SLOTS:
            shards = _shards_for(keys, FIRST_LOAD)
        self._filters(shards, came, gone, counts).write.parquet(f"{folder}/filters")
        counts.withColumn("shard", _shard(shards)).write.parquet(f"{folder}/counts")
        refs.drop("shard").withColumn("shard", _shard(shards)).write.parquet(f"{folder}/refs")
        done = LineStore(self.spark, self.path, shards, version)
        number = 1 + (0 if self.version is None else self.spark.read.json(f"{self.path}/heads").agg(F.max("number")).first()[0])
        self.spark.createDataFrame([(number, version, shards)], "number long, version string, shards int").write.mode("append").json(f"{self.path}/heads")
        return done

    def insert(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> LineStore:
        """The store with the references of a delivery.

        References that are there already count once, so a delivery may be inserted again.
        """
        # Both are written: texts are cut once, and what is asked, joined and stored is the same on any retry.
        new = written(references(docs, doc_id, text, least_chars), "references")
        new = new.withColumn("known", F.lit(False)) if self.version is None else written(self.probe(new), "probed-lines")
        fresh = new.filter("NOT known").drop("known")
        again = new.filter("known").drop("known")
        counts, refs = self.counts.drop("shard"), self.refs.drop("shard")
        if self.version is not None:
            # Only what the filter may know meets the exact tables; the pair of key and id spreads a hot line.
            touched = refs.join(again.select("key").distinct().hint("shuffle_hash"), "key", "left_semi")
            again = again.join(touched.select("key", "doc_id").hint("shuffle_hash"), ["key", "doc_id"], "left_anti")
            again = written(again.select("hash", "key", "doc_id"), "known-references")
        added = fresh.unionByName(again) if self.version is not None else fresh
        delta = added.groupBy("hash", "key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        delta = written(delta, "count-changes")
        both = counts.unionByName(delta).groupBy("hash", "key").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))
        came = delta if self.version is None else delta.join(counts.select("key").hint("shuffle_hash"), "key", "left_anti")
        return self._commit(refs.unionByName(added), both, came, self._none())

    def delete(self, doc_ids: DataFrame) -> LineStore:
        """The store without the documents of `doc_ids` (doc_id); unknown ids change nothing."""
        ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
        gone = written(self.refs.join(ids.hint("shuffle_hash"), "doc_id", "left_semi").select("hash", "key", "doc_id"), "deleted-references")
        left = written(self.refs.join(ids.hint("shuffle_hash"), "doc_id", "left_anti").select("hash", "key", "doc_id"), "left-references")
        touched = gone.select("key").distinct()
        counts = self.counts.drop("shard")
        # Only lines that lost a document are counted again, from their exact references.
        recount = left.join(touched.hint("shuffle_hash"), "key", "left_semi").groupBy("hash", "key").agg(
            F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        recount = written(recount, "recounted")
        kept = counts.join(touched.hint("shuffle_hash"), "key", "left_anti")
        emptied = gone.select("hash", "key").distinct().join(recount.select("key").hint("shuffle_hash"), "key", "left_anti")
        return self._commit(left, kept.unionByName(recount), self._none(), emptied)

    def _none(self) -> DataFrame:
        return self.spark.createDataFrame([], "hash long, key binary")

    def drops(self, least_docs: int = LEAST_DOCS) -> DataFrame:
        """doc_id, key: lines of at least `least_docs` documents, in all but the largest of these."""
        often = self.counts.filter(F.col("n_docs") >= least_docs).select("key", "keeper")
        return self.refs.join(often.hint("shuffle_hash"), "key").filter("doc_id < keeper").select("doc_id", "key")


def deduped(docs: DataFrame, store: LineStore, least_docs: int = LEAST_DOCS, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text of every row of `docs`.

    Null and empty texts are one empty line. Rows that repeat a doc_id lose the same lines; a
    row without one keeps all. The columns of `docs` other than the two are not looked at.
    """
    bounded_batches(docs.sparkSession)
    keys = store.drops(least_docs).groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).cast("binary").alias("text"))
    # The drops grow with the documents, so both sides are shuffled at every size.
    joined = rows.join(keys.hint("shuffle_hash"), "doc_id", "left")

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for whole, drop in zip(batch.column(1), batch.column(2)):
                whole, dropped = whole.as_py(), set(drop.as_py() or ())
                lines = n = whole.count(b"\n") + 1
                if dropped:
                    kept = [line for line, key in zip(whole.split(b"\n"), line_keys(whole, 0)) if key not in dropped]
                    whole, n = b"\n".join(kept), len(kept)
                texts.append(whole)
                n_lines.append(lines)
                n_dropped.append(lines - n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.binary())],
                ["doc_id", "n_lines", "n_dropped", "kept_text"])

    kept = joined.mapInArrow(without, "doc_id long, n_lines long, n_dropped long, kept_text binary")
    return kept.withColumn("kept_text", F.col("kept_text").cast("string"))


def load(docs: DataFrame, path: str, deliveries: int = DELIVERIES, least_chars: int = LEAST_CHARS, doc_id: str = "doc_id",
         text: str = "text") -> LineStore:
    """A new store of all documents, which come in `deliveries` shares by a hash of their id.

    Later shares are asked of the filters of the earlier ones, as later deliveries are; the
    number of shares changes no row of the result.
    """
    store = LineStore.open(docs.sparkSession, path)
    for share in range(deliveries):
        part = docs.filter(F.pmod(F.xxhash64(F.col(doc_id).cast("long")), F.lit(deliveries)) == share)
        store = store.insert(part, doc_id, text, least_chars)
    return store

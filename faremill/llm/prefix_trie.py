"""The prefix trie of conversations, by a skeleton of splitters over sorted shards.

A conversation is its path: 16 bytes of digest per turn. Paths are dealt to shards by ranges
of (path, conv_id), so a path that most conversations share is spread as well. A node is a
prefix, its members are one run of the sorted paths, and a run goes over the border of a
shard only if the splitter there starts with the prefix. So the prefixes of all splitters,
the skeleton, are all nodes that more than one shard may see. It is broadcast: its size is
the number of splitters times their length, checked before it is sent. Each shard finishes
every other node in one pass over its sorted paths, holding the nodes of one path at a time;
of skeleton nodes it gives partial counts, which are reduced and added up along the skeleton.

The ids that end at a node are hashed as they pass. Those of a skeleton node come from many
shards, each packed into text of many ids, and are streamed in order through the hash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.llm.common import bounded_batches, text_of, written

DIGEST = 16
# Fixed values of the rebuilt conversations.
FAMILY = 5
MOST_SHARED = 9

SHARD_TURNS = 1 << 20
MOST_SHARDS = 4096
SAMPLES_A_SHARD = 32
# Proven bound of the skeleton: splitters are thinned out until their bytes are below it.
SKELETON_BYTES = 32 << 20
PACKED_IDS = 1 << 16

NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string, skeleton_parent int, skeleton int, bytes long, shard int, chunk long, ids string")
_KINDS = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
_SCHEMA = pa.schema([(part.split()[0], _KINDS[part.split()[1]]) for part in NODES.split(", ")])
_ROWS = 4096


def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, at (from 0), digest, bytes of every turn, in the order of the conversation.

    Turns come by `turn`, null first; those that share one, by role and text. Null roles and
    texts are empty. Rows without a conv_id belong to no conversation and are left out.
    """
    role, text = text_of("role"), text_of("text")
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        # The length of the role keeps (role, text) apart from any other cut of the same letters.
        F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, DIGEST).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"), F.xxhash64(role, text).alias("tie"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "tie", "digest")
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("at"), "digest", "bytes")


def shared_turns(conv_id: str | Column = "conv_id") -> Column:
    """How many first turns a conversation takes from the first of its family."""
    number = F.col(conv_id) if isinstance(conv_id, str) else conv_id
    return F.crc32(number.cast("string").cast("binary")) % MOST_SHARED


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, path, sizes: the path of each conversation and the bytes of the text of each turn.

    Conversation c starts with the first h turns of conversation c - c % 5 (fewer, if that has
    fewer; none, if there is none) and goes on with its own turns after its first h, where
    h = crc32(c) % 9. Conversations left without turns have an empty path.
    """
    rows = written(ordered_turns(turns), "turns")
    ids = rows.select("conv_id").distinct().withColumn("h", shared_turns())
    heads = rows.filter((F.col("conv_id") % FAMILY == 0) & (F.col("at") < MOST_SHARED)).withColumnRenamed("conv_id", "head")
    # A first turn goes to at most five conversations, so this join adds few rows.
    taken = ids.withColumn("head", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads.hint("shuffle_merge"), "head").filter("at < h")
    own = rows.withColumn("h", shared_turns()).filter("at >= h")
    parts = taken.select("conv_id", "at", "digest", "bytes").unionByName(own.select("conv_id", "at", "digest", "bytes"))
    # A taken turn stands at a place below h, an own one at h or above.
    paths = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "digest", "bytes"))).alias("turns"))
    paths = ids.select("conv_id").join(paths.hint("shuffle_merge"), "conv_id", "left")
    none = F.array().cast("array<struct<at:int,digest:binary,bytes:bigint>>")
    held = F.coalesce(F.col("turns"), none)
    joined = F.unhex(F.array_join(F.transform(held, lambda t: F.hex(t["digest"])), ""))
    return paths.select("conv_id", joined.alias("path"), F.transform(held, lambda t: t["bytes"]).alias("sizes"))


class Skeleton:
    """The trie of the splitters' paths: nodes numbered so that parents come first, the root 0."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        prefixes = {b""}
        for path, _ in splitters:
            prefixes.update(path[:end] for end in range(DIGEST, len(path) + 1, DIGEST))
        self.nodes = sorted(prefixes, key=lambda p: (len(p), p))
        self.number = {node: at for at, node in enumerate(self.nodes)}

    def parent(self, at: int) -> int | None:
        return self.number[self.nodes[at][:-DIGEST]] if self.nodes[at] else None

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))


def chosen_splitters(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> list[tuple[bytes, int]]:
    """Splitters from a sample by a hash of the id; their number follows the turns of all paths.

    The sample has some SAMPLES_A_SHARD paths per shard, and its bytes are counted before it is
    fetched: where they exceed SKELETON_BYTES, fewer are taken, and shards are larger.
    """
    convs, turns = paths.agg(F.count("*"), F.sum(F.octet_length("path") / DIGEST)).first()
    shards = min(MOST_SHARDS, max(paths.sparkSession.sparkContext.defaultParallelism, int((turns or 0) // shard_turns)))
    if convs < 2 * shards:
        return []
    share = max(1, convs // (SAMPLES_A_SHARD * shards))
    while True:
        sample = paths.filter(F.pmod(F.xxhash64("conv_id"), F.lit(share)) == 0).select("path", "conv_id")
        weight = sample.agg(F.sum(F.octet_length("path") + 8)).first()[0] or 0
        if weight <= SKELETON_BYTES:
            break
        share *= 2
    found = sorted((bytes(path), conv_id) for path, conv_id in sample.collect())
    step = len(found) / shards
    return sorted({found[int(step * i)] for i in range(1, shards)}) if found else []


class _Open:
    """A node whose members are passing."""

    __slots__ = ("conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends", "waiting", "skeleton", "packed", "chunk", "bytes")

    def __init__(self, conv_id: int, size: int, skeleton: int | None):
        self.conv_id, self.bytes, self.skeleton = conv_id, size, skeleton
        self.n_convs = self.n_children = self.n_leaves = self.saved = self.chunk = 0
        self.ends = None
        self.packed: list[str] = []
        # Rows of children, which wait for the smallest id of this node.
        self.waiting: list[dict] = []


def shard_nodes(rows: Iterator[tuple[int, bytes, int, list[int]]], skeleton: Skeleton) -> Iterator[dict]:
    """Whole rows of nodes outside the skeleton and partial ones of skeleton nodes.

    `rows` are (shard, path, conv_id, sizes), sorted; a new shard starts anew. A partial row
    counts only the children, leaves and savings outside the skeleton.
    """
    stack: list[_Open] = []
    last: bytes | None = None
    current: int | None = None

    def pack(node: _Open, depth: int) -> dict:
        row = {"skeleton": node.skeleton, "shard": current, "chunk": node.chunk, "ids": ",".join(node.packed), "depth": depth}
        node.packed, node.chunk = [], node.chunk + 1
        return row

    def close() -> Iterator[dict]:
        node, depth = stack.pop(), len(stack)
        if node.skeleton is not None:
            if node.packed:
                yield pack(node, depth)
            yield {"skeleton": node.skeleton, "shard": current, "conv_id": node.conv_id, "n_convs": node.n_convs,
                   "n_children": node.n_children, "n_leaves": node.n_leaves, "saved_tokens": node.saved, "depth": depth, "bytes": node.bytes}
            return
        for row in node.waiting:
            yield row | {"parent_conv_id": node.conv_id}
        leaves = node.n_leaves or 1
        saved = node.saved + (node.n_convs - 1) * node.bytes
        digest = (node.ends or hashlib.sha256()).hexdigest()
        row = {"conv_id": node.conv_id, "depth": depth, "n_convs": node.n_convs, "n_children": node.n_children, "n_leaves": leaves,
               "saved_tokens": saved, "ends_sha256": digest}
        above = stack[-1]
        above.n_children += 1
        above.n_leaves += leaves
        above.saved += saved
        if above.skeleton is None:
            above.waiting.append(row)
        else:
            yield row | {"skeleton_parent": above.skeleton}

    for shard, path, conv_id, sizes in rows:
        depth = len(path) // DIGEST
        if shard != current:
            while stack:
                yield from close()
            last, current = None, shard
        same = 0
        if last is not None:
            most = min(depth, len(stack) - 1)
            while same < most and path[same * DIGEST:(same + 1) * DIGEST] == last[same * DIGEST:(same + 1) * DIGEST]:
                same += 1
            while len(stack) > same + 1:
                yield from close()
        else:
            stack.append(_Open(conv_id, 0, 0))
        inside = stack[-1].skeleton is not None
        for at in range(same, depth):
            # Below a node outside the skeleton no node is inside.
            number = skeleton.number.get(path[:(at + 1) * DIGEST]) if inside else None
            inside = number is not None
            stack.append(_Open(conv_id, sizes[at], number))
        for node in stack:
            node.n_convs += 1
            if conv_id < node.conv_id:
                node.conv_id = conv_id
        end = stack[-1]
        if end.skeleton is None:
            if end.ends is None:
                end.ends = hashlib.sha256(str(conv_id).encode())
            else:
                end.ends.update(f",{conv_id}".encode())
        else:
            end.packed.append(str(conv_id))
            if len(end.packed) == PACKED_IDS:
                yield pack(end, depth)
        last = path
    while stack:
        yield from close()


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield pa.RecordBatch.from_pylist(held, schema=_SCHEMA)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_SCHEMA)


def trie(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of (conv_id, path, sizes); see `conversation_trie`."""
    spark = paths.sparkSession
    bounded_batches(spark)
    skeleton = Skeleton(chosen_splitters(paths, shard_turns))
    sent = spark.sparkContext.broadcast(skeleton)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sent.value.shard(p, c) for p, c in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), *batch.columns], ["shard", "conv_id", "path", "sizes"])

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in (0, 2, 1, 3)))
        yield from _batches(shard_nodes(rows(), sent.value))

    cut = paths.select("conv_id", "path", "sizes").mapInArrow(dealt, "shard int, conv_id long, path binary, sizes array<long>")
    cut = cut.repartitionById(len(skeleton.splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    found = written(cut.mapInArrow(nodes, NODES), "trie-nodes")
    measures = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    local = found.filter("skeleton IS NULL").select(*measures, "parent_conv_id", "skeleton_parent")
    if found.isEmpty():
        return local.select("conv_id", "depth", "parent_conv_id", *measures[2:])
    whole = _skeleton_rows(found, skeleton)
    # The skeleton's rows are as bounded as the skeleton.
    names = F.broadcast(whole.select(F.col("skeleton").alias("skeleton_parent"), F.col("conv_id").alias("above")))
    local = local.join(names, "skeleton_parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    out = ["conv_id", "depth", "parent_conv_id", *measures[2:]]
    return local.select(*out).unionByName(whole.select(*out))


def _skeleton_rows(found: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Rows of the skeleton's nodes: partial counts reduced by shard, then added up along the skeleton."""
    spark = found.sparkSession
    parts = found.filter("skeleton IS NOT NULL AND n_convs IS NOT NULL").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.max("bytes").alias("bytes"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            out = []
            for number, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                if number != current:
                    if current is not None:
                        out.append({"skeleton": current, "ends_sha256": state.hexdigest()})
                    current, state = number, hashlib.sha256(ids.as_py().encode())
                else:
                    state.update(b"," + ids.as_py().encode())
            yield pa.RecordBatch.from_pylist(out, schema=kind)
        if current is not None:
            yield pa.RecordBatch.from_pylist([{"skeleton": current, "ends_sha256": state.hexdigest()}], schema=kind)

    kind = pa.schema([("skeleton", pa.int32()), ("ends_sha256", pa.string())])
    # A row is up to PACKED_IDS ids; a node's rows pass through one task, one after another.
    chunks = found.filter("ids IS NOT NULL").select("skeleton", "shard", "chunk", "ids")
    ends = chunks.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "chunk").select("skeleton", "ids").mapInArrow(
        hashed, "skeleton int, ends_sha256 string")
    # One row per skeleton node: at most SKELETON_BYTES / DIGEST of them.
    rows = {r["skeleton"]: r.asDict() for r in parts.join(ends, "skeleton", "left").collect()}
    own_children = [0] * len(skeleton.nodes)
    for at in range(len(skeleton.nodes) - 1, -1, -1):
        row, above = rows[at], skeleton.parent(at)
        row["n_children"] += own_children[at]
        row["n_leaves"] = row["n_leaves"] if row["n_children"] else 1
        row["saved_tokens"] += (row["n_convs"] - 1) * row["bytes"]
        row["depth"] = len(skeleton.nodes[at]) // DIGEST
        row["parent_conv_id"] = None if above is None else rows[above]["conv_id"]
        row["ends_sha256"] = row["ends_sha256"] or hashlib.sha256().hexdigest()
        if above is not None:
            own_children[above] += 1
            rows[above]["n_leaves"] += row["n_leaves"]
            rows[above]["saved_tokens"] += row["saved_tokens"]
    kinds = ("skeleton int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
             "saved_tokens long, ends_sha256 string")
    names = [part.split()[0] for part in kinds.split(", ")]
    return spark.createDataFrame([tuple(rows[at][n] for n in names) for at in range(len(skeleton.nodes))], kinds)


def conversation_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 per node.

    A node is a distinct sequence of first turns (role, text) of rebuilt conversations; its
    members start with it. conv_id is the smallest member, parent_conv_id that of the parent
    (null for the root), n_leaves the childless nodes of the subtree, itself included,
    saved_tokens the bytes of last texts that sharing spares there, ends_sha256 the digest of
    the ids that end here, ascending and joined by commas. Without conversations there is no
    node, not even a root. Other columns of `turns` are not looked at.
    """
    return trie(written(rebuilt(turns), "paths"), shard_turns)

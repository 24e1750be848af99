"""Conversation prefix trie by time-forward processing.

Every distinct sequence of first turns is a node.  Its key is made of sums of
hashes of (place, role, text) over the prefix, which add up in any grouping,
so a conversation of any length is summed in segments on many tasks; nodes are
one aggregation by key (partial before the shuffle, so the root and a common
first turn cost a row per partition).

Subtree totals: a node is *light* if the rows of its members below it number
at most ``limit``.  A largest light subtree is a shard.  The nodes of shards are
sorted by Spark in reverse level order, and each passes its totals to its
parent through a priority queue that spills sorted runs to a task-private,
unnamed file (a lost task starts anew).  Shard roots send their totals, summed
per parent, to the nodes above, of which a level has at most rows / ``limit``;
those are processed the same way, in bands of ``band`` levels from the deepest
one up, so that a task never holds more than a band.

Defined cases: rows with a null ``conv_id`` belong to no conversation and are
left out; null roles and texts are empty; rows of one turn are ordered by
role, then by a hash of the text; ``%`` is the remainder with the dividend's
sign; an empty table gives no rows (there is no smallest member); other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierwise.llm.common import Scratch, map_batches, spill, tidy
from tierwise.operators.ordered import row_number_within

LIMIT = 50_000
BAND = 100_000
SEGMENT = 4096
QUEUE = 200_000
BLOCK = 1 << 16
LANES = ("k1", "k2", "k3", "k4")
EMPTY = hashlib.sha256(b"").hexdigest()

NODE = "shard string, key string, pkey string, conv_id long, depth long, n_convs long, children long, leaves long, saved long"


class SpillingQueue:
    """Smallest first; beyond ``limit`` entries in memory a sorted run goes to
    a file that has no name and ends with the task."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs, self.heads = limit, [], [], []

    def push(self, entry) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.limit:
            run = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
            for e in sorted(self.heap):
                pickle.dump(e, run)
            self.heap = []
            run.seek(0)
            self.runs.append(run)
            self._advance(len(self.runs) - 1)

    def _advance(self, i: int) -> None:
        try:
            heapq.heappush(self.heads, (pickle.load(self.runs[i]), i))
        except EOFError:
            self.runs[i].close()

    def peek(self):
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self):
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            entry, i = heapq.heappop(self.heads)
            self._advance(i)
            return entry
        return heapq.heappop(self.heap)


def time_forward(nodes: DataFrame, by: Column, queue: int = QUEUE) -> DataFrame:
    """Totals of the subtrees within the shards; rows with one value of
    ``by`` are processed together."""
    names = [f.split()[0] for f in NODE.split(", ")]

    def run(batches):
        waiting = SpillingQueue(queue)
        for b in batches:
            out = {n: b.column(n).to_pylist() for n in names}
            for i, (shard, key, pkey, depth) in enumerate(zip(out["shard"], out["key"], out["pkey"], out["depth"], strict=True)):
                children, leaves, saved = out["children"][i], out["leaves"][i], out["saved"][i]
                while (top := waiting.peek()) is not None and top[0] == -depth and top[1] == key:
                    _, _, more, total = waiting.pop()
                    children, leaves, saved = children + 1, leaves + more, saved + total
                leaves = leaves if children else 1
                out["children"][i], out["leaves"][i], out["saved"][i] = children, leaves, saved
                if key != shard and pkey is not None:
                    waiting.push((1 - depth, pkey, leaves, saved))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[n], pa.string() if n in ("shard", "key", "pkey") else pa.int64()) for n in names], names
            )
        tidy()

    level = nodes.select(*names).repartition(by).sortWithinPartitions(F.col("depth").desc(), "key")
    return map_batches(level, run, NODE)


def _lanes(digest: Column) -> list[Column]:
    """Four 40-bit numbers of a hexadecimal digest; sums of up to 2^23 of
    them fit a long."""
    return [F.conv(F.substring(digest, 10 * i + 1, 10), 16, 10).cast("long").alias(k) for i, k in enumerate(LANES)]


def _key(depth: Column, lanes: list[Column]) -> Column:
    return F.md5(F.concat_ws(",", depth, *lanes))


def rebuilt(conversations: DataFrame, scratch: Scratch, every: int = 5, heads: int = 9) -> DataFrame:
    """``conv, len, depth, turn_hash, bytes``: the turns of the rebuilt
    conversations, and a row of depth 0 for each."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    )
    rows = rows.select(
        "conv", "turn", "role", F.sha2("text", 256).alias("text_hash"), F.octet_length("text").cast("long").alias("bytes")
    )
    placed = row_number_within(rows, ["conv"], [F.col("turn").asc_nulls_first(), "role", "text_hash"], "pos")
    said = F.sha2(F.concat_ws(":", F.octet_length("role"), "role", "text_hash"), 256)
    turns = scratch.spill(placed.select("conv", F.col("pos").cast("long").alias("pos"), said.alias("turn_hash"), "bytes"))

    head = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    sizes = turns.groupBy("conv").agg(F.count("*").alias("size"))
    convs = sizes.select("conv", "size", head.alias("h"), (F.col("conv") - F.col("conv") % every).alias("base"))
    convs = convs.join(sizes.select(F.col("conv").alias("base"), F.col("size").alias("base_size")), "base", "left")
    taken = F.least("h", F.coalesce("base_size", F.lit(0)))
    convs = scratch.spill(convs.select("conv", "h", "base", taken.alias("taken"), (taken + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("len")))

    # at most `every` conversations take turns of one, and only its first ones
    first = turns.where(F.col("pos") < heads).withColumnRenamed("conv", "base")
    prefix = first.join(convs, "base").where("pos <= h").select("conv", "len", F.col("pos").alias("depth"), "turn_hash", "bytes")
    own = turns.join(convs, "conv").where("pos > h").select("conv", "len", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "turn_hash", "bytes")
    root = convs.select("conv", "len", F.lit(0).cast("long").alias("depth"), F.lit("").alias("turn_hash"), F.lit(0).cast("long").alias("bytes"))
    return prefix.union(own).union(root)


def prefixes(turns: DataFrame, scratch: Scratch, segment: int = SEGMENT) -> DataFrame:
    """``conv, len, depth, bytes, key, pkey``: each rebuilt prefix, with the
    keys of its node and of the node above."""
    at_place = F.sha2(F.concat_ws(":", "depth", "turn_hash"), 256)
    none = F.col("depth") == 0
    lanes = [F.when(none, 0).otherwise(c).alias(k) for k, c in zip(LANES, _lanes(at_place), strict=True)]
    rows = scratch.spill(turns.select("conv", "len", "depth", "bytes", F.floor(F.col("depth") / segment).alias("seg"), *lanes))
    sums = rows.groupBy("conv", "seg").agg(*(F.sum(k).alias(k) for k in LANES))
    earlier = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("conv", "seg", *(F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"{k}_before") for k in LANES))
    upto = Window.partitionBy("conv", "seg").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.select("*", *(F.sum(k).over(upto).alias(f"{k}_upto") for k in LANES)).join(before, ["conv", "seg"])
    here = [F.col(f"{k}_before") + F.col(f"{k}_upto") for k in LANES]
    above = [c - F.col(k) for c, k in zip(here, LANES, strict=True)]
    return scratch.spill(run.select(
        "conv", "len", "depth", "bytes", _key(F.col("depth"), here).alias("key"), F.when(~none, _key(F.col("depth") - 1, above)).alias("pkey")
    ))


def end_hashes(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """``key, ends_sha256`` of the conversations that end at each node.

    Ids are joined to strings of about ``block`` bytes on many tasks, also
    those of one node; the hash of a node then runs over few strings."""

    def join(batches):
        key, ids, size = None, [], 0
        for b in batches:
            out = []
            for k, c in zip(b.column("key").to_pylist(), b.column("conv").to_pylist(), strict=True):
                if ids and (k != key or size >= block):
                    out.append((key, ids[0], ",".join(map(str, ids))))
                    ids, size = [], 0
                key = k
                ids.append(c)
                size += 12
            yield strings(out)
        if ids:
            yield strings([(key, ids[0], ",".join(map(str, ids)))])

    def strings(rows):
        names = ("key", "first", "ids")
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))], names)

    def digest(batches):
        key, sha = None, None
        for b in batches:
            out = []
            for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if k != key:
                    if sha is not None:
                        out.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield hashes(out)
        if sha is not None:
            yield hashes([(key, sha.hexdigest())])

    def hashes(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(2)], ["key", "ends_sha256"])

    ends = members.where(F.col("depth") == F.col("len")).select("key", "conv")
    parts = map_batches(ends.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv"), join, "key string, first long, ids string")
    return map_batches(parts.repartition("key").sortWithinPartitions("key", "first").select("key", "ids"), digest, "key string, ends_sha256 string")


def trie(conversations: DataFrame, limit: int = LIMIT, band: int = BAND, segment: int = SEGMENT, queue: int = QUEUE) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    with Scratch(conversations.sparkSession, "prefix-trie") as scratch:
        members = prefixes(rebuilt(conversations, scratch), scratch, segment)
        nodes = scratch.spill(members.groupBy("key").agg(
            F.min("conv").alias("conv_id"), F.first("pkey").alias("pkey"), F.first("depth").alias("depth"), F.count("*").alias("n_convs"),
            F.first("bytes").alias("bytes"), F.sum(F.col("len") - F.col("depth") + 1).alias("below"),
        ))
        done = _totals(nodes, members, limit, band, queue, scratch)
        parents = nodes.select(F.col("key").alias("pkey"), F.col("conv_id").alias("parent_conv_id"))
        ends = end_hashes(members)
        return spill(
            done.join(parents, "pkey", "left").join(ends, "key", "left").select(
                "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
            ),
            "prefix-trie",
        )


def _totals(nodes: DataFrame, members: DataFrame, limit: int, band: int, queue: int, scratch: Scratch) -> DataFrame:
    zero = F.lit(0).cast("long")
    own = ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")
    start = nodes.select("key", "pkey", "conv_id", "depth", "n_convs", zero.alias("children"), zero.alias("leaves"), own, "below")
    heavy = scratch.spill(start.where(F.col("below") > limit).drop("below"))
    # heavy nodes are the first ones of a path, so their number is the depth of the shard's root
    above = members.join(heavy.select("key"), "key").groupBy("conv").agg(F.count("*").alias("cut"))
    cuts = members.select("conv", "depth", "key").join(above, "conv", "left").where(F.col("depth") == F.coalesce("cut", F.lit(0)))
    light = start.where(F.col("below") <= limit).drop("below")
    light = light.join(cuts.select(F.col("conv").alias("conv_id"), F.col("key").alias("shard")), "conv_id")
    done = scratch.spill(time_forward(light, F.col("shard"), queue))

    deepest = heavy.agg(F.max("depth")).first()[0]
    sent = done.where("key = shard")
    for b in range(-1 if deepest is None else deepest // band, -1, -1):
        levels = heavy.where(F.floor(F.col("depth") / band) == b)
        got = sent.groupBy("pkey").agg(F.count("*").alias("c"), F.sum("leaves").alias("l"), F.sum("saved").alias("s")).withColumnRenamed("pkey", "key")
        fed = levels.join(got, "key", "left").select(
            "key", "pkey", "conv_id", "depth", "n_convs", *((F.col(x) + F.coalesce(y, F.lit(0))).alias(x) for x, y in (("children", "c"), ("leaves", "l"), ("saved", "s")))
        )
        # a band's first level sends to the band above
        top = F.when(F.col("depth") == b * band, F.col("key")).otherwise(F.lit(""))
        finished = scratch.spill(time_forward(fed.withColumn("shard", top), F.lit(b), queue))
        # light shards below higher bands have yet to be received there
        sent = sent.select("key", "pkey", "leaves", "saved", "shard").union(finished.where("key = shard").select("key", "pkey", "leaves", "saved", "shard"))
        done = done.unionByName(finished)
    return done

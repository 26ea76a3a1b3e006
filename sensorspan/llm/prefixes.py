"""The trie of all conversation prefixes, by vertical bitmaps.

Conversations are cut into shards, a run of neighbouring ids each, and their
turns into blocks of ``BLOCK`` positions. In a shard every (position, turn) is
indexed by a bitset of the conversations that have that turn there. A walk in
depth intersects the bitset of a node with the postings of the next position;
what is left are its children, whose population counts are their conversations,
and the intersection with those that are over gives the list of ends. Local
tries of the shards are merged by a digest of the prefix.

No task holds more than a shard and a block, whether many conversations are
equal or one of them has most of the rows. Texts are not shuffled, only
SHA-256 digests of the turns and their sizes. A prefix is known by 128 bits,
the exclusive or of hashes of its (depth, turn) pairs.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, saved

FAMILY = 5
MOST_SHARED = 8

# Positions of a block, and conversations of a shard.
BLOCK = 64
SHARD = 1024

NODE = ["depth", "d1", "d2"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """The turns of ``conversations`` as (conv_id, index, key, size), without their texts.

    ``key`` is the SHA-256 of role and text, ``size`` the text's bytes in UTF-8, ``index``
    the place among the turns of the conversation, from 0: by turn, null first, then by key.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    key = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.unhex(key).alias("key"),
        F.octet_length(text).cast("long").alias("size"),
    )
    return numbered(rows, ["conv_id"], ["turn", "key"], "index").select("conv_id", "index", "key", "size")


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the head of its family."""
    return F.crc32(conv_id.cast("string")) % (MOST_SHARED + 1)


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations that share their first turns with the head of their family, as (conv_id, depth, key, size).

    Conversation c takes the first turns of c - c % 5 and goes on with its own after
    as many. Every conversation has a row of depth 0, whose key is null.
    """
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("_turns"))
    heads = counts.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("_family"), "_turns")
    convs = saved(
        counts.select("conv_id", family.alias("_family"), shared_turns(F.col("conv_id")).alias("_shared"))
        .join(heads, "_family", "left")
        .withColumn("_taken", F.least("_shared", F.coalesce("_turns", F.lit(0))))
        .select("conv_id", "_family", "_shared", "_taken")
    )
    own = turns.join(convs, "conv_id").where(F.col("index") >= F.col("_shared"))
    own = own.select("conv_id", (F.col("index") - F.col("_shared") + F.col("_taken") + 1).alias("depth"), "key", "size")
    first = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("index") < MOST_SHARED))
    first = first.select(F.col("conv_id").alias("_family"), "index", "key", "size")
    taken = convs.join(first, "_family").where(F.col("index") < F.col("_shared"))
    taken = taken.select("conv_id", (F.col("index") + 1).alias("depth"), "key", "size")
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("key"), F.lit(0).cast("long").alias("size"))
    return roots.union(own).union(taken)


def _block() -> Column:
    return F.floor((F.greatest(F.col("depth"), F.lit(1)) - 1) / BLOCK).cast("long")


def _accumulated(rows: DataFrame, combine, both, values: dict[str, Column], onward: bool = True) -> DataFrame:
    """Running aggregates over the depths of each conversation, in the order of depth or against it.

    They run inside the blocks, and what the blocks before come to is added, so that no task
    gets all rows of a long conversation. ``both`` puts two partial results together.
    """
    sense = (lambda name: F.col(name).asc()) if onward else (lambda name: F.col(name).desc())
    inside = Window.partitionBy("conv_id", "block").orderBy(sense("depth")).rowsBetween(Window.unboundedPreceding, 0)
    outside = Window.partitionBy("conv_id").orderBy(sense("block")).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "block").agg(*(combine(value).alias(name) for name, value in values.items()))
    before = totals.select(
        F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), *(combine(name).over(outside).alias(f"_{name}") for name in values)
    ).where(F.col(f"_{next(iter(values))}").isNotNull())
    running = rows.select("*", *(combine(value).over(inside).alias(name) for name, value in values.items()))
    joined = running.join(before, (F.col("conv_id") == F.col("_conv")) & (F.col("block") == F.col("_block")), "left")
    return joined.select(
        *rows.columns, *(F.coalesce(both(F.col(name), F.col(f"_{name}")), F.col(name)).alias(name) for name in values)
    )


def with_prefixes(rows: DataFrame) -> DataFrame:
    """``rebuilt`` rows with their block, the digest of the prefix that ends there (d1, d2), that of its
    parent (p1, p2), and the conversation's number of turns."""
    lengths = rows.groupBy("conv_id").agg(F.max("depth").alias("length"))
    zero = F.lit(0).cast("long")
    own = {
        "d1": F.when(F.col("depth") > 0, F.xxhash64("depth", "key")).otherwise(zero),
        "d2": F.when(F.col("depth") > 0, F.xxhash64("key", "depth", F.lit("prefix"))).otherwise(zero),
    }
    placed = rows.withColumn("block", _block())
    found = _accumulated(placed, F.bit_xor, lambda a, b: a.bitwiseXOR(b), own)
    parents = [F.col(name).bitwiseXOR(value).alias(f"p{name[1]}") for name, value in own.items()]
    return found.select("*", *parents).join(lengths, "conv_id")


class Shard:
    """The turns of a run of conversations in one block, indexed by bitsets of conversations."""

    def __init__(self, conv: np.ndarray, depth: np.ndarray, length: np.ndarray, key: list, parent: list):
        """``conv`` ascends, and so does ``depth`` for each of them. ``parent`` is a row's parent's digest."""
        firsts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        self.ids = conv[firsts]
        self.row = (firsts - depth[firsts]).tolist()  # the row of a member at depth d is row[member] + d
        self.key = key
        self.postings: dict[tuple, int] = defaultdict(int)
        self.present: dict[int, int] = defaultdict(int)
        self.ended: dict[int, int] = defaultdict(int)
        self.entries: dict[tuple, int] = defaultdict(int)
        member = np.repeat(np.arange(len(firsts)), np.diff(firsts, append=len(conv))).tolist()
        for row, (who, at, last) in enumerate(zip(member, depth.tolist(), length.tolist())):
            bit = 1 << who
            self.postings[at, key[row]] |= bit
            self.present[at] |= bit
            if at == last:
                self.ended[at] |= bit
            if row == firsts[who]:
                self.entries[at, parent[row]] |= bit

    def members(self, bits: int) -> list[int]:
        octets = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), np.uint8)
        return self.ids[np.flatnonzero(np.unpackbits(octets, bitorder="little"))].tolist()

    def nodes(self) -> Iterator[tuple[int, int, int, list[int]]]:
        """Every node as its first row, smallest member, number of members and ends, in depth-first order."""
        stack = [(at, bits) for (at, _), bits in self.entries.items()]
        while stack:
            at, left = stack.pop()
            while left:
                least = (left & -left).bit_length() - 1
                row = self.row[least] + at
                child = left & self.postings[at, self.key[row]]
                left ^= child
                ends = child & self.ended[at]
                yield row, int(self.ids[least]), child.bit_count(), self.members(ends) if ends else []
                if onward := child & self.present[at + 1]:
                    stack.append((at + 1, onward))


_ROWS = ["conv_id", "depth", "length", "key", "d1", "d2", "p1", "p2", "size"]
_LOCAL = pa.schema(
    [(name, pa.int64()) for name in ("depth", "d1", "d2", "p1", "p2", "size", "conv_id", "n_convs")] + [("ends", pa.list_(pa.int64()))]
)


def shard_nodes(table: pa.Table) -> pa.RecordBatch:
    """The local trie of one shard and block."""
    whole = table.combine_chunks()
    values = {name: whole.column(name).to_numpy() for name in _ROWS if name != "key"}
    parent = list(zip(values["p1"].tolist(), values["p2"].tolist()))
    shard = Shard(values["conv_id"], values["depth"], values["length"], whole.column("key").to_pylist(), parent)
    rows, least, count, ends = zip(*shard.nodes())
    at = np.array(rows)
    columns = [pa.array(values[name][at]) for name in ("depth", "d1", "d2", "p1", "p2", "size")]
    columns += [pa.array(least, pa.int64()), pa.array(count, pa.int64()), pa.array(ends, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, schema=_LOCAL)


def local_tries(rows: DataFrame) -> DataFrame:
    """Nodes of the tries of all shards: a node is once in each shard where it has members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        shard = last = None
        convs = 0
        for batch in batches:
            ids, blocks = (batch.column(batch.schema.get_field_index(name)).to_numpy() for name in ("conv_id", "block"))
            news = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (blocks[1:] != blocks[:-1])]) if len(ids) else ()
            start = 0
            for at in news:
                now = (int(blocks[at]), int(ids[at]))
                if now == last:
                    continue
                if convs == SHARD or (shard is not None and shard != now[0]):
                    if at > start:
                        held.append(batch.slice(start, at - start))
                    yield shard_nodes(pa.Table.from_batches(held))
                    held, start, convs = [], int(at), 0
                shard, last, convs = now[0], now, convs + 1
            if len(ids) > start:
                held.append(batch.slice(start))
        if held:
            yield shard_nodes(pa.Table.from_batches(held))

    dealt = rows.select("block", *_ROWS).repartitionByRange("block", "conv_id").sortWithinPartitions("block", "conv_id", "depth")
    return dealt.mapInArrow(run, ", ".join(f"{f.name} {'array<long>' if f.name == 'ends' else 'long'}" for f in _LOCAL))


def end_digests(local: DataFrame) -> DataFrame:
    """For each node with ends the SHA-256 of their ids, ascending, with commas between.

    The lists of the shards are hashed one after another, so that a node's ids are
    never held together. A hash has no parallel form: the lists of one node go through one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = digest = None
        for batch in batches:
            done: list[tuple] = []
            columns = [batch.column(batch.schema.get_field_index(name)) for name in [*NODE, "ends"]]
            for *now, ends in zip(*(column.to_pylist() for column in columns)):
                if now != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = now, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(",".join(map(str, ends)).encode())
            yield _ends(done)
        if node is not None:
            yield _ends([(*node, digest.hexdigest())])

    def _ends(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], [*NODE, "ends_sha256"])

    with_ends = local.where(F.size("ends") > 0).withColumn("first", F.element_at("ends", 1))
    dealt = with_ends.repartition("d1", "d2").sortWithinPartitions(*NODE, "first").select(*NODE, "ends")
    return dealt.mapInArrow(run, "depth long, d1 long, d2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations, the empty one included.

    ``conversations`` has conv_id, turn, role and text. Returns conv_id (smallest
    member), depth, parent_conv_id (smallest member of the parent; null at the root),
    n_convs (members), n_children, n_leaves (nodes without children in the subtree),
    saved_tokens (bytes of texts that the subtree's members share, each counted but once)
    and ends_sha256 (of the members that end here; of nothing, if none).

    Turns are in the order of ``turn``, null first, equal ones in that of the SHA-256 of role and text.
    Null roles and texts are empty. Repeated rows are turns of their own. Rows without a conv_id
    belong to no conversation. No conversations have no root, so no rows. Other columns are ignored.
    """
    rows = saved(with_prefixes(rebuilt(turns_of(conversations))).select("block", *_ROWS))
    local = saved(local_tries(rows))
    merged = local.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.max("size").alias("size"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
    )
    children = merged.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2"))
    nodes = saved(
        merged.join(children.agg(F.count("*").alias("n_children")), NODE, "left").withColumn(
            "n_children", F.coalesce("n_children", F.lit(0).cast("long"))
        )
    )
    # A conversation is the smallest member of the nodes from some depth on. What these come to, from a
    # depth to the end, belongs to the node which the conversation passes at that depth.
    owned = nodes.select(
        "conv_id",
        "depth",
        (F.col("n_children") == 0).cast("long").alias("_leaf"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("_saved"),
    )
    parts = rows.select("conv_id", "block", *NODE).join(owned, ["conv_id", "depth"], "left")
    values = {name: F.coalesce(F.col(f"_{part}"), F.lit(0).cast("long")) for name, part in (("n_leaves", "leaf"), ("saved_tokens", "saved"))}
    sums = _accumulated(parts, F.sum, lambda a, b: a + b, values, onward=False)
    sums = sums.groupBy(*NODE).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    nothing = hashlib.sha256().hexdigest()
    # The root has no parent, though its own digest and that of its parent are both 0.
    return (
        nodes.join(sums, NODE)
        .join(end_digests(local), NODE, "left")
        .join(parents, ["depth", "p1", "p2"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )

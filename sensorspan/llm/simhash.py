"""Near duplicates by SimHash fingerprints that differ in a few bits.

Equal fingerprints are one node. The 64 bits are cut into blocks; two
fingerprints with at most ``distance`` different bits agree on all but
``distance`` of the blocks, so each choice of that many blocks to leave out gives a
key that close pairs share. Rows with equal keys form buckets, whose members are compared bit by
bit. With 6 blocks a key has over 30 bits, so unlike fingerprints rarely meet.

A bucket is never gathered whole: beyond ``TILE`` members it is cut by a
second hash into chunks, and each pair of chunks is a tile of its own. A tile
returns a spanning forest of its links, fewer edges than it has members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import saved
from .components import connected_components

BITS = 64
DISTANCE = 3
BLOCKS = 6
SHINGLE = 3
SEED = 42
TILE = 2048


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text's word shingles, repeats included; zero without words."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and U+0009 to U+000D only
    if not found:
        return 0
    if len(found) < shingle:
        shingles = [b" ".join(found)]
    else:
        shingles = list(map(b" ".join, zip(*(found[i:] for i in range(shingle)))))
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles)))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of some hashes."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        octets = hashes[start : start + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` (text and any others) and, in a last column, the fingerprint of the text as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            values = np.array([fingerprint(t.as_py()) for t in texts], np.uint64)
            yield batch.append_column(name, pa.array(values.view(np.int64)))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp of every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_fingerprints(rows, "fp").select("doc_id", "fp")


def block_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """For each choice of blocks to agree on, their bits as a signed long."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    block = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    masks = [sum(chosen) for chosen in combinations(block, blocks - distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _tiles(size: Column, fp: Column) -> Column:
    """The tiles (row, column) of a bucket of ``size`` that a member belongs to."""
    chunks = F.ceil(size / TILE).cast("int")
    own = F.pmod(F.xxhash64(fp, F.lit("chunk")), chunks).cast("int")
    return F.transform(
        F.sequence(F.lit(0), chunks - 1), lambda other: F.struct(F.least(own, other).alias("row"), F.greatest(own, other).alias("col"))
    )


def forest(members: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """For each member that close pairs connect to a lesser one: the least it is connected to, and itself."""
    roots, reached = [], []
    left = np.sort(members.view(np.int64)).view(np.uint64)
    while len(left) > 1:
        least, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= distance
            if near.any():
                queue.extend(left[near])
                reached.append(left[near])
                roots.append(np.full(len(reached[-1]), least))
                left = left[~near]
    none = np.empty(0, np.uint64)
    return np.concatenate([none, *roots]), np.concatenate([none, *reached])


def _links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Edges of each tile; the rows of a tile come one after another."""

    def edges(ids: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.flatnonzero(np.any(ids[1:] != ids[:-1], axis=1)) + 1
        starts, ends = np.r_[0, cuts], np.r_[cuts, len(ids)]
        a, b = [], []
        two = starts[ends - starts == 2]
        close = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= distance]
        a.append(fps[close].view(np.int64))
        b.append(fps[close + 1].view(np.int64))
        for start, end in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
            roots, reached = forest(fps[start:end], distance)
            a.append(roots.view(np.int64))
            b.append(reached.view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    held_ids, held_fps = np.empty((0, 4), np.int64), np.empty(0, np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "key", "row", "col")]).astype(np.int64)
        ids = np.concatenate([held_ids, ids])
        fps = np.concatenate([held_fps, batch.column("fp").to_numpy().view(np.uint64)])
        last = np.flatnonzero(np.any(ids != ids[-1], axis=1))
        cut = last[-1] + 1 if len(last) else 0
        if cut:
            yield from edges(ids[:cut], fps[:cut])
        held_ids, held_fps = ids[cut:], fps[cut:]
    if len(held_ids):
        yield from edges(held_ids, held_fps)


def close_links(nodes: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Edges (a, b) that connect all of the distinct ``nodes`` (fp) within ``distance`` bits."""
    masks = F.array(*(F.lit(m) for m in block_masks(blocks, distance)))
    keyed = nodes.select("fp", F.posexplode(masks).alias("mask", "bits")).select(
        "mask", F.col("fp").bitwiseAND(F.col("bits")).alias("key"), "fp"
    )
    sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("size")).where("size > 1")
    tiles = keyed.join(sizes, ["mask", "key"]).select("mask", "key", "fp", F.explode(_tiles(F.col("size"), F.col("fp"))).alias("tile"))
    tiles = tiles.select("mask", "key", F.col("tile.row").alias("row"), F.col("tile.col").alias("col"), "fp")
    placed = tiles.repartition("mask", "key", "row", "col").sortWithinPartitions("mask", "key", "row", "col")
    return placed.mapInArrow(lambda batches: _links(batches, distance), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its fingerprint and component.

    Returns doc_id, fingerprint (16 hex digits), component_id: the least
    doc_id that can be reached over links of at most ``distance`` differing
    bits, its own included. Null, empty and blank texts have the fingerprint
    zero, which links like any other. Repeated rows stay rows. Null ids
    do not name a component unless no other id is in it. No rows give no
    rows. Other columns are ignored; texts are read whole.
    """
    rows = saved(fingerprints(docs))
    grouped = _grouped(rows, distance, blocks)
    named = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    components = grouped.join(named, "root").select("fp", "component_id")
    return rows.join(components, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _grouped(rows: DataFrame, distance: int, blocks: int) -> DataFrame:
    """The distinct fingerprints of rows (doc_id, fp): fp, least (doc_id), root (the least fp of the component)."""
    nodes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(close_links(nodes.select("fp"), distance, blocks))
    joined = nodes.join(roots, nodes["fp"] == roots["node"], "left")
    return saved(joined.select("fp", "least", F.coalesce("root", "fp").alias("root")))


def keep_one(docs: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """One row of each component of near duplicates among ``docs`` (doc_id, text and any others), as it is.

    The row with the least doc_id stays, of equal ids the one with the least
    fingerprint; a row without an id stays only where no other has one. Repeated rows count as copies.
    """
    name = "_fp"
    while name in docs.columns:
        name += "_"
    chosen = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp")).alias("chosen")
    kept = _grouped(saved(fingerprints(docs)), distance, blocks).groupBy("root").agg(chosen).select("chosen.least", "chosen.fp")
    marked = with_fingerprints(docs, name)
    rows = marked.join(kept, (marked[name] == kept["fp"]) & marked["doc_id"].eqNullSafe(kept["least"]), "left_semi")
    return rows.dropDuplicates(["doc_id", name]).drop(name)

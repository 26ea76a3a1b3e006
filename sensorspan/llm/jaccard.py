"""Near duplicates by SimHash and MinHash of word shingles, verified by exact Jaccard similarity.

Equal shingle sets are one node. A node has operator 1's fingerprint, over its set, and its
links are candidates: fingerprints that differ in a few bits. Sets with a similarity of 0.8
differ in ten of the 64 bits on average, so that alone would lose most of them; the other candidates
come from MinHash, ``BANDS`` keys of ``ROWS`` least hashes each. Two such sets share no key with
a probability of (1 - 0.8^6)^48, below one in a million; more similar ones miss
each other less often yet. Each key links its nodes to the least of them, and
the components of all these links hold all candidate pairs.

Inside such a component the sets themselves are compared. A component beyond
``TILE`` shingles is cut by a hash into chunks, and each pair of chunks is a
tile of its own. A tile returns a spanning forest of its verified links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import saved
from .components import connected_components
from .simhash import close_links, majority

SHINGLE = 5
LEAST = 0.8
BANDS = 48
ROWS = 6
SEED = 42
TILE = 1 << 17
STEP = 1 << 12

_draw = np.random.default_rng(SEED)
MASKS = _draw.integers(1 << 32, size=(BANDS * ROWS, 1), dtype=np.uint32)
FACTORS = _draw.integers(1 << 32, size=(BANDS * ROWS, 1), dtype=np.uint32) | np.uint32(1)


def shingles(text: str | None, length: int = SHINGLE) -> np.ndarray:
    """The hashes of a text's distinct word shingles in order; a shorter text is one shingle, a blank one none."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and U+0009 to U+000D only
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < length:
        pieces = {b" ".join(found)}
    else:
        pieces = set(map(b" ".join, zip(*(found[i:] for i in range(length)))))
    return np.sort(np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(pieces)))


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def node_of(found: np.ndarray) -> int:
    """One signed long for a set of shingles."""
    return signed(xxhash.xxh64_intdigest(found.astype("<u8").tobytes(), SEED))


def bands(found: np.ndarray) -> list[int]:
    """The keys that similar sets share; none for the empty set."""
    if not len(found):
        return []
    short = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, (1 << 32) - 1, np.uint32)
    for start in range(0, len(short), STEP):
        np.minimum(least, ((short[None, start : start + STEP] ^ MASKS) * FACTORS).min(axis=1), out=least)
    rows = least.astype("<u4").reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(rows)], np.uint64).view(np.int64).tolist()


def _with(docs: DataFrame, fields: list[StructField], values) -> DataFrame:
    """``docs`` (text and any others) and, in last columns, what ``values`` gives for each text."""
    schema = StructType([*docs.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.list_(pa.int64()) if isinstance(f.dataType, ArrayType) else pa.int64() for f in fields]
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            columns = zip(*(values(t.as_py()) for t in texts)) if len(texts) else repeat([], len(fields))
            for field, kind, column in zip(fields, kinds, columns):
                batch = batch.append_column(field.name, pa.array(column, kind))
            yield batch

    return docs.mapInArrow(run, schema)


def with_nodes(docs: DataFrame, name: str, length: int = SHINGLE) -> DataFrame:
    """``docs`` and, in a last column, the node of the text."""
    return _with(docs, [StructField(name, LongType())], lambda text: (node_of(shingles(text, length)),))


# An id that may be null as two columns that are not.
_ID = ("_id", "_none")


def _of_nodes(docs: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """The rows of ``docs`` (doc_id, ``name`` and any others) that have a node of ``nodes`` (``name``, least and any others) and its least id.

    They lie by ``name`` and ``_ID``, so that copies are dropped by these without another shuffle of the texts.
    """
    keyed = lambda rows, key: rows.withColumns({"_id": F.coalesce(key, F.lit(0)).cast("long"), "_none": F.col(key).isNull()})
    return keyed(docs, "doc_id").join(keyed(nodes, "least").drop("least"), [name, *_ID])


def forest(sets: list[np.ndarray], least: float = LEAST) -> list[tuple[int, int]]:
    """For each set that links of at least ``least`` connect to an earlier one: the first it is connected to, and itself."""
    sizes = np.array([len(s) for s in sets])
    starts = np.r_[0, np.cumsum(sizes)]
    names, at = np.unique(np.concatenate(sets), return_inverse=True)
    found, left = [], np.arange(len(sets))
    while len(left) > 1:
        root, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            own = queue.pop()
            marked = np.zeros(len(names), bool)
            marked[at[starts[own] : starts[own + 1]]] = True
            common = np.add.reduceat(marked[at], starts[:-1], dtype=np.int64)[left]
            near = common / (sizes[own] + sizes[left] - common) >= least
            queue.extend(left[near])
            found += [(int(root), int(i)) for i in left[near]]
            left = left[~near]
    return found


def fingerprint_links(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect ``nodes`` (node, n, fp) whose fingerprints are equal or close; the empty set has none."""
    found = nodes.where("n > 0").select("node", "fp")
    firsts = saved(found.groupBy("fp").agg(F.min("node").alias("first")))
    equal = found.join(firsts, "fp").where("node > first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    close = close_links(firsts.select("fp")).toDF("_a", "_b")
    for fp, name in (("_a", "a"), ("_b", "b")):
        close = close.join(firsts.toDF(fp, name), fp)
    return equal.union(close.select("a", "b"))


def candidates(nodes: DataFrame) -> DataFrame:
    """The components of ``nodes`` (node, n, fp, keys) with close fingerprints or shared keys: node, root."""
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    firsts = keyed.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("size")).where("size > 1")
    links = keyed.join(firsts.select("key", "first"), "key").where("node > first")
    shared = links.select(F.col("first").alias("a"), F.col("node").alias("b"))
    return connected_components(shared.union(fingerprint_links(nodes)).distinct())


def verified_links(docs: DataFrame, nodes: DataFrame, groups: DataFrame, least: float, length: int) -> DataFrame:
    """Edges (a, b) that connect all ``nodes`` (node, least, n) of the same group that are similar.

    ``docs`` (doc_id, text, node) has the texts; of equal ones that with the least doc_id is read.
    """
    members = saved(groups.join(nodes.select("node", "least", "n"), "node"))
    totals = members.groupBy("root").agg(F.ceil(F.sum("n") / TILE).cast("int").alias("chunks"))
    placed = members.join(totals, "root").select("node", "least", "root", "chunks")
    texts = _of_nodes(docs, placed, "node").dropDuplicates(["node", *_ID])
    own = F.pmod(F.xxhash64("node", F.lit("chunk")), F.col("chunks")).cast("int")
    tiles = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.struct(F.least(own, other).alias("row"), F.greatest(own, other).alias("col")),
    )
    sets = _with(texts.select("node", "root", "chunks", "text"), [StructField("found", ArrayType(LongType()))],
                 lambda text: (shingles(text, length).view(np.int64).tolist(),)).drop("text")
    tiled = sets.select("root", "node", "found", F.explode(tiles).alias("tile"))
    tiled = tiled.select("root", F.col("tile.row").alias("row"), F.col("tile.col").alias("col"), "node", "found")

    def links(tile: pa.Table) -> pa.Table:
        tile = tile.sort_by("node")
        found = tile.column("found").combine_chunks()
        values = found.flatten().to_numpy().view(np.uint64)
        ends = np.cumsum(found.value_lengths().to_numpy())
        ids = tile.column("node").to_numpy()
        pairs = np.array(forest(np.split(values, ends[:-1]), least), np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(ids[pairs[:, 0]]), "b": pa.array(ids[pairs[:, 1]])})

    return tiled.groupBy("root", "row", "col").applyInArrow(links, "a long, b long").distinct()


def components(docs: DataFrame, least: float = LEAST, length: int = SHINGLE) -> DataFrame:
    """The distinct shingle sets of ``docs`` (doc_id, text): node, least (doc_id), root (the least node of the component)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fields = [*(StructField(name, LongType()) for name in ("node", "n", "fp")), StructField("keys", ArrayType(LongType()))]

    def described(text: str | None) -> tuple:
        found = shingles(text, length)
        return node_of(found), len(found), signed(majority(found)), bands(found)

    known = _with(rows, fields, described).drop("text")
    nodes = saved(known.groupBy("node").agg(F.min("doc_id").alias("least"), *(F.first(c).alias(c) for c in ("n", "fp", "keys"))))
    links = verified_links(with_nodes(rows, "node", length), nodes, candidates(nodes), least, length)
    roots = connected_components(links).toDF("_node", "root")
    joined = nodes.join(roots, nodes["node"] == roots["_node"], "left")
    return saved(joined.select("node", "least", F.coalesce("root", "node").alias("root")))


def keep_one(docs: DataFrame, least: float = LEAST, length: int = SHINGLE) -> DataFrame:
    """One row of each component of similar texts among ``docs`` (doc_id, text and any others), as it is.

    Texts are linked if the Jaccard similarity of their shingles of ``length``
    words is at least ``least``; the keys are made for 0.8 and more. The row with
    the least doc_id stays, of equal ids the one with the least node; a row without
    an id stays only where no other has one. Repeated rows and texts without words
    count as copies.
    """
    name = "_node"
    while name in docs.columns:
        name += "_"
    chosen = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "node")).alias("chosen")
    kept = components(docs, least, length).groupBy("root").agg(chosen).select(F.col("chosen.node").alias(name), "chosen.least")
    rows = _of_nodes(with_nodes(docs, name, length), kept, name)
    return rows.dropDuplicates([name, *_ID]).select(*docs.columns)

"""Shards of nearly equal size that keep equal texts together.

Minimax contiguous partition: groups of equal texts are atomic and ordered by
the hash of their text; the smallest capacity at which a greedy walk needs no
more than the given shards is found by bisection, and the order is cut there.
Groups above the even share come first and take a shard each, so that one
huge group of copies does not widen the other shards.

The driver never sees all groups, however their sizes are spread. It walks over
cells, that is over sums of groups whose hashes begin alike, for one capacity at
a time, and asks for finer sums only of the few cells around each cut. The
result is the one of a walk over single groups.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ranked, saved

# Hash digits of the first cells and of each refinement: 65,536 cells, then
# 256 for each cell that holds a cut.
FIRST_DIGITS = 4
MORE_DIGITS = 2
# Cells refined at once at either side of where a cut may lie, and how many
# times the first cells are held before the finer ones of earlier capacities go.
WIDE = 8
HELD = 4
DIGITS = 64
OVERHEAD = 16


@dataclass(frozen=True, slots=True)
class Cell:
    """Groups whose hash starts with ``prefix``, as one piece of the order."""

    prefix: str
    size: int
    groups: int
    largest: int


def walk(sizes: list[int], capacity: int) -> list[int]:
    """Where greedy shards of ``capacity`` start; each size must fit by itself."""
    starts, room = [], -1
    for i, size in enumerate(sizes):
        if size > room:
            starts.append(i)
            room = capacity
        room -= size
    return starts


def smallest_capacity(sizes: list[int], shards: int, low: int) -> int:
    """The least capacity, not under ``low``, for which ``walk`` needs at most ``shards``."""
    low = max([low, -(-sum(sizes) // shards), *sizes[:1]])
    high = max(low, sum(sizes))
    low = max([low, *sizes])
    while low < high:
        middle = (low + high) // 2
        if len(walk(sizes, middle)) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def _cells(groups: DataFrame, digits: int, within: list[str] | None = None) -> list[Cell]:
    """The cells of ``digits`` hash digits, or those of ``digits`` more inside the cells ``within``."""
    prefix = F.substring("key", 1, digits)
    if within is not None:
        prefix = F.lit(None)
        for length in {len(p) for p in within}:
            held = F.substring("key", 1, length).isin([p for p in within if len(p) == length])
            prefix = F.when(held, F.substring("key", 1, length + digits)).otherwise(prefix)
    rows = (
        groups.select(prefix.alias("prefix"), "size")
        .where(F.col("prefix").isNotNull())
        .groupBy("prefix")
        .agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.max("size").alias("largest"))
        .collect()
    )
    return sorted((Cell(r["prefix"], r["size"], r["n"], r["largest"]) for r in rows), key=lambda c: c.prefix)


def _ends(cells: list[Cell], edges: list[int], capacity: int, shards: int) -> tuple[list[int], list[int], set[int]]:
    """Of each shard's end the least and the greatest place (sum of sizes before it), and cells that would tell more.

    A shard that starts later does not end earlier. So the ends lie between a
    walk that stops before the cell it cannot take whole, and one that is full
    inside a cell of several groups. ``edges`` are the sums before each cell.
    """
    low = high = 0
    lows, highs, open_ = [], [], set()
    for _ in range(shards):
        i, j = bisect_right(edges, low + capacity) - 1, bisect_right(edges, high + capacity) - 1
        inside = j < len(cells) and cells[j].groups > 1
        low, high = edges[i], high + capacity if inside else edges[j]
        lows.append(low)
        highs.append(high)
        if low < high:
            last = min(j, len(cells) - 1)
            near = {*range(i, min(i + WIDE, last + 1)), *range(max(i, last + 1 - WIDE), last + 1)}
            open_ |= {c for c in near if cells[c].groups > 1}
    return lows, highs, open_


def _cut(groups: DataFrame, shards: int) -> list[str]:
    """Hash prefixes at which the shards after the first start."""
    first = cells = _cells(groups, FIRST_DIGITS)
    if not cells or shards < 2:
        return []
    sizes = [c.size for c in cells]
    total = sum(sizes)
    low = max(max(c.largest for c in cells), -(-total // shards))
    high = smallest_capacity(sizes, shards, low)
    while True:
        middle = (low + high) // 2
        if len(cells) > HELD * len(first):
            cells = first
        while True:
            edges = [0, *accumulate(c.size for c in cells)]
            lows, highs, open_ = _ends(cells, edges, middle, shards)
            fits, too_small = lows[-1] == total, highs[-1] < total
            if lows == highs or (low < high and (fits or too_small)):
                break
            finer = _cells(groups, MORE_DIGITS, [cells[i].prefix for i in sorted(open_)])
            cells = sorted([*(c for i, c in enumerate(cells) if i not in open_), *finer], key=lambda c: c.prefix)
        if low == high:
            return [cells[bisect_left(edges, end)].prefix for end in lows if end < total]
        if fits:
            high = middle
        else:
            low = middle + 1


def plan(groups: DataFrame, shards: int) -> tuple[list[str], list[str]]:
    """Of groups (key, size): keys with a shard of their own, first keys of the shards after those and one."""
    largest = groups.orderBy(F.desc("size"), "key").limit(shards - 1).collect() if shards > 1 else []
    total = groups.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    alone: list[str] = []
    for row in largest:
        if row["size"] * (shards - len(alone)) <= total:
            break
        alone.append(row["key"])
        total -= row["size"]
    rest = groups.where(~F.col("key").isin(alone)) if alone else groups
    return alone, _cut(rest, shards - len(alone))


def shard_of(key: Column, alone: list[str], starts: list[str]) -> Column:
    shard = F.lit(len(alone)).cast("int")
    if starts:
        passed = F.filter(F.array(*map(F.lit, starts)), lambda start: start <= key)
        shard = shard + F.size(passed)
    for i, own in enumerate(alone):
        shard = F.when(key == own, i).otherwise(shard)
    return shard.cast("int")


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Put every row of ``docs`` (doc_id, text) into one of ``shards`` shards.

    Returns doc_id, size (UTF-8 bytes of the text and 16), text_crc32, law
    (`bytes`), shard, slot (from 0 without gaps in each shard), grown_shard
    (null: another number of shards moves all cuts). Rows with equal texts
    share a shard. A null text counts 16 and a crc32 of 0 and stays with the
    other null texts, apart from empty ones. Repeated rows and repeated or null
    ids are rows like any other and get slots of their own. No rows give no
    rows; fewer groups than shards leave shards empty. Other columns are ignored.
    """
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = saved(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(data) + OVERHEAD).cast("long").alias("size"),
            F.crc32(data).cast("long").alias("text_crc32"),
            F.coalesce(F.sha2(F.encode("text", "UTF-8"), 256), F.lit("0" * DIGITS)).alias("key"),
        )
    )
    groups = saved(rows.groupBy("key").agg(F.sum("size").alias("size")))
    alone, starts = plan(groups, shards)
    placed = rows.withColumn("shard", shard_of(F.col("key"), alone, starts))
    return ranked(placed, ["shard"], [], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""Collocations: phrases whose words come together far more often than apart.

Partitioned mining (SON). The documents are dealt into shards by a hash of
their text. In a shard with a share of a language's words a phrase is locally
frequent if it has that share of the support, rounded up. A phrase that is
frequent overall is locally frequent in at least one shard, so the union of
the locally frequent ones lacks none; all of them that their local counts
allow to be frequent are then counted exactly.

A shard is not a task: its rows may be in all tasks, and its counts are
aggregated by Spark, so the shards can be few, which keeps the local support
above one, however large the corpus is. Inside a shard phrases are mined
completely, word by word: a phrase of n words is counted only where both its
parts of n-1 words are locally frequent. Tasks learn which are by a Bloom
filter of bounded size. Mining knows phrases by hashes. What a hash or
the filter takes for frequent by mistake only adds candidates; the last count
compares the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

SUPPORT = 30
LONGEST = 4
SHARDS = 5
CONTAINED_PERCENT = 80
MOST_PHRASES = 2000
UNKNOWN = "und"
SCALE = 2_000_000

# Bytes of text that are worked on at once, cut at the end of a piece, and that are hashed at once.
CHUNK = 1 << 22
HASHED = 1 << 20
# Counts that a task holds before it hands them on.
HELD = 1 << 21
# The filter has 16 bits for each key, up to 128 MB.
BITS_A_KEY = 16
MOST_BITS = 1 << 30
BLOCK_BITS = 1 << 15
# Groups that the phrases of a language are ranked in before they meet.
RANK_GROUPS = 32

# A key is a shard, a class of languages and a hash of language and words, in one long.
HASH_BITS = 46
CLASS_BITS = 8
MOST_SHARDS = 1 << (63 - HASH_BITS - CLASS_BITS)

_END = ord("\n")
_SPACE = ord(" ")
# Arithmetic is modulo 2**64. The constants are those of splitmix64; all are odd.
_BASE = 0x9E3779B97F4A7C15
_MIX_1 = 0xBF58476D1CE4E5B9
_MIX_2 = 0x94D049BB133111EB


def _byte_classes() -> np.ndarray:
    """A-Z lower-cased, a tab as a space, what ends a piece as a line feed."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    table[ord("\t")] = _SPACE
    for mark in b".,;:!?\n\x0b\x0c\r":
        table[mark] = _END
    return table


_CLASSES = _byte_classes()


def mixed(values: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit depends on every bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(_MIX_1)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(_MIX_2)
    return values ^ (values >> np.uint64(31))


def _powers(base: int, size: int) -> np.ndarray:
    return np.cumprod(np.full(size, base, np.uint64))


@dataclass
class Chunk:
    """The words of some text in order; ``row`` tells the document of each."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray
    row: np.ndarray

    def hashes(self) -> np.ndarray:
        """A hash of each word by its bytes: differences of a running polynomial, moved to power 0."""
        out = np.empty(len(self.starts), np.uint64)
        cuts = np.unique(np.searchsorted(self.starts, np.arange(0, len(self.data) + HASHED, HASHED)))
        powers = back = np.empty(0, np.uint64)
        for low, high in zip(cuts, cuts[1:]):
            begin = self.starts[low]
            part = self.data[begin : self.ends[high - 1]]
            if len(part) > len(powers):
                powers, back = _powers(_BASE, len(part)), _powers(pow(_BASE, -1, 1 << 64), len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part + np.uint64(1)) * powers[: len(part)], out=sums[1:])
            starts = self.starts[low:high] - begin
            out[low:high] = (sums[self.ends[low:high] - begin] - sums[starts]) * back[starts]
        return mixed(out)

    def words(self) -> pa.DictionaryArray:
        """The words themselves, each distinct one once."""
        inside = (self.data != _SPACE) & (self.data != _END)
        offsets = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=offsets[1:])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(self.data[inside])]
        return pa.Array.from_buffers(pa.large_binary(), len(self.starts), buffers).dictionary_encode()

    def whole(self, size: int) -> np.ndarray:
        """Whether ``size`` words from each word on are in its piece; the last words have no such place."""
        last = len(self.piece) - size + 1
        return self.piece[: max(last, 0)] == self.piece[size - 1 :]


def chunks(batch: pa.RecordBatch) -> Iterator[Chunk]:
    """The words of a batch's texts, about ``CHUNK`` bytes at a time. Every text ends with a line feed."""
    texts = batch.column(0).cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    firsts = offsets[:-1] - offsets[0]
    start = 0
    while start < len(data):
        end = _cut(data, start)
        part = _CLASSES[data[start:end]]
        outside = (part == _SPACE) | (part == _END)
        edges = np.flatnonzero(np.diff(outside, prepend=True))
        if len(edges):
            begins, ends = edges[0::2], edges[1::2]
            pieces = np.cumsum(part == _END, dtype=np.int32)[begins]
            rows = np.searchsorted(firsts, begins + start, side="right") - 1
            yield Chunk(part, begins, ends, pieces, rows)
        start = end


def _cut(data: np.ndarray, start: int) -> int:
    """The end of a piece about ``CHUNK`` bytes after ``start``; a longer piece stays whole."""
    end = start + CHUNK
    if end >= len(data):
        return len(data)
    before = np.flatnonzero(_CLASSES[data[start:end]] == _END)
    if len(before):
        return start + int(before[-1]) + 1
    while not (after := np.flatnonzero(_CLASSES[data[end : end + CHUNK]] == _END)).size:
        end += CHUNK
    return end + int(after[0]) + 1


def _languages(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array]:
    """The number of each row's language in the batch, and the languages."""
    found = batch.column(1).dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def _seeds(languages: pa.Array) -> np.ndarray:
    """A hash of each language; the last bits are its class."""
    return np.array([xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass")) for name in languages.to_pylist()], np.uint64)


def _classes(seeds: np.ndarray) -> np.ndarray:
    return seeds & np.uint64((1 << CLASS_BITS) - 1)


def lengthened(shorter: np.ndarray, words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the phrases of ``size`` words from those with a word less."""
    last = max(len(words) - size + 1, 0)
    return mixed(shorter[:last] * np.uint64(_BASE) + words[size - 1 :])


def _keys(hashes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Keys of hashes; ``place`` is the shard and class of each word."""
    return (hashes >> np.uint64(64 - HASH_BITS)) | (place[: len(hashes)] << np.uint64(HASH_BITS))


def _probes(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    spread, mask = mixed(keys), np.uint64(bits - 1)
    return (spread & mask).astype(np.int64), ((spread >> np.uint64(32)) & mask).astype(np.int64)


class KeyFilter:
    """A Bloom filter of keys with two probes, no larger than ``MOST_BITS``."""

    def __init__(self, bits: int, blocks: dict[int, bytes]):
        self.bits = bits
        self.bytes = np.zeros(bits // 8, np.uint8)
        for number, block in blocks.items():
            start = (number - 1) * (BLOCK_BITS // 8)
            self.bytes[start : start + len(block)] = np.frombuffer(block, np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        one, other = ((self.bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 for at in _probes(keys, self.bits))
        return (one & other) == 1


def key_filter(keys: DataFrame) -> Broadcast:
    """The filter of ``keys`` (key), made of blocks of 4 KB that Spark aggregates."""
    bits, count = BLOCK_BITS, keys.count()
    while bits < min(count * BITS_A_KEY, MOST_BITS):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in _probes(batch.column(0).to_numpy().view(np.uint64), bits):
                yield pa.RecordBatch.from_arrays([pa.array(at + 1)], ["bit"])

    blocks = (
        keys.select("key").mapInArrow(run, "bit long")
        .groupBy(F.bitmap_bucket_number("bit").alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    )
    found = {row["block"]: bytes(row["bits"]) for row in blocks.toLocalIterator()}
    return keys.sparkSession.sparkContext.broadcast(KeyFilter(bits, found))


class Tally:
    """Counts by key, as many as fit into bounded memory."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(np.unique(keys, return_counts=True))
        self.size += len(self.parts[-1][0])
        if self.size > HELD:
            self._merge()
            if self.size > HELD // 2:
                yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        for keys, counts in self.parts:
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts, pa.int64())], ["key", "n"])
        self.parts, self.size = [], 0

    def _merge(self) -> None:
        if len(self.parts) > 1:
            keys, counts = (np.concatenate(column) for column in zip(*self.parts))
            order = np.argsort(keys)
            keys = keys[order]
            firsts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            self.parts = [(keys[firsts], np.add.reduceat(counts[order], firsts))]
            self.size = len(firsts)


def word_totals(rows: DataFrame) -> DataFrame:
    """The number of words of each language in each shard, with the language's class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, names = _languages(batch)
            classes, shards = _classes(_seeds(names)).astype(np.int64), batch.column(2).to_numpy()
            for chunk in chunks(batch):
                cells, count = np.unique(shards[chunk.row] * len(names) + codes[chunk.row], return_counts=True)
                shard, name = cells // len(names), cells % len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int64()), names.take(pa.array(name)), pa.array(classes[name]), pa.array(count, pa.int64())],
                    ["shard", "lang", "class", "n"],
                )

    found = rows.mapInArrow(run, "shard long, lang string, class long, n long")
    return found.groupBy("shard", "lang", "class").agg(F.sum("n").alias("n"))


def local_counts(rows: DataFrame, size: int, shorter: Broadcast | None) -> DataFrame:
    """How often phrases of ``size`` words come in each shard, as (key, n).

    ``shorter`` filters the locally frequent phrases with a word less; a phrase
    without both its parts among them is not counted. Tasks count what they have
    before they hand it on, so it is dealt out by key without another partial count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            codes, names = _languages(batch)
            seeds, shards = _seeds(names), batch.column(2).to_numpy().astype(np.uint64)
            places = (shards << np.uint64(CLASS_BITS)) | _classes(seeds)[codes]
            for chunk in chunks(batch):
                words = mixed(chunk.hashes() ^ seeds[codes[chunk.row]])
                hashes, place = words, places[chunk.row]
                for length in range(2, size):
                    hashes = lengthened(hashes, words, length)
                if size > 1:
                    frequent = shorter.value.has(_keys(hashes, place))
                    counted = chunk.whole(size) & frequent[:-1] & frequent[1:]
                    keys = _keys(lengthened(hashes, words, size), place)[counted]
                else:
                    keys = _keys(words, place)
                yield from tally.add(keys)
        yield from tally.rest()

    found = rows.mapInArrow(run, "key long, n long").repartition("key")
    return found.groupBy("key").agg(F.sum("n").alias("n"))


def candidate_counts(rows: DataFrame, candidates: Broadcast, longest: int) -> DataFrame:
    """How often each candidate of 1 to ``longest`` words comes in all shards, as (lang, phrase, size, a).

    The filter says which hashes are candidates; phrases are counted by their words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, names = _languages(batch)
            seeds = _seeds(names)
            for chunk in chunks(batch):
                yield from _chunk_counts(chunk, codes[chunk.row], names, seeds, candidates.value, longest)

    found = rows.mapInArrow(run, "lang string, phrase binary, size int, n long")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("a"))


def _chunk_counts(
    chunk: Chunk, codes: np.ndarray, names: pa.Array, seeds: np.ndarray, known: KeyFilter, longest: int
) -> Iterator[pa.RecordBatch]:
    encoded = chunk.words()
    words, texts = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary
    hashes = mixed(chunk.hashes() ^ seeds[codes])
    phrases, place, ids, before = hashes, _classes(seeds)[codes], codes, None
    for size in range(1, longest + 1):
        phrases = lengthened(phrases, hashes, size) if size > 1 else phrases
        of_candidate = known.has(_keys(phrases, place))
        if before is not None:
            of_candidate &= chunk.whole(size) & before[:-1] & before[1:]
        at = np.flatnonzero(of_candidate)
        # A phrase is numbered by the number of its beginning and its last word.
        exact = ids[at] * len(texts) + words[at + size - 1]
        _, first, number, count = np.unique(exact, return_index=True, return_inverse=True, return_counts=True)
        ids = np.zeros(len(phrases), np.int64)
        ids[at], first = number, at[first]
        parts = [texts.take(pa.array(words[first + k])) for k in range(size)]
        joined = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
        yield pa.RecordBatch.from_arrays(
            [
                names.take(pa.array(codes[first])),
                joined.cast(pa.binary()),
                pa.array(np.full(len(first), size, np.int32)),
                pa.array(count, pa.int64()),
            ],
            ["lang", "phrase", "size", "n"],
        )
        before = of_candidate
        if not len(at):
            return


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words that come ``support`` times in a language, and the languages' word counts.

    The first table has lang, phrase, size (words) and a (how often), the
    second lang and n. ``shards`` should be a few times less than ``support``.
    """
    if not 0 < shards <= MOST_SHARDS:
        raise ValueError(f"{shards} shards; there can be 1 to {MOST_SHARDS}")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.concat(text, F.lit("\n")).alias("text"),
        F.coalesce(F.col("lang"), F.lit(UNKNOWN)).alias("lang"),
        F.pmod(F.xxhash64(text), F.lit(shards)).cast("long").alias("shard"),
    )
    totals = saved(word_totals(rows))
    sizes = totals.groupBy("lang").agg(F.sum("n").alias("n"))
    least = _least_counts(totals, sizes, support)
    union, known = None, None
    for size in range(1, longest + 1):
        frequent, possible = _possible(local_counts(rows, size, known), least, support)
        union = possible if union is None else union.union(possible)
        known = key_filter(frequent) if size < longest else None
    candidates = key_filter(union)
    counted = candidate_counts(rows, candidates, longest).where(F.col("a") >= support)
    return saved(counted.withColumn("phrase", F.col("phrase").cast("string"))), sizes


def _possible(counts: DataFrame, least: DataFrame, support: int) -> tuple[DataFrame, DataFrame]:
    """The locally frequent keys that may be frequent overall, by shard, and without their shards.

    Where a phrase is not locally frequent it comes less often than the local support. With what
    is counted this bounds how often it comes in all; one that can't reach ``support`` goes.
    """
    place, everywhere = F.shiftright("key", HASH_BITS), F.col("key").bitwiseAND(F.lit((1 << (HASH_BITS + CLASS_BITS)) - 1))
    own = counts.withColumn("place", place).join(F.broadcast(least), "place").where("n >= least")
    frequent = saved(own.select("key", everywhere.alias("anywhere"), (F.col("n") - F.col("least") + 1).alias("above")))
    by_class = F.col("place").bitwiseAND(F.lit((1 << CLASS_BITS) - 1))
    rest = least.groupBy(by_class.alias("class")).agg(F.sum(F.col("least") - 1).alias("rest"))
    found = frequent.groupBy("anywhere").agg(F.sum("above").alias("above")).withColumn("class", F.shiftright("anywhere", HASH_BITS))
    possible = saved(found.join(F.broadcast(rest), "class").where(F.col("above") + F.col("rest") >= support).select(F.col("anywhere").alias("key")))
    kept = frequent.join(possible.select(F.col("key").alias("anywhere")), "anywhere", "left_semi").select("key")
    return saved(kept), possible


def _least_counts(totals: DataFrame, sizes: DataFrame, support: int) -> DataFrame:
    """The local support in each shard and class of languages, the least of its languages: a row for each
    of at most ``MOST_SHARDS`` shards and 256 classes."""
    all_words = sizes.select(F.col("lang").alias("_lang"), F.col("n").cast("decimal(20,0)").alias("_all"))
    # support * n / all, rounded up, in whole numbers.
    share = F.lit(support).cast("decimal(10,0)") * F.col("n").cast("decimal(20,0)") + F.col("_all") - 1
    local = totals.join(all_words, F.col("lang") == F.col("_lang"))
    place = F.shiftleft("shard", CLASS_BITS) + F.col("class")
    return local.groupBy(place.alias("place")).agg(F.min(F.floor(share / F.col("_all"))).cast("long").alias("least"))


def _joined(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def cohesion(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(2,000,000 * a / (l + r)), though the product may pass 64 bits."""
    wide = "cast({} as decimal(19,0))".format
    return F.expr(f"cast({SCALE} as decimal(7,0)) * {wide(a)} div ({wide(l)} + {wide(r)})")


def collocations(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, most: int = MOST_PHRASES, shards: int = SHARDS
) -> DataFrame:
    """The phrases of 2 to ``longest`` words of each language that hold together best.

    ``docs`` has text and lang. A-Z count as a-z; a text is cut at ``.,;:!?``
    and line ends into pieces, these at spaces and tabs into words, and no phrase goes over
    the end of a piece. Returns lang, rank (from 1), phrase, a (how often it
    comes), l and r (how often its two parts come, at the cut where they fit worst),
    n (words of the language) and score, floor(2,000,000 * a / (l + r)), highest first.
    A phrase inside a longer one that comes at least 0.8 times as often is left out.

    A null text is empty, a null language is "und". Repeated rows count as often
    as they come. Ties go by a, then by the phrase's bytes. A language without frequent phrases,
    and so an empty table, gives no rows. Other columns are ignored.
    """
    frequent, sizes = frequent_phrases(docs, support, longest, shards)
    words = F.split("phrase", " ")
    candidates = frequent.where("size > 1")
    cut = candidates.select("lang", "phrase", "a", "size", words.alias("_words"), F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cut = cut.select(
        "lang", "phrase", "a", "k",
        _joined(F.col("_words"), F.lit(1), F.col("k")).alias("_first"),
        _joined(F.col("_words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("_rest"),
    )
    part = lambda name, count: frequent.select(F.col("lang"), F.col("phrase").alias(name), F.col("a").alias(count))
    scored = cut.join(part("_first", "l"), ["lang", "_first"]).join(part("_rest", "r"), ["lang", "_rest"])
    scored = scored.withColumn("score", cohesion("a", "l", "r")).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
    inner = (
        frequent.where("size > 2")
        .select("lang", F.col("a").alias("_longer"), "size", words.alias("_words"))
        .select("lang", "_longer", "_words", "size", F.explode(F.expr("sequence(2, size - 1)")).alias("_n"))
        .select("lang", "_longer", "_words", "_n", F.explode(F.expr("sequence(1, size - _n + 1)")).alias("_at"))
        .select("lang", "_longer", _joined(F.col("_words"), F.col("_at"), F.col("_n")).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("_longer").alias("_longer"))
    )
    contained = F.col("_longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * CONTAINED_PERCENT
    left = scored.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(contained, F.lit(False)))
    left = left.select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score", F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS)).alias("_group"))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # First within groups of a language, so that no task ranks a whole language.
    near = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_group").orderBy(*best))).where(F.col("rank") <= most)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return ranked.where(F.col("rank") <= most).join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

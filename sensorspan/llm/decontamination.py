"""Find benchmark items inside documents, up to a few edits.

Pigeonhole edit matching: with an error budget of k, an item is cut into k + 1
pieces; an occurrence with at most k edits contains at least one piece
unchanged. An automaton finds all pieces of all items in one pass over a text,
and the text around each piece hit is verified with Myers' bit-parallel edit
distance. Every occurrence within the budget is found, none beyond it is reported.

Items are a stated query set. They are searched in blocks of bounded size, each
block a pass over the documents, and nothing of the documents is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Edits allowed for each character of an item.
ERROR_RATE = 0.08
# Items with fewer characters than this, normalised, are found only as they are, as whole words.
LEAST_CHARS = 32
# Characters of the items in one block, about.
BLOCK_CHARS = 1_000_000

NOT_WORD = re.compile(r"[\W_]+")


def normalised(text: str | None) -> str:
    """Lower-cased letters and digits, with one space for all between."""
    return NOT_WORD.sub(" ", (text or "").lower()).strip()


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """The item cut into budget + 1 pieces of nearly equal length, with their offsets."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def positions(pattern: str) -> dict[str, int]:
    """For each character the bits at which the pattern has it."""
    found: dict[str, int] = {}
    for i, c in enumerate(pattern):
        found[c] = found.get(c, 0) | 1 << i
    return found


def myers(pattern: dict[str, int], length: int, text: str, anchored: bool = False) -> list[int]:
    """Edit distances of the pattern to the best substring of ``text`` that ends after each character.

    Anchored, the substring starts where the text does.
    """
    full, top = (1 << length) - 1, 1 << (length - 1)
    up, down, score = full, 0, length
    out = []
    for c in text:
        equal = pattern.get(c, 0)
        vertical = equal | down
        diagonal = (((equal & up) + up) ^ up) | equal
        plus = down | ~(diagonal | up)
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        out.append(score)
        plus = plus << 1 | anchored
        minus <<= 1
        up = (minus | ~(vertical | plus)) & full
        down = plus & vertical & full
    return out


class Matcher:
    """All items of a block, ready to search texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE):
        self.items: dict[str, list[int]] = {}
        for item_id, text in items:
            self.items.setdefault(text, []).append(item_id)
        self.budget = {text: int(len(text) * rate) if len(text) >= LEAST_CHARS else 0 for text in self.items}
        self.masks = {text: positions(text) for text in self.items}
        self.backward = {text: positions(text[::-1]) for text in self.items}
        found: dict[str, list[tuple[str, int]]] = {}
        for text in self.items:
            for offset, piece in pieces(text, self.budget[text]):
                found.setdefault(piece, []).append((text, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        if found:
            self.automaton.make_automaton()

    def best(self, text: str) -> dict[str, tuple[int, int, int]]:
        """For each item in ``text``: its least distance and the first such passage's start and end."""
        found: dict[str, tuple[int, int, int]] = {}
        if not self.items:
            return found
        windows: dict[str, list[tuple[int, int]]] = {}
        done: dict[str, int] = {}
        for last, (length, where) in self.automaton.iter(text):
            first = last + 1 - length
            for item, offset in where:
                start = first - offset
                if item in found or done.get(item) == start:
                    continue  # found as it is, or the piece before it led to the same place
                done[item] = start
                if start >= 0 and text.startswith(item, start) and self._whole(item, text, start):
                    found[item] = (0, start, start + len(item))
                elif k := self.budget[item]:
                    # Windows come in order of a character that each holds, so only the last ones can meet a new one.
                    low, high = max(0, start - k), start + len(item) + k
                    own = windows.setdefault(item, [])
                    while own and own[-1][1] >= low:
                        before = own.pop()
                        low, high = min(low, before[0]), max(high, before[1])
                    own.append((low, high))
        for item, own in windows.items():
            if item not in found:
                passages = [p for low, high in own if (p := self._verified(item, text, low, high))]
                if passages:
                    found[item] = min(passages)
        return found

    @staticmethod
    def _whole(item: str, text: str, start: int) -> bool:
        """Whether a short item stands there as whole words."""
        end = start + len(item)
        return len(item) >= LEAST_CHARS or (start == 0 or text[start - 1] == " ") and text[end : end + 1] in ("", " ")

    def _verified(self, item: str, text: str, low: int, high: int) -> tuple[int, int, int] | None:
        """The nearest passage in a window, which may be as long as the text and is gone through once."""
        k = self.budget[item]
        window = text[low:high]
        scores = myers(self.masks[item], len(item), window)
        distance = min(scores, default=k + 1)
        if distance > k:
            return None
        end = scores.index(distance) + 1
        back = myers(self.backward[item], len(item), window[max(0, end - len(item) - k) : end][::-1], anchored=True)
        return distance, low + end - (back.index(distance) + 1), low + end


def contaminations(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """Where rows of ``docs`` (doc_id, text) hold items of ``benchmark`` (item_id, text).

    Returns doc_id, item_id, distance (edits), budget (edits allowed), start, end
    (characters in the normalised text) and passage, one row for each row of ``docs`` and item found in
    it: the nearest passage, of equally near ones the first. Both sides are compared
    as lower-case letters and digits with single spaces. Items of fewer than ``LEAST_CHARS`` characters are
    found only unedited, as whole words. Null items and those without letters and
    digits match nothing, null and empty texts hold nothing. Equal
    items are found as often as they are listed, repeated documents as often as they are. No
    rows on a side give no rows. Other columns are ignored; texts are read whole.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    parts = [_search(rows, block, rate) for block in item_blocks(items)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items (item_id, text), normalised, in blocks of about ``BLOCK_CHARS`` characters; at least one block."""
    items = items.where("text is not null")
    chars = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // BLOCK_CHARS))
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block) if blocks > 1 else items
        texts = [(r["item_id"], normalised(r["text"])) for r in own.select("item_id", "text").collect()]
        yield [(i, t) for i, t in texts if t]


def without_items(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """Rows of ``docs`` (text and any others) that hold no item of ``benchmark``, as they are."""

    def free_of(items: list[tuple[int, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items, rate)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text"))
                yield batch.filter(pa.array([not matcher.best(normalised(t.as_py())) for t in texts], pa.bool_()))

        return run

    for block in item_blocks(benchmark):
        docs = docs.mapInArrow(free_of(block), docs.schema)
    return docs


def _search(rows: DataFrame, items: list[tuple[int, str]], rate: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, rate)
        for batch in batches:
            out: dict[str, list] = {c: [] for c in _FOUND.names}
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                plain = normalised(text.as_py())
                for item, (distance, start, end) in matcher.best(plain).items():
                    for item_id in matcher.items[item]:
                        values = (doc_id.as_py(), item_id, distance, matcher.budget[item], start, end, plain[start:end])
                        for c, v in zip(out, values):
                            out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=_FOUND)

    return rows.mapInArrow(run, "doc_id long, item_id long, distance int, budget int, start int, end int, passage string")


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("budget", pa.int32()),
        ("start", pa.int32()), ("end", pa.int32()), ("passage", pa.string()),
    ]
)

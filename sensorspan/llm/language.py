"""Language of a text by sparse multinomial logistic regression.

Features are hashed character n-grams of the letters, weighed by TF-IDF and
scaled to length one. The model is trained by follow-the-regularised-leader
(FTRL-proximal) with an elastic net, which leaves most weights zero, and its scores
are calibrated by one temperature on labelled rows it was not trained on.

Whether a text is in a learnt language at all is told apart from which one it is: by
its surprise, how rare its n-grams are among all labelled rows of its language. The
limit lies a third of the way from the median of all these rows, each left out of the counts, to
what arbitrary n-grams give, so some wrong labels do not move it.

Document frequencies count all rows to learn from. The weights are fitted on a
bounded sample of them: of each language about ``PER_LANGUAGE`` rows, drawn by hash.
Every text is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drawn, remainder, saved

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
ORDERS = (1, 2, 3)
FOLDS = 5
PER_LANGUAGE = 600
CALIBRATE_EVERY = 5
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-3
# Of held-back rows, this share may score worse than what the least score is set by.
TAIL = 0.01
# How far from the median of its rows to arbitrary n-grams a text of a language may be. The rows of sf0.01 reach 0.14
# of the way; the foreign texts that were tried start at 0.4.
STRANGE = 1 / 3
# By how many low bits of a number its cells are told apart, from wide cells to single numbers.
CELLS = (48, 36, 24, 12, 0)
UNKNOWN = "und"
CHUNK = 1 << 20
# Odd 32-bit multipliers, one for each place in an n-gram.
MIXERS = (2654435761, 2246822519, 3266489917)


@cache
def _letters() -> np.ndarray:
    """Which code points are letters, for all of them."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of a text's letters, lower-cased; None without letters.

    Runs of anything else count as one space, so that n-grams see where words
    start and end. N-grams of spaces only don't count.
    """
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _letters()[points]
    if not letters.any():
        return None
    points = np.where(letters, points, 32)
    keep = letters.copy()
    keep[1:] |= letters[:-1]  # a space after each run of letters
    points = np.concatenate([[32], points[keep], [32]]).astype(np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(points), CHUNK):  # a very long text in pieces that overlap by what an n-gram spans
        piece = points[start : start + CHUNK + max(ORDERS) - 1]
        hashed = []
        for order in ORDERS:
            own = min(CHUNK, len(piece) - order + 1)
            if own <= 0:
                continue
            mixed = piece[:own] * np.uint32(MIXERS[0]) + np.uint32(order)
            for i in range(1, order):
                mixed ^= mixed >> np.uint32(15)
                mixed += piece[i : i + own]
                mixed *= np.uint32(MIXERS[i])
            if order == 1:
                mixed = mixed[piece[:own] != 32]
            hashed.append(mixed >> np.uint32(32 - BUCKET_BITS))
        counts += np.bincount(np.concatenate(hashed), minlength=BUCKETS)
    return counts


def features(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and TF-IDF weights of a text, of length one; counts enter by their logarithm."""
    index = np.flatnonzero(counts)
    values = (1.0 + np.log(counts[index])) * idf[index]
    norm = np.sqrt(values @ values)
    return index, values / norm if norm else values


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # a row for each bucket and one for the constant
    temperature: float = 1.0
    least: float = 0.0  # the score between chance and the worst of the rows that the model was calibrated on

    def scores(self, counts: np.ndarray) -> np.ndarray:
        index, values = features(counts, self.idf)
        return values @ self.weights[index] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = gram_counts(text)
        if counts is None or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.scores(counts) / self.temperature)
        best = int(p.argmax())  # of equal scores the first language
        return self.languages[best], float(p[best])


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max())
    return e / e.sum()


def train_ftrl(samples: list[tuple[np.ndarray, np.ndarray]], labels: list[int], classes: int) -> np.ndarray:
    """FTRL-proximal over the samples (buckets, weights), in a fixed shuffled order, ``EPOCHS`` times."""
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros((BUCKETS + 1, classes))
    order = np.random.default_rng(0)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        small = np.abs(z) <= L1
        return np.where(small, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for i in order.permutation(len(samples)):
            index = np.append(samples[i][0], BUCKETS)
            values = np.append(samples[i][1], 1.0)
            w = weights(z[index], n[index])
            error = softmax(values @ w)
            error[labels[i]] -= 1.0
            gradient = np.outer(values, error)
            more = np.sqrt(n[index] + gradient**2)
            z[index] += gradient - (more - np.sqrt(n[index])) / ALPHA * w
            n[index] += gradient**2
    return weights(z, n)


def calibrated(scores: list[np.ndarray], labels: list[int]) -> float:
    """The temperature under which held-back labels are likeliest, by golden section over its logarithm."""
    if not scores:
        return 1.0
    held, own = np.array(scores), np.array(labels)

    def loss(log_t: float) -> float:
        s = held / np.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(own)), own]).mean())

    low, high, ratio = np.log(0.25), np.log(20.0), (np.sqrt(5.0) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all texts (text) each bucket occurs, and how many have letters.

    Each task sends one count for each bucket, the driver gets ``BUCKETS`` numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, documents = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                if (counts := gram_counts(text.as_py())) is not None:
                    found += counts > 0
                    documents += 1
        index = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(index, -1)), pa.array(np.append(found[index], documents))], ["bucket", "n"]
        )

    rows = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    frequency = np.zeros(BUCKETS, np.int64)
    documents = 0
    for bucket, n in rows:
        if bucket < 0:
            documents = n
        else:
            frequency[bucket] = n
    return frequency, documents


def train(labelled: DataFrame, counted: tuple[np.ndarray, int] | None = None) -> Model:
    """Fit a model on rows (text, lang); null languages and texts without letters teach nothing.

    ``counted`` is what ``document_frequencies`` of these rows gives, if that is known.
    """
    rows = labelled.where("lang is not null and text is not null").select("text", "lang")
    frequency, documents = counted or document_frequencies(rows.select("text"))
    idf = np.log((1.0 + documents) / (1.0 + frequency)) + 1.0
    placed = rows.withColumn("_row", F.monotonically_increasing_id())
    # One row for each language; the model below holds a column of weights for each in memory anyway.
    share = placed.groupBy(F.col("lang").alias("_lang")).agg((F.lit(float(PER_LANGUAGE)) / F.count("*")).alias("_share"))
    sample = placed.join(F.broadcast(share), F.col("lang") == F.col("_lang")).where(drawn(F.col("_row"), F.col("_share")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, lang, row in zip(*(batch.column(c) for c in ("text", "lang", "_row"))):
                if (counts := gram_counts(text.as_py())) is not None:
                    index, values = features(counts, idf)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang.as_py()]),
                            pa.array([row.as_py()], pa.int64()),
                            pa.array([index.astype(np.int32)], pa.list_(pa.int32())),
                            pa.array([values.astype(np.float32)], pa.list_(pa.float32())),
                        ],
                        ["lang", "row", "index", "weights"],
                    )

    found = sample.mapInArrow(run, "lang string, row long, index array<int>, weights array<float>").toArrow()
    taken = sorted(zip(*(found.column(c).to_pylist() for c in ("lang", "row")), range(found.num_rows)))
    vectors = [
        (np.asarray(found["index"][i].values), np.asarray(found["weights"][i].values, np.float64)) for _, _, i in taken
    ]
    languages = sorted({lang for lang, _, _ in taken})
    own = [languages.index(lang) for lang, _, _ in taken]
    back = [i % CALIBRATE_EVERY == CALIBRATE_EVERY - 1 for i in range(len(taken))]
    learn = [i for i, b in enumerate(back) if not b]
    if not languages:
        return Model([], idf, np.zeros((BUCKETS + 1, 0)))
    weights = train_ftrl([vectors[i] for i in learn], [own[i] for i in learn], len(languages))
    held = [i for i, b in enumerate(back) if b]
    scores = [vectors[i][1] @ weights[vectors[i][0]] + weights[-1] for i in held]
    temperature = calibrated(scores, [own[i] for i in held])
    return Model(languages, idf, weights.astype(np.float32), temperature, least_score(scores, [own[i] for i in held], temperature))


def least_score(scores: list[np.ndarray], labels: list[int], temperature: float) -> float:
    """Halfway from chance to the score that all but ``TAIL`` of the held-back rows reach for their own language."""
    found = [float(p.max()) for p, own in zip((softmax(s / temperature) for s in scores), labels) if p.argmax() == own]
    if not found:
        return 0.0
    chance = 1 / len(scores[0])
    return (chance + max(chance, float(np.quantile(found, TAIL)))) / 2


def predict_languages(texts: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, text) as doc_id, lang_pred, score; `und` and 0 for texts without a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [model.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([x[0] for x in said], pa.string()),
                    pa.array([x[1] for x in said], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


@dataclass
class Familiar:
    """How often the n-grams of each language occur in its labelled rows, and how rare those of a text may be."""

    frequency: dict[str, np.ndarray]
    rows: dict[str, int]
    limit: dict[str, float]

    def surprise(self, counts: np.ndarray, lang: str, counted: bool) -> float:
        """The mean over a text's n-grams of minus the logarithm of the share of rows that have it; without itself if counted."""
        index = np.flatnonzero(counts)
        share = (self.frequency[lang][index] - counted + 0.5) / (self.rows[lang] - counted + 1.0)
        return float(-(counts[index] @ np.log(share)) / counts[index].sum())

    def documents(self) -> tuple[np.ndarray, int]:
        """In how many rows of all languages each n-gram occurs, and how many rows there are."""
        return sum(self.frequency.values(), np.zeros(BUCKETS, np.int64)), sum(self.rows.values())

    def strange(self, lang: str) -> float:
        """The surprise of a text whose n-grams fall into all buckets alike."""
        return float(-np.log((self.frequency[lang] + 0.5) / (self.rows[lang] + 1.0)).mean())


def middles(found: DataFrame, rows: dict[str, int]) -> dict[str, float]:
    """The median of the positive numbers of each language, of which ``found`` (lang, bits) has the bits and ``rows`` the count.

    Positive doubles are in the order of their bits. The cells of the two middle numbers are cut into
    narrower ones by counts, a few thousand for each language at a time; no numbers are gathered or sorted.
    """
    sought = {(lang, rank): (0, rank) for lang, n in rows.items() for rank in {(n - 1) // 2, n // 2}}  # cell, rank inside it
    above = 63
    for below in CELLS if sought else ():
        wanted: dict[str, set[int]] = {}
        for (lang, _), (cell, _) in sought.items():
            wanted.setdefault(lang, set()).add(cell)
        inside = F.lit(False)
        for lang, cells in wanted.items():
            inside = F.when(F.col("lang") == lang, F.shiftright("bits", above).isin(sorted(cells))).otherwise(inside)
        counts = found.where(inside).groupBy("lang", F.shiftright("bits", below).alias("cell")).agg(F.count("*").alias("n")).toArrow()
        sizes: dict[tuple[str, int], list[tuple[int, int]]] = {}
        for lang, cell, n in sorted(zip(*(counts.column(c).to_pylist() for c in ("lang", "cell", "n")))):
            sizes.setdefault((lang, cell >> (above - below)), []).append((cell, n))
        for (lang, rank), (outer, left) in sought.items():
            for cell, n in sizes[lang, outer]:
                if left < n:
                    break
                left -= n
            sought[lang, rank] = cell, left
        above = below
    ends: dict[str, list[float]] = {}
    for (lang, _), (cell, _) in sought.items():
        ends.setdefault(lang, []).append(float(np.int64(cell).view(np.float64)))
    return {lang: sum(pair) / len(pair) for lang, pair in ends.items()}


def familiar(labelled: DataFrame) -> Familiar:
    """Counts and limits from all rows (text, lang) with letters and a language."""
    rows = labelled.where("lang is not null and text is not null").select("text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang")):
                if (counts := gram_counts(text.as_py())) is not None:
                    held = found.setdefault(lang.as_py(), np.zeros(BUCKETS + 1, np.int64))
                    held[:-1] += counts > 0
                    held[-1] += 1
        for lang, held in found.items():
            index = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(index)), pa.array(index), pa.array(held[index])], ["lang", "bucket", "n"])

    totals = rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    held: dict[str, np.ndarray] = {}
    for lang, bucket, n in zip(*(totals.column(c).to_pylist() for c in ("lang", "bucket", "n"))):
        held.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))[bucket] = n
    known = Familiar({k: v[:-1] for k, v in held.items()}, {k: int(v[-1]) for k, v in held.items()}, {})

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs: list[str] = []
            said: list[float] = []
            for text, lang in zip(batch.column("text"), batch.column("lang")):  # one text's counts at a time
                if (counts := gram_counts(text.as_py())) is not None:
                    langs.append(lang.as_py())
                    said.append(known.surprise(counts, langs[-1], True))
            bits = np.array(said, np.float64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(bits)], ["lang", "bits"])

    middle = middles(saved(rows.mapInArrow(measured, "lang string, bits long")), known.rows)
    known.limit = {lang: m + (known.strange(lang) - m) * STRANGE for lang, m in middle.items()}
    return known


def keep_certain(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """Rows of ``docs`` (text, lang and any others) that are surely in one of the labelled languages.

    The labelled rows teach the model. Rejected are texts without a letter, null
    ones too, texts that score under ``least`` or hardly better than by chance among the learnt
    languages, and texts whose n-grams are rare in the language they score best
    for: those in other languages and junk. A row's own label does not vouch for it. Without any labelled
    row nothing can be told apart and only texts without a letter go. Columns
    and repeated rows stay as they are.
    """
    labelled = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = familiar(labelled)
    model = train(labelled, known.documents())
    wanted = max(least, model.least)

    def certain(text: str | None, lang: str | None) -> bool:
        counts = gram_counts(text)
        if counts is None or not model.languages:
            return counts is not None
        said, score = model.predict(text)
        if score < wanted:
            return False
        return known.surprise(counts, said, said == lang) <= known.limit[said]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(batch.schema.get_field_index(c)) for c in ("text", "lang"))
            kept = [certain(text.as_py(), lang.as_py()) for text, lang in zip(*columns)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def identify_languages(docs: DataFrame) -> DataFrame:
    """The language of every row of ``docs`` (doc_id, text, lang).

    Returns doc_id, held_out (crc32 of the id as text is divisible by ``FOLDS``; those
    rows teach nothing), lang_pred, score. A null text and one without letters is `und` with score 0. Without
    any labelled row all are `und`. Rows with a null language are
    predicted but teach nothing. Repeated rows are rows of their own; a
    null id counts as an empty text for the fold. No rows give no rows. Other
    columns are ignored; lang, source and doc_id are no input of a prediction.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = train(rows.where(remainder(F.col("doc_id"), FOLDS) != 0))
    found = predict_languages(rows, model)
    return found.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "lang_pred", "score")

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sensorspan.llm import phrases


def brute(rows, support=30, longest=4, most=2000):
    """All phrases counted in dictionaries; every rule as it is worded."""
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = [p for p, a in f.items() if len(p) > 1 and a >= support]
        kept = []
        for p in found:
            a = f[p]
            longer = [q for q in found if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * f[q] >= 80 * a for q in longer):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def corpus(seed, n=60):
    draw = random.Random(seed)
    words = ["the", "of", "New", "york", "Él", "ß", "new york", "a-b", *"pqrstuvw"]
    seams = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n", "\x0b", ";", ":", "! ", "?", "\x0c"]
    rows = [(i, "".join(w + draw.choice(seams) for w in draw.choices(words, range(1, len(words) + 1), k=draw.randint(0, 60))), draw.choice(["en", "de", None, "und"])) for i in range(n)]
    rows += [(n + i, "one two three four five. Two three Four five", "en") for i in range(9)]
    return rows + [(900, None, "en"), (901, "", None), (902, " \t\n", "xx"), (903, "word " * 3000, "fr"), (None, "one two three four", "en")]


def result(frame, **settings):
    return sorted(map(tuple, phrases.collocations(frame, **settings).collect()))


@pytest.mark.parametrize("support, shards, longest", [(2, 1, 4), (3, 2, 4), (5, 3, 3), (30, 10, 4), (1, 4, 2)])
def test_equal_to_brute_force(documents, support, shards, longest):
    rows = corpus(support)
    frame = documents([(*r, "s") for r in rows]).repartition(5)
    expected = brute(rows, support, longest)
    assert result(frame, support=support, shards=shards, longest=longest) == expected
    assert len(expected) > 0 or support == 30


def test_a_row_with_a_third_of_all_and_copies(documents):
    rows = corpus(7, 20) + [(2000 + i, "all these texts are equal, all these texts are equal", "de") for i in range(400)]
    assert result(documents([(*r, "s") for r in rows]), support=30) == brute(rows, 30)


def test_only_the_best_are_returned(documents):
    rows = corpus(8)
    got = result(documents([(*r, "s") for r in rows]), support=2, most=5, shards=1)
    assert got == brute(rows, 2, most=5) and max(r[1] for r in got) == 5


def test_no_rows(documents):
    assert result(documents([])) == []
    assert result(documents([(1, None, None, None)])) == []


def test_scores_past_64_bits(spark):
    rows = [(10**13, 10**13, 3 * 10**13), (9 * 10**18, 9 * 10**18, 9 * 10**18), (1, 3, 4)]
    frame = spark.createDataFrame(rows, "a long, l long, r long")
    got = [r[0] for r in frame.select(phrases.cohesion("a", "l", "r")).collect()]
    assert got == [2_000_000 * a // (left + right) for a, left, right in rows]


def test_the_filter_lacks_no_key(spark):
    draw = random.Random(3)
    keys = [draw.randrange(1 << 63) for _ in range(5000)]
    known = phrases.key_filter(spark.createDataFrame([(k,) for k in keys], "key long")).value
    assert known.has(np.array(keys, np.uint64)).all()
    assert known.has(np.array([draw.randrange(1 << 63) for _ in range(5000)], np.uint64)).mean() < 0.05


def test_a_task_hands_counts_on_when_it_holds_many(monkeypatch):
    monkeypatch.setattr(phrases, "HELD", 100)
    draw, tally, got, keys = random.Random(1), phrases.Tally(), Counter(), []
    for _ in range(40):
        part = [draw.randrange(90) if draw.random() < 0.5 else draw.randrange(1 << 40) for _ in range(30)]
        keys += part
        for batch in [*tally.add(np.array(part, np.uint64))]:
            got.update(dict(zip(*(c.to_pylist() for c in batch.columns))))
    for batch in tally.rest():
        got.update(dict(zip(*(c.to_pylist() for c in batch.columns))))
    assert got == Counter(keys) and [*tally.rest()] == []


@pytest.mark.parametrize("size", [1, 7, 50, 1 << 20])
def test_chunks_are_cut_between_pieces(monkeypatch, size):
    """The words are the same wherever the text is cut, in slices of batches too."""
    monkeypatch.setattr(phrases, "CHUNK", size)
    monkeypatch.setattr(phrases, "HASHED", max(size // 2, 1))
    texts = [(r[1] or "") + "\n" for r in corpus(4)]
    batch = pa.record_batch([pa.array(texts)], names=["text"]).slice(2)
    found = Counter()
    for chunk in phrases.chunks(batch):
        words = [w.as_py().decode() for w in chunk.words()]
        hashes = chunk.hashes()
        assert len(set(zip(words, hashes))) == len(set(words)) == len(set(hashes))
        found.update(zip(chunk.row.tolist(), words))
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in texts[2:]]
    assert found == Counter((i, w) for i, t in enumerate(lower) for w in re.findall(r"[^\x20\x09-\x0d.,;:!?]+", t))


def test_rows_laid_out_otherwise_give_the_same(documents):
    frame = documents([(*r, "s") for r in corpus(11)])
    one, other = (result(f, support=3, shards=2) for f in (frame.coalesce(1), frame.repartition(7, F.col("text"))))
    assert one == other

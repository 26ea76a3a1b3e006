from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sensorspan.llm import mixing, sharding
from sensorspan.llm.common import table

from .conftest import SF


def brute_capacity(sizes, shards):
    """The least capacity for contiguous shards, by trying every capacity that matters."""
    best = [[math.inf] * (shards + 1) for _ in range(len(sizes) + 1)]
    best[0][0] = 0
    for i in range(1, len(sizes) + 1):
        for k in range(1, shards + 1):
            total = 0
            for j in range(i - 1, -1, -1):
                total += sizes[j]
                best[i][k] = min(best[i][k], max(best[j][k - 1], total))
    return min(best[len(sizes)][1:])


@pytest.mark.parametrize("seed", range(8))
def test_capacity_is_the_smallest(seed):
    draw = random.Random(seed)
    sizes = [draw.randint(1, 60) for _ in range(draw.randint(1, 40))]
    shards = draw.randint(1, 9)
    found = sharding.smallest_capacity(sizes, shards, 0)
    assert found == brute_capacity(sizes, shards)
    assert len(sharding.walk(sizes, found)) <= shards


def text_key(text):
    return "0" * 64 if text is None else hashlib.sha256(text.encode()).hexdigest()


def check_shards(rows, got, shards):
    sizes = Counter()
    for _, text, *_ in rows:
        sizes[text_key(text)] += len((text or "").encode()) + 16
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    slots, where, held = defaultdict(list), {}, Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        held[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(0 <= s < shards for s in slots)
    for (i, text, *_), _ in zip(rows, rows):
        own = {r["shard"] for r in got if r["doc_id"] == i and r["text_crc32"] == zlib.crc32((text or "").encode())}
        where.setdefault(text_key(text), set()).update(own)
    # Groups above the even share stand alone, the others are cut where the least capacity cuts them.
    left, total, alone = shards, sum(sizes.values()), []
    for key in sorted(sizes, key=lambda k: (-sizes[k], k)):
        if left < 2 or sizes[key] * left <= total:
            break
        alone.append(key)
        total -= sizes[key]
        left -= 1
    rest = [sizes[k] for k in sorted(sizes) if k not in alone]
    if rest:
        assert max(z for s, z in held.items() if s >= len(alone)) == sharding.smallest_capacity(rest, left, 0)
    return where


def test_shards_of_odd_rows(documents):
    draw = random.Random(4)
    rows = [(i, draw.choice("abcdefgh") * draw.randint(0, 300), "en", "s") for i in range(200)]
    rows += [(1000 + i, "copy " * 20, "en", "s") for i in range(150)]
    rows += [(None, None, None, None), (5000, None, None, None), (5001, "", None, None), rows[3], (None, "é" * 70_000, "en", "s")]
    got = sharding.shard_documents(documents(rows), 7).collect()
    check_shards(rows, got, 7)
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    copies = {r["shard"] for r in got if r["doc_id"] is not None and 1000 <= r["doc_id"] < 1150}
    assert len(copies) == 1


def test_shards_of_the_given_documents(spark):
    docs = table(spark, SF, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    check_shards(rows, sharding.shard_documents(docs, 40).collect(), 40)


def test_no_and_few_rows(documents):
    assert sharding.shard_documents(documents([]), 40).collect() == []
    assert [r["slot"] for r in sharding.shard_documents(documents([(1, "a", "en", "s")]), 40).collect()] == [0]
    assert {r["shard"] for r in sharding.shard_documents(documents([(1, "a", "", ""), (2, "b", "", "")]), 1).collect()} == {0}


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Reshare what is above the limits by weight, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(order), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if per * weight[s] > most * sizes[s]}
        if not above:
            target |= {s: per * weight[s] for s in open_}
            break
        for s in above:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= above
    return target


def brute_mix(rows):
    """Targets, rates and copies row by row."""
    size = lambda t: len((t or "").translate({c: " " for c in range(9, 14)}).split(" ")) - (t or "").translate({c: " " for c in range(9, 14)}).split(" ").count("")
    total = Counter()
    for _, text, _, source in rows:
        total[source] += size(text)
    target = brute_targets(dict(total))
    return {s: (total[s], target[s]) for s in total}, [size(t) for _, t, _, _ in rows]


def check_mix(rows, got):
    sources, sizes = brute_mix(rows)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((i, s, z) for (i, _, _, s), z in zip(rows, sizes))
    for source, (total, target) in sources.items():
        own = [r for r in got if r["source"] == source]
        assert {r["source_size"] for r in own} == {total}
        assert all(r["target"] == pytest.approx(target, rel=1e-9) for r in own)
        assert all(0 <= r["copies"] <= 3 for r in own)
        taken = sum(r["copies"] * r["size"] for r in own)
        assert abs(taken - target) <= max(r["size"] for r in own) + 1e-6
        if total and target:
            assert all(r["rate"] == pytest.approx(target / total, rel=1e-6) for r in own)


def test_mix_of_odd_rows(documents):
    draw = random.Random(9)
    rows = [(i, " ".join("w" * draw.randint(1, 90)), "en", draw.choice(["a", "b", "c", "Z", "é", None])) for i in range(300)]
    rows += [(i, "same copy of words", "en", "hot") for i in range(400)]
    rows += [(None, None, None, None), (7, "", "en", "empty"), (8, "one", "en", "tiny"), rows[0], (9, "x\x0by z " * 9000, "en", "a")]
    check_mix(rows, mixing.mix(documents(rows)).collect())


def test_mix_of_the_given_documents_is_stable(spark):
    docs = table(spark, SF, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    got = mixing.mix(docs).collect()
    check_mix(rows, got)
    assert sorted(got) == sorted(mixing.mix(docs).collect())


def test_mix_does_not_depend_on_the_layout(spark, documents):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang", "source")
    rows = docs.unionByName(documents([(5, "twice the same", "en", "b")] * 9 + [(None, "no id", None, None)] * 4).select(docs.columns))
    once = sorted(map(str, mixing.mix(rows).collect()))
    for other in (rows.repartition(7), rows.orderBy(F.rand(3)), rows.coalesce(1)):
        assert sorted(map(str, mixing.mix(other).collect())) == once


def test_mix_without_rows_or_words(documents):
    assert mixing.mix(documents([])).collect() == []
    assert [r["copies"] for r in mixing.mix(documents([(1, "", "en", "a"), (2, None, "en", None)])).collect()] == [0, 0]


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(table(spark, SF, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_driver_holds_few_cells_of_skewed_groups(spark, monkeypatch):
    """Groups just under the even share of 40 shards, among many small ones."""
    monkeypatch.setattr(sharding, "FIRST_DIGITS", 3)
    draw = random.Random(11)
    sizes = {hashlib.sha256(str(i).encode()).hexdigest(): draw.randint(17, 400) for i in range(60_000)}
    small = sum(sizes.values())
    for i, share in enumerate((0.02, 0.0125, 0.006, 0.0025)):
        sizes[hashlib.sha256(f"large {i}".encode()).hexdigest()] = int(small * share)
    held, cells = [], sharding._cells
    monkeypatch.setattr(sharding, "_cells", lambda *a: held.append(cells(*a)) or held[-1])
    alone, starts = sharding.plan(spark.createDataFrame(list(sizes.items()), "key string, size long").cache(), 40)
    order = sorted(sizes)
    capacity = sharding.smallest_capacity([sizes[k] for k in order], 40, 0)
    whole = [order[i] for i in sharding.walk([sizes[k] for k in order], capacity)][1:]
    assert alone == [] and len(starts) == len(whole)
    assert [next(k for k in order if k >= s) for s in starts] == whole
    assert max(map(len, held)) < 15_000

from __future__ import annotations

import random

import numpy as np
import xxhash

from sensorspan.llm import simhash
from sensorspan.llm.components import connected_components


def brute_fingerprint(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    if not words:
        return 0
    shingles = [words] if len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, distance=3):
    """Least id of each row's component by comparing all pairs."""
    fps = [brute_fingerprint(t) for _, t in rows]
    left, found = set(range(len(rows))), {}
    while left:
        queue, own = [left.pop()], []
        while queue:
            i = queue.pop()
            own.append(i)
            near = {j for j in left if bin(fps[i] ^ fps[j]).count("1") <= distance}
            left -= near
            queue.extend(near)
        ids = [rows[i][0] for i in own if rows[i][0] is not None]
        found |= {i: min(ids, default=None) for i in own}
    return [(rows[i][0], f"{fps[i]:016x}", found[i]) for i in range(len(rows))]


def same(got, expected):
    order = lambda r: tuple((x is None, x) for x in r)
    return sorted(map(tuple, got), key=order) == sorted(expected, key=order)


def texts(seed=3):
    draw = random.Random(seed)
    words = ["Alpha", "bêta", "gamma", "DELTA", "e f", "zeta", "eta", "theta"]
    base = [" ".join(draw.choices(words, k=draw.randint(1, 400))) for _ in range(60)]
    near = []
    for text in base[:20]:
        own = text.split(" ")
        own[draw.randrange(len(own))] = "changed"
        near += [" ".join(own), text.upper().replace("BÊTA", "bêta"), text + "\n"]
    return [*base, *near, "", None, " \t\n ", "one", "one two", "ONE\x0btwo", "word " * 30_000]


def test_components_equal_all_pairs(documents):
    rows = [(i, t, "en", "s") for i, t in enumerate(texts())]
    rows += [(None, "one two", None, None), (None, "quite alone here", None, None), (5, rows[5][1], "en", "s"), rows[7]]
    got = simhash.near_duplicates(documents(rows)).collect()
    assert same(got, brute_components([r[:2] for r in rows]))


def test_empty_table(documents):
    assert simhash.near_duplicates(documents([])).collect() == []
    assert simhash.keep_one(documents([])).collect() == []


def test_keep_one_keeps_whole_rows(documents):
    rows = [(3, "a b c d", "en", "x"), (1, "A b c d", "fr", "y"), (None, "a b c d", "de", "z"), (2, "else", None, None), (2, "else", None, None)]
    rows += [(None, "no id one two", None, None), (None, "nor this, it seems", None, None)]
    kept = simhash.keep_one(documents(rows)).select("doc_id", "text", "lang").collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(
        map(str, [(1, "A b c d", "fr"), (2, "else", None), (None, "no id one two", None), (None, "nor this, it seems", None)])
    )


def test_every_close_pair_shares_a_key():
    draw = random.Random(1)
    masks = [m & (1 << 64) - 1 for m in simhash.block_masks()]
    for _ in range(500):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), 3):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_large_bucket_is_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 4)
    draw = random.Random(2)
    values = {0, *(sum(1 << b for b in draw.sample(range(64), draw.randint(0, 9))) for _ in range(120))}
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    links = {tuple(r) for r in simhash.close_links(frame).collect()}
    roots = {r["node"]: r["root"] for r in connected_components(simhash.close_links(frame)).collect()}
    for a, b in links:
        assert bin((a ^ b) & (1 << 64) - 1).count("1") <= 64
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    group = {v: v for v in signed}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(signed):
        for b in signed[:i]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3:
                x, y = find(a), find(b)
                group[max(x, y)] = min(x, y)
    assert {v: roots.get(v, v) for v in signed} == {v: find(v) for v in signed}


def test_forest_spans_what_is_close():
    members = np.array([0, 1, 3, 7, 15, 31, 63, 15 << 40, (15 << 40) | 1, (1 << 64) - 1], np.uint64)
    roots, reached = simhash.forest(members)
    assert len(roots) == len(members) - 3
    assert set(reached.tolist()).isdisjoint({0, 15 << 40, (1 << 64) - 1})


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}

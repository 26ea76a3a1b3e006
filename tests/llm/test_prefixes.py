from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sensorspan.llm import prefixes

KINDS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The trie in dictionaries, turn by turn."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0), key, (role, text)))
    own = {c: [t for *_, t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        head = c - (abs(c) % 5 if c > 0 else -(abs(c) % 5))
        turns = tuple([*own.get(head, [])[:h], *own[c][h:]])
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
        ends[turns].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1].encode()) if p else 0)
    digest = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return sorted(
        (min(m), len(p), -1 if not p else min(members[p[:-1]]), len(m), children[p], leaves[p], saved[p], digest(p))
        for p, m in members.items()
    )


def result(frame):
    got = prefixes.prefix_trie(frame).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in got.collect())


def chats(seed, convs=60, longest=9):
    draw = random.Random(seed)
    texts = ["", "a", "b", "ü", "ab", None]
    rows = [(c, t, draw.choice(["user", "assistant", None]) if t else "system", draw.choice(texts)) for c in draw.sample(range(convs * 2), convs) for t in range(draw.randint(1, longest))]
    rows += [(c, t, "user", "the same") for c in range(500, 540) for t in range(3)]  # copies
    rows += [(c, None, "system", "no number") for c in (500, 501, 7)] + [(7, 0, "user", "tie"), (7, 0, "user", "eit"), (7, 0, "user", "eit")]
    draw.shuffle(rows)
    return rows + [(None, 0, "user", "of nobody")]


def test_equal_to_brute_force(documents):
    for seed in (1, 2):
        rows = chats(seed)
        assert result(documents(rows, KINDS).repartition(6)) == brute(rows)


def test_blocks_and_shards_of_a_few(documents, monkeypatch):
    """A conversation with most rows, and nodes that many shards have."""
    monkeypatch.setattr(prefixes, "BLOCK", 4)
    rows = chats(3, 30) + [(600, t, "user", str(t % 3)) for t in range(700)] + [(601, t, "user", str(t % 3)) for t in range(699)]
    assert result(documents(rows, KINDS).repartition(3)) == brute(rows)


def test_negative_and_far_apart_ids(documents):
    big = 2**62
    rows = [(c, t, "user", str(t)) for c in (-7, -5, -3, 0, big, big - big % 5, -big) for t in range(6)]
    assert result(documents(rows, KINDS)) == brute(rows)


def test_no_rows(documents):
    assert result(documents([], KINDS)) == []
    assert result(documents([(None, 1, "user", "x")], KINDS)) == []


def test_a_shard_walks_every_node_once():
    draw = random.Random(5)
    paths = [[draw.choice("ab") for _ in range(draw.randint(0, 6))] for _ in range(300)]
    rows = [(c, d, len(p), p[d - 1] if d else None, tuple(p[: max(d - 1, 0)])) for c, p in enumerate(paths) for d in range(len(p) + 1)]
    conv, depth, length, key, parent = zip(*rows)
    shard = prefixes.Shard(np.array(conv), np.array(depth), np.array(length), list(key), list(parent))
    got = {tuple(paths[conv[row]][: depth[row]]): (least, n, ends) for row, least, n, ends in shard.nodes()}
    expected = defaultdict(list)
    for c, p in enumerate(paths):
        for d in range(len(p) + 1):
            expected[tuple(p[:d])].append(c)
    assert got == {p: (m[0], len(m), [c for c in m if len(paths[c]) == len(p)]) for p, m in expected.items()}
    assert sum(1 for _ in shard.nodes()) == len(expected)


@pytest.mark.parametrize("partitions", [1, 5])
def test_laid_out_otherwise(documents, partitions):
    rows = chats(9)
    assert result(documents(rows[::-1], KINDS).coalesce(partitions)) == result(documents(rows, KINDS))

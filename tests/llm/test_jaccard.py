from __future__ import annotations

import random

import corpus_pipeline
from sensorspan.llm import jaccard, simhash
from sensorspan.llm.common import table

from .conftest import SF

KINDS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_kept(rows, least=0.8):
    """Least id of each component by comparing all pairs."""
    sets, left, kept = {i: brute_shingles(t) for i, t in rows}, sorted(i for i, _ in rows), set()
    while left:
        queue = [left.pop(0)]
        kept.add(queue[0])
        while queue:
            own = queue.pop()
            near = [j for j in left if similarity(sets[own], sets[j]) >= least]
            left = [j for j in left if j not in near]
            queue += near
    return kept


def planted(seed=5):
    """Texts, copies of each with edits that leave 0.6 to 0.95, and chains of copies of copies."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    texts = [draw.choices(words, k=draw.randint(30, 300)) for _ in range(60)]
    for text in texts[:40]:
        for edits in (0.01, 0.02, 0.03, 0.05):
            copy = list(text)
            for at in draw.sample(range(len(copy)), max(1, int(edits * len(copy)))):
                copy[at] = draw.choice(words)
            texts.append(copy)
    chain = texts[0]
    for i in range(12):
        chain = [*chain[:-9], *draw.choices(words, k=9)] if i else draw.choices(words, k=300)
        texts.append(chain)
    return [(i, " ".join(t)) for i, t in enumerate(texts)] + [(900, " ".join(texts[3]).upper()), (901, ""), (902, None), (903, "w1 w2"), (904, "W1\tw2")]


def test_stage_drops_planted_copies_and_no_others(documents):
    rows = planted()
    frame = documents([(i, t, "en", "s", 1) for i, t in rows], KINDS)
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    got = {r["doc_id"] for r in stage(frame.sparkSession, frame, SF).collect()}
    assert got == brute_kept(rows)
    assert len(got) < len(rows) - 80


def test_stage_on_the_given_documents(spark):
    docs = table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF).collect()]
    assert sorted(got) == sorted(brute_kept(rows))


def test_tiles_give_the_same(documents, monkeypatch):
    rows = planted(6)
    monkeypatch.setattr(jaccard, "TILE", 300)
    frame = documents([(i, t, "en", "s") for i, t in rows])
    assert {r["doc_id"] for r in jaccard.keep_one(frame).collect()} == brute_kept(rows)


def test_odd_rows(documents):
    rows = [(3, "a b c d", "en", "x"), (1, "A b c d", "fr", "y"), (None, "a b c d", "de", "z"), (2, "else", None, None), (2, "else", None, None)]
    rows += [(None, "no id one two", None, None), (None, "nor this, it seems", None, None)]
    kept = jaccard.keep_one(documents(rows)).select("doc_id", "text", "lang").collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(
        map(str, [(1, "A b c d", "fr"), (2, "else", None), (None, "no id one two", None), (None, "nor this, it seems", None)])
    )
    assert jaccard.keep_one(documents([])).collect() == []


def test_close_fingerprints_are_candidates(spark):
    """Operator 1's links, without a shared key: equal fingerprints and up to three bits; the empty set has none."""
    fps = {1: 0, 2: 0b111, 3: 0b111111, 4: 0, 5: 0b1111 << 40, 6: -1, 7: -1 ^ (1 << 62)}
    nodes = spark.createDataFrame([(i, 9, fp, []) for i, fp in fps.items()] + [(0, 0, 0, [])], "node long, n long, fp long, keys array<long>")
    assert {r["node"]: r["root"] for r in jaccard.candidates(nodes).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 6: 6, 7: 6}


def test_nodes_have_the_fingerprint_of_their_set():
    found = jaccard.shingles("a b c d e f g")
    bits = [sum(int(h) >> i & 1 for h in found) * 2 > len(found) for i in range(64)]
    assert simhash.majority(found) == sum(1 << i for i, bit in enumerate(bits) if bit)

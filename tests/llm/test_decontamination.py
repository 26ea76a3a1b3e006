from __future__ import annotations

import random
import time

import pytest

from sensorspan.llm import decontamination as d
from sensorspan.llm.common import table

from .conftest import SF


def distances(pattern, text):
    """Least edit distance of the pattern to a substring ending after each character."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (a != b)))
        row = new
    return row[1:]


def edits(text, n, draw):
    own = list(text)
    for _ in range(n):
        at, how = draw.randrange(len(own)), draw.random()
        if how < 0.33:
            own[at] = draw.choice("abcxyz ")
        elif how < 0.66:
            own.insert(at, draw.choice("abcxyz"))
        else:
            del own[at]
    return "".join(own)


def prose(draw, n):
    return " ".join("".join(draw.choices(["an", "th", "er", "ou", "st"], k=draw.randint(1, 4))) for _ in range(n))


@pytest.mark.parametrize("seed", range(5))
def test_myers_equals_the_table(seed):
    draw = random.Random(seed)
    for _ in range(30):
        pattern, text = ("".join(draw.choices("ab c", k=draw.randint(1, 90))) for _ in range(2))
        assert d.myers(d.positions(pattern), len(pattern), text) == distances(pattern, text)


@pytest.mark.parametrize("seed", range(4))
def test_found_if_and_only_if_within_the_budget(seed):
    draw = random.Random(seed)
    items = [(i, d.normalised(prose(draw, draw.randint(8, 40)))) for i in range(20)]
    items = [(i, t) for i, t in items if len(t) >= d.LEAST_CHARS]
    matcher = d.Matcher(items)
    for _ in range(40):
        _, item = draw.choice(items)
        text = f"{prose(draw, 30)} {edits(item, draw.randint(0, matcher.budget[item] + 4), draw)} {prose(draw, 20)}"
        text = d.normalised(text)
        found = matcher.best(text)
        for _, each in items:
            least = min(distances(each, text))
            if least <= matcher.budget[each]:
                distance, start, end = found[each]
                assert distance == least
                assert distances(each, text)[end - 1] == least
                assert distances(each, text[start:end])[-1] == least
            else:
                assert each not in found


def test_pieces_cover_the_item():
    for n, k in ((40, 3), (33, 2), (100, 8), (7, 0)):
        item = "".join(chr(97 + i % 26) for i in range(n))
        cut = d.pieces(item, k)
        assert len(cut) == k + 1 and "".join(p for _, p in cut) == item
        assert all(item[o : o + len(p)] == p for o, p in cut)


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        plain = d.normalised(text)
        for item_id, item in items:
            own = d.normalised(item)
            if len(own) >= d.LEAST_CHARS and plain:
                least = min(distances(own, plain))
                if least <= int(len(own) * d.ERROR_RATE):
                    out.append((doc_id, item_id, least))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [100, d.BLOCK_CHARS])
def test_odd_rows(documents, spark, monkeypatch, block):
    monkeypatch.setattr(d, "BLOCK_CHARS", block)
    draw = random.Random(6)
    items = [(i, prose(draw, 15)) for i in range(6)] + [(10, None), (11, ""), (12, "short one"), (None, prose(draw, 12))]
    items.append((13, items[2][1].upper() + "!"))
    docs = [(i, prose(draw, 60)) for i in range(10)]
    docs += [(20 + i, f"{prose(draw, 9)} {edits(t, 2, draw).upper()}; {prose(draw, 9)}") for i, t in items[:6]]
    docs += [(40, None), (41, ""), (None, items[0][1]), (42, items[1][1]), (42, items[1][1]), (43, prose(draw, 9000) + items[3][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for extra in ("doc_id", "start", "passage", "lang"):
        benchmark = benchmark.withColumn(extra, benchmark["text"])
    frame = documents([(i, t, "", "") for i, t in docs])
    got = sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in d.contaminations(frame, benchmark).collect()), key=str)
    assert got == brute(docs, items)
    kept = d.without_items(frame, benchmark)
    assert kept.columns == frame.columns
    bad = {(i, t) for i, t in docs if brute([(i, t)], items)}
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(str((i, t)) for i, t in docs if (i, t) not in bad)
    assert d.contaminations(frame.limit(0), benchmark).collect() == []
    assert d.contaminations(frame, benchmark.limit(0)).collect() == []
    assert d.without_items(frame, benchmark.limit(0)).count() == len(docs)


def test_the_given_passages(spark):
    docs, benchmark = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    got = {(r["doc_id"], r["item_id"]) for r in d.contaminations(docs, benchmark).collect()}
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    exact = {(r["doc_id"], i) for r in docs.collect() for i, t in items if t in r["text"]}
    assert exact and exact <= got
    clean = {i for i, _ in got} - {i for i, _ in exact}
    assert not clean


@pytest.mark.parametrize("seed", range(6))
def test_repetitive_texts_against_the_table(seed):
    draw = random.Random(seed)
    items = [(i, d.normalised("".join(draw.choices(["ab ", "ab ", "ba ", "abc "], k=draw.randint(14, 40))))) for i in range(6)]
    items = [(i, t) for i, t in items if len(t) >= d.LEAST_CHARS]
    matcher = d.Matcher(items)
    for _ in range(10):
        text = d.normalised("".join(draw.choices(["ab ", "ab ", "ba ", "abc ", "cab "], k=draw.randint(10, 120))))
        found = matcher.best(text)
        for _, each in items:
            least = min(distances(each, text))
            assert (each in found) == (least <= matcher.budget[each])
            if each in found:
                distance, start, end = found[each]
                assert distance == least == distances(each, text[start:end])[-1]


def test_a_repetitive_text_is_gone_through_once():
    matcher = d.Matcher([(1, d.normalised("ab " * 250 + "xyz " * 40))])
    start = time.process_time()
    assert matcher.best(d.normalised("ab " * 1_000)) == {}
    assert time.process_time() - start < 0.5


def test_short_items_are_found_as_whole_words():
    matcher = d.Matcher([(1, "the red fox"), (2, "fox")])
    assert matcher.best("see the red fox run") == {"the red fox": (0, 4, 15), "fox": (0, 12, 15)}
    assert matcher.best("the red foxes") == {} and matcher.best("the rad fox") == {"fox": (0, 8, 11)}
    assert matcher.best("foxes and a fox") == {"fox": (0, 12, 15)}

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sensorspan.llm import minhash


def shingles(text):
    words = text.lower().translate({c: " " for c in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def jaccard(a, b):
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


def edited(text, following):
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def corpus(n=120):
    draw = random.Random(11)
    words = [f"w{i}" for i in range(300)] + ["ß", "é", "日本"]
    rows = [(i * 3 - 50, " ".join(draw.choices(words, k=draw.randint(1, 300)))) for i in range(n)]
    return rows + [(9999, ""), (9998, "a"), (9997, " \n "), (9996, "long " * 40_000), (9995, rows[0][1])]


@pytest.mark.parametrize("pieces", [1, 7, 500])
def test_chain_of_next_documents(documents, pieces):
    rows = corpus()
    got = {r["doc_id"]: r for r in minhash.fingerprint_documents(documents([(i, t, "", "") for i, t in rows]), pieces).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    errors = []
    for (i, text), (_, following) in zip(order, [*order[1:], order[0]]):
        r = got[i]
        new = edited(text, following)
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if text.strip() and new.strip() and following.strip():
            errors.append(r["near_edited"] - jaccard(text, new))
            errors.append(r["near_next"] - jaccard(text, following))
    assert sum(e * e for e in errors) / len(errors) < 0.05**2
    assert abs(sum(errors) / len(errors)) < 0.02
    assert got[9995]["fingerprint"] == got[rows[0][0]]["fingerprint"]
    assert got[9999]["fingerprint"] == got[9997]["fingerprint"] == ""


def test_nulls_ties_and_repeats(documents):
    rows = [(1, "b c", "", ""), (1, "a b", "", ""), (2, None, "", ""), (None, "z", "", ""), (None, None, "", ""), (1, "a b", "", "")]
    got = minhash.fingerprint_documents(documents(rows)).collect()
    # Order: 2, then 1 by text, then null ids by text, then 2 again.
    chain = [(2, ""), (1, "a b"), (1, "a b"), (1, "b c"), (None, ""), (None, "z")]
    expected = [
        (i, len(t), hashlib.sha256(edited(t, f).encode()).hexdigest())
        for (i, t), (_, f) in zip(chain, [*chain[1:], chain[0]])
    ]
    assert sorted(map(str, ((r[0], r[1], r[2]) for r in got))) == sorted(map(str, expected))
    assert all(r["near_edited"] == 1.0 for r in got if not r["n_chars"])


def test_no_row_and_one_row(documents):
    assert minhash.fingerprint_documents(documents([])).collect() == []
    (r,) = minhash.fingerprint_documents(documents([(4, "abcdef", "", "")])).collect()
    assert r["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and r["near_next"] == 1.0


def test_likeness_is_exact_in_the_extremes(spark):
    draw = random.Random(5)
    a = " ".join(f"x{draw.random()}" for _ in range(500))
    b = " ".join(f"y{draw.random()}" for _ in range(500))
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        minhash.likeness(minhash.fingerprint(F.col("a")), minhash.fingerprint(F.col("a"))).alias("same"),
        minhash.likeness(minhash.fingerprint(F.col("a")), minhash.fingerprint(F.col("b"))).alias("other"),
        F.length(minhash.fingerprint(F.col("a"))).alias("length"),
    )
    same, other, length = row.first()
    assert same == 1.0 and other < 0.05 and length == minhash.BINS * minhash.HEX


def test_likeness_is_near_the_share_of_common_shingles(spark):
    draw = random.Random(6)
    pairs = []
    for _ in range(150):
        words = [f"t{draw.randint(0, 10**6)}" for _ in range(400)]
        other = words[: draw.randint(0, 400)] + [f"u{draw.randint(0, 10**6)}" for _ in range(100)]
        pairs.append((" ".join(words), " ".join(other)))
    frame = spark.createDataFrame(pairs, "a string, b string")
    got = frame.select("a", "b", minhash.likeness(minhash.fingerprint(F.col("a")), minhash.fingerprint(F.col("b"))).alias("x")).collect()
    errors = [r["x"] - jaccard(r["a"], r["b"]) for r in got]
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.05
    assert abs(sum(errors) / len(errors)) < 0.015


def test_no_python_in_the_plan(documents):
    plan = minhash.fingerprint_documents(documents([(1, "a", "", "")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

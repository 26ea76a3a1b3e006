from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from sensorspan.llm import decontamination
from sensorspan.llm.common import table
from sensorspan.llm.queries import QUERIES

from .conftest import SF
from .test_jaccard import brute_kept
from .test_sharding_mixing import check_mix, check_shards


def test_registered():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]


def test_each_stage_against_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = table(spark, SF, "documents").withColumn("extra", F.col("doc_id"))
    rows = {r["doc_id"]: r for r in docs.collect()}

    known = stages["language_id"](spark, docs, SF).cache()
    kept = {r["doc_id"] for r in known.collect()}
    assert known.columns == list(corpus_pipeline.COLUMNS)
    assert kept == {i for i, r in rows.items() if any(c.isalpha() for c in r["text"] or "")}

    single = stages["near_dedup"](spark, known, SF).cache()
    kept = brute_kept([(i, rows[i]["text"]) for i in kept])
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(kept)

    clean = stages["decontamination"](spark, single, SF).cache()
    matcher = decontamination.Matcher([(r["item_id"], decontamination.normalised(r["text"])) for r in table(spark, SF, "benchmark").collect()])
    kept = {i for i in kept if not matcher.best(decontamination.normalised(rows[i]["text"]))}
    assert {r["doc_id"] for r in clean.collect()} == kept

    mixed = stages["mixing"](spark, clean, SF).cache()
    copies = Counter(r["doc_id"] for r in mixed.collect())
    from sensorspan.llm.mixing import mix

    rates = mix(clean).collect()
    check_mix([(i, rows[i]["text"], "", rows[i]["source"]) for i in kept], rates)
    assert copies == Counter({r["doc_id"]: r["copies"] for r in rates if r["copies"]})

    shards = stages["sharding"](spark, mixed, SF).collect()
    check_shards([(i, rows[i]["text"]) for i in copies.elements()], shards, corpus_pipeline.SHARDS)


def test_run_is_the_stages_in_order(spark):
    docs = table(spark, SF, "documents").select(*corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
    got = corpus_pipeline.run(spark, SF)
    key = lambda r: (r["doc_id"], r["size"], r["shard"])
    assert sorted(map(key, got.collect())) == sorted(map(key, docs.collect()))


def test_stages_without_rows_and_with_odd_ones(documents):
    odd = [(None, None, None, None), (1, "", "en", "a"), (2, "the same words here", "en", None), (2, "the same words here", "en", None), (None, "no id at all, it seems", "en", "b")]
    for rows in ([], odd):
        frame = documents([(*r, 3) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
        for name, stage in corpus_pipeline.STAGES:
            assert stage(frame.sparkSession, frame, SF).count() <= 3 * len(rows), name


def test_near_dedup_leaves_distinct_texts(documents):
    rows = [(i, f"{i} entirely different words number {i * 7919} follow {i * 104729} here", "en", "s", 1) for i in range(50)]
    frame = documents(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert dict(corpus_pipeline.STAGES)["near_dedup"](frame.sparkSession, frame, SF).count() == 50

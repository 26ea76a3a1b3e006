from __future__ import annotations

import random

import corpus_pipeline
from sensorspan.llm.common import table

from .conftest import SF

FOREIGN = (
    "A gyors barna róka átugrik a lusta kutya fölött, és azután hazamegy a házába vacsorázni a családjával",
    "Быстрая коричневая лиса прыгает через ленивую собаку и идет домой",
    "Szybki brązowy lis przeskakuje nad leniwym psem i wraca do domu na kolację z rodziną",
)


def test_planted_foreign_and_junk_texts_go_and_clean_ones_stay(spark):
    docs = table(spark, SF, "documents").select(*corpus_pipeline.COLUMNS)
    draw = random.Random(1)
    junk = [" ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 9))) for _ in range(40)) for _ in range(4)]
    planted = [(100_000 + i, text, lang, "s", len(text)) for i, (text, lang) in enumerate(zip([*FOREIGN, *junk], ["en", None, "es", "fr", None, "de", "en"]))]
    planted.append((200_000, "12 34 !", "en", "s", 7))
    clean = {r["doc_id"] for r in docs.collect()}
    both = docs.union(spark.createDataFrame(planted, docs.schema))
    kept = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["language_id"](spark, both, SF).collect()}
    assert kept == clean

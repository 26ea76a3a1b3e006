"""Scan texts for secrets; a random forest removes false positives.

A candidate is a long run of key characters inside a word. Its features are
its length, the changes between kinds of characters in it, how much of it a
dictionary covers, the address or path it stands in, and its neighbouring
words. The forest is trained from labelled findings. All of it is SQL
functions and Spark's own forest.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, drawn, let, saved

# A candidate: 16 key characters or more, or 12 with a digit among them.
RUN = r"[A-Za-z0-9+/_\-]{12,}"
SHORTEST, SHORTEST_WITHOUT_DIGIT = 12, 16
# Formats that issuers of keys document, by name.
FORMATS = {
    "aws_key_id": r"^(?:AKIA|ASIA)[A-Z0-9]{16}$",
    "github_token": r"^(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,})$",
    "slack_token": r"^xox[abprs]-[A-Za-z0-9\-]{10,}$",
    "stripe_key": r"^(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{16,}$",
    "google_key": r"^AIza[A-Za-z0-9_\-]{35}$",
    "json_web_token": r"^eyJ[A-Za-z0-9_\-]{10,}$",
}
# Words that name secrets, and words that name harmless look-alikes.
NAMES = r"(?i)pass(?:word|wd|phrase)?|pwd|secret|token|api[_\-]?key|auth|credential|bearer|private|access[_\-]?key|signing"
HARMLESS = r"(?i)example|sample|dummy|placeholder|changeme|redacted|uuid|guid|commit|checksum|digest|sha1|sha256|md5|isbn|doi|xxxx|1234567"
# A word is in the dictionary if it is this share of all words or more; so there are at most that many.
DICTIONARY_SHARE = 5000
DICTIONARY_LEAST = 3
# Labelled findings of each kind that the forest learns from, about, at most.
LABELLED = 10_000
TREES, DEPTH, SEED = 40, 8, 17
THRESHOLD = 0.5

FEATURES = (
    "length", "transitions", "digits", "uppers", "symbols", "distinct", "hex", "vowels", "coverage", "in_address",
    "in_path", "assigned", "quoted", "named", "named_before", "harmless", "format",
)


def candidates(docs: DataFrame) -> DataFrame:
    """Of docs (doc_id, text): doc_id, word_at, place, candidate, lead, tail, before, before2, after.

    word_at counts the words of the text from 0, place the candidates of a word;
    lead and tail are what the word has before and after the candidate, the rest
    its neighbouring words.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.trim(F.regexp_replace("text", SPACE, " ")).alias("text"))

    def found(words: Column) -> Column:
        wanted = F.filter(
            F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
            lambda x: (F.char_length(x["w"]) >= SHORTEST) & x["w"].rlike(RUN),
        )
        near = lambda i, by: F.coalesce(F.get(words, i + by), F.lit(""))
        return F.transform(
            wanted,
            lambda x: F.struct(
                x["i"].cast("long").alias("word_at"), x["w"].alias("word"), near(x["i"], -1).alias("before"),
                near(x["i"], -2).alias("before2"), near(x["i"], 1).alias("after"),
            ),
        )

    hits = rows.where(F.col("text").rlike(RUN)).select("doc_id", F.explode(let(F.split("text", " "), found)).alias("x"))
    each = hits.select("doc_id", "x.*").select(
        "*", F.posexplode(F.expr(f"regexp_extract_all(word, r'({RUN})', 1)")).alias("place", "candidate")
    )
    # The word up to the candidate: what its own and the earlier candidates leave of it.
    parts = F.split("word", RUN, -1)
    own = each.select(
        "doc_id", "word_at", F.col("place").cast("long").alias("place"), "candidate",
        F.get(parts, F.col("place")).alias("lead"), F.get(parts, F.col("place") + 1).alias("tail"), "before", "before2", "after",
    )
    return own.where((F.char_length("candidate") >= SHORTEST_WITHOUT_DIGIT) | F.col("candidate").rlike("[0-9]"))


def dictionary(docs: DataFrame) -> list[str]:
    """Frequent words of all texts, letters only; bounded by ``DICTIONARY_SHARE``."""
    word = F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")
    counts = saved(docs.select(word).where("word <> ''").groupBy("word").agg(F.count("*").alias("n")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common = counts.where((F.col("n") * DICTIONARY_SHARE >= total) & (F.char_length("word") >= DICTIONARY_LEAST))
    return sorted((r["word"] for r in common.select("word").collect()), key=lambda w: (-len(w), w))


def share(text: Column, pattern: str) -> Column:
    """The share of a text's characters that the pattern matches."""
    return 1 - F.char_length(F.regexp_replace(text, pattern, "")) / F.greatest(F.char_length(text), F.lit(1))


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    """Candidates with a column for each of ``FEATURES``."""
    c = F.col("candidate")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0"), "[^aA0]", "_")
    changes = F.char_length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1
    covered = share(F.lower(c), "|".join(map(re.escape, words))) if words else F.lit(0.0)
    near = F.concat_ws(" ", "lead", "before")
    flags = {
        "in_address": F.col("lead").rlike("@|://") | F.col("tail").rlike("^(?:@|://)"),
        "in_path": c.contains("/") | F.col("lead").contains("\\"),
        "assigned": F.col("lead").rlike(r"[=:]") | F.col("before").rlike(r"[=:]$"),
        "quoted": F.col("lead").rlike("[\"'`]$") & F.col("tail").rlike("^[\"'`]"),
        "named": near.rlike(NAMES),
        "named_before": F.col("before2").rlike(NAMES),
        "harmless": F.concat_ws(" ", near, "before2", "candidate").rlike(HARMLESS),
        "hex": c.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "format": F.col("kind").isin(*FORMATS),
    }
    numbers = {
        "length": F.char_length(c),
        "transitions": changes / F.greatest(F.char_length(c) - 1, F.lit(1)),
        "digits": share(c, "[0-9]"),
        "uppers": share(c, "[A-Z]"),
        "symbols": share(c, "[^A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / F.char_length(c),
        "vowels": share(F.lower(c), "[aeiouy]"),
        "coverage": covered,
    }
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(FORMATS.items()):
        kind = F.when(c.rlike(pattern), name).otherwise(kind)
    kinded = found.withColumn("kind", F.coalesce(kind, F.when(flags["assigned"], "assignment").otherwise("bare")))
    columns = {**numbers, **flags}
    return kinded.select("*", *(columns[f].cast("double").alias(f) for f in FEATURES))


def own_labels(found: DataFrame) -> DataFrame:
    """Findings that speak for themselves, labelled 1 or 0; the others are left out.

    Secrets: a documented format, or a random-looking value assigned to a name of secrets. Not secrets:
    addresses, numbers, plain words, and whatever is called harmless.
    """
    random = (F.col("digits") > 0.1) & (F.col("digits") < 0.95) & (F.col("transitions") > 0.15) & (F.col("coverage") < 0.5)
    named = (F.col("named") + F.col("named_before")) > 0
    secret = (F.col("harmless") == 0) & (F.col("in_address") == 0) & ((F.col("format") == 1) | (F.col("assigned") == 1) & named & random)
    harmless = (F.col("harmless") == 1) | (F.col("in_address") == 1) | (F.col("digits") == 1) | (F.col("digits") == 0) & (F.col("format") == 0) & ~named
    label = F.when(secret, 1.0).when(harmless, 0.0)
    return found.withColumn("label", label).where("label is not null")


def train(labelled: DataFrame, limit: int = LABELLED):
    """A forest from findings (FEATURES, label); None unless there are findings of both kinds.

    Of each kind about ``limit`` findings are drawn by hash; equal ones are one that weighs more.
    """
    distinct = saved(labelled.groupBy(*FEATURES, "label").agg(F.count("*").alias("weight")))
    held = {r["label"]: r["count"] for r in distinct.groupBy("label").count().collect()}
    if len(held) < 2:
        return None
    share = F.when(F.col("label") == 1, limit / held[1.0]).otherwise(limit / held[0.0])
    sample = saved(distinct.where(drawn(F.xxhash64(*FEATURES), share)).orderBy(*FEATURES))
    if sample.select("label").distinct().count() < 2:
        return None
    # Both kinds weigh the same in all.
    totals = {r["label"]: r["w"] for r in sample.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    even = F.when(F.col("label") == 1, F.col("weight") / totals[1.0]).otherwise(F.col("weight") / totals[0.0]) * sum(totals.values())
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="even", featureSubsetStrategy="sqrt")
    return forest.fit(_assembled(sample.withColumn("even", even)))


def _assembled(found: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate in the rows of ``docs`` (doc_id, text), with the forest's verdict.

    Returns doc_id, word_at, place, kind (a documented format, assignment or bare), length, masked
    (the first four characters and stars), digest (SHA-256 of the candidate), score and
    is_secret (score at least ``THRESHOLD``). ``labelled`` are findings (candidate, lead, tail,
    before, before2, after, label) to learn from; without it the findings of ``docs`` that speak for
    themselves are. Without both kinds of labelled findings there is no forest, and a
    finding scores 1 if it speaks for itself as a secret, else 0. Null and empty texts have no
    candidates. Repeated rows and repeated candidates are findings of their own. No rows give no rows.
    Other columns are ignored; texts are read whole.
    """
    words = dictionary(docs)
    found = saved(with_features(candidates(docs), words))
    if labelled is None:
        known = own_labels(found)
    else:
        known = with_features(labelled, words)
    forest = train(known)
    if forest is None:
        secret = own_labels(found).where("label = 1").select("doc_id", "word_at", "place").distinct().withColumn("score", F.lit(1.0))
        scored = found.join(secret, ["doc_id", "word_at", "place"], "left").fillna(0.0, ["score"])
    else:
        scored = forest.transform(_assembled(found)).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select(
        "doc_id", "word_at", "place", "kind", F.char_length("candidate").cast("long").alias("length"),
        F.concat(F.substring("candidate", 1, 4), F.lit("****")).alias("masked"),
        F.sha2(F.encode("candidate", "UTF-8"), 256).alias("digest"), F.round("score", 6).alias("score"),
        (F.col("score") >= THRESHOLD).alias("is_secret"),
    )

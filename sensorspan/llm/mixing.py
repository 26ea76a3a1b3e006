"""Mix sources to target weights by entropy balancing.

Each document gets a rate, the expected number of its copies in the mix. Of
all rates whose tokens meet the targets of the sources, those nearest to 1 in
Kullback-Leibler divergence over tokens are exponentials of one multiplier for
each source, and the multipliers minimise a convex dual:

    sum over documents of size * exp(multiplier of its source)
    - sum over sources of multiplier * target

Newton's method solves it; a step needs the gradient and the curvature of each
source, which are sums over its documents, so every step is one aggregation.
Rates become whole copies by systematic sampling in order of size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, saved, words

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
TOLERANCE = 1e-12
MAX_STEPS = 100


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The words that each source (source, source_size) should give.

    Sources in order of their code points, null last, weigh ``weights``
    repeating. They share all words by weight; none gets over ``most`` times
    what it has, and what is above goes to the others by weight until none is
    above. In order of limit per weight the sources at their limit come first,
    so the share per weight of the others is what the limits leave, by weight.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*map(F.lit, weights))
    sources = (
        totals.withColumn("_weight", F.element_at(cycle, ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int")))
        .withColumn("_limit", F.col("source_size") * most)
        .withColumn("_ratio", F.col("_limit") / F.col("_weight"))
    )
    order = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    full = F.coalesce(F.sum("_limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("source_size").over(everything) - full
    share = left / F.sum("_weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    sources = sources.withColumn("_share", share)
    # The first source that its share does not fill up settles the share of all after it.
    settled = F.min(F.when(F.col("_share") <= F.col("_ratio"), F.struct("_ratio", "_share"))).over(everything)
    sources = sources.withColumn("_settled", settled["_share"])
    target = F.least(F.col("_limit").cast("double"), F.col("_settled") * F.col("_weight"))
    return sources.select("source", "source_size", target.alias("target"))


def multipliers(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Newton's method on the dual: wanted (source, target) with a multiplier for each source.

    ``rows`` (source, size) are the documents. A source without words or
    without a target has nothing to balance and a null multiplier. The step
    is damped from below by -1 and the start is 0, where the dual bends least
    too little, so the iteration descends monotonically.
    """
    sizes = saved(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    start = F.when((F.col("source_size") > 0) & (F.col("target") > 0), 0.0)
    state = saved(wanted.withColumn("multiplier", start))
    for _ in range(MAX_STEPS):
        # A source's documents share a multiplier, so whole numbers are summed: no order of the sum changes a digit.
        tilted = F.sum(F.col("n") * F.col("size")) * F.exp("multiplier")
        own = state.select(F.col("source").alias("_source"), "multiplier")
        sums = (
            sizes.join(own, F.col("source").eqNullSafe(F.col("_source")))
            .groupBy("_source", "multiplier")
            .agg(tilted.alias("_tokens"))
            .drop("multiplier")
        )
        # Gradient: tokens - target; curvature: tokens.
        state = saved(
            state.join(sums, F.col("source").eqNullSafe(F.col("_source")), "left")
            .withColumn("_step", (F.col("target") - F.col("_tokens")) / F.col("_tokens"))
            .select("source", "source_size", "target", (F.col("multiplier") + F.col("_step")).alias("multiplier"), "_step")
        )
        far = state.agg(F.max(F.abs("_step"))).first()[0]
        state = state.drop("_step")
        if far is None or far < TOLERANCE:
            break
    return state


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Give every row of ``docs`` (doc_id, text, source) its copies in the mix.

    Returns doc_id, source, size (words), source_size, target (words wanted of its
    source), rate and copies (0 to ``most``). The copies of a source's documents
    together come to its target within about half the size of its largest document:
    in order of size, id and a hash of the text each document adds its rate's fraction, and every
    time the sum passes a whole number and a half a document gets one more copy.

    Null sources are one source, the last. Null and empty texts have size 0 and
    add no words. Repeated rows are rows of their own; which of them gets a copy more
    is open. No rows give no rows. Other columns are ignored.
    The same rows give the same copies, however they lie in files and partitions.
    """
    size = F.size(words(F.col("text"))).cast("long")
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = saved(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("size"), digest.alias("_digest"))
    ).withColumn("_place", F.monotonically_increasing_id())  # cuts a hot group of equal rows
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    state = multipliers(rows, targets(totals, weights, most))
    rate = F.least(F.coalesce(F.exp("multiplier"), F.lit(0.0)), F.lit(float(most)))
    rates = state.select(F.col("source").alias("_source"), "source_size", "target", rate.alias("rate"))
    whole = F.floor(F.col("rate") + 1e-9)
    fraction = F.greatest(F.col("rate") - whole, F.lit(0.0))
    passed = F.floor((F.col("rank") + 1) * fraction + 0.5) - F.floor(F.col("rank") * fraction + 0.5)
    return (
        numbered(rows, ["source"], ["size", "doc_id", "_digest", "_place"], "rank")
        .join(rates, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("copies", F.least(whole + passed, F.lit(most)).cast("long"))
        .select("doc_id", "source", "size", "source_size", "target", "rate", "copies")
    )

"""Document fingerprints by one-permutation MinHash, in SQL functions only.

Every word shingle is hashed once. The high bits of the hash name a bin, the
rest is its value there, and a bin keeps its least value. An empty bin borrows
from a filled one by optimal densification: a hash of the bin and the attempt
picks a bin until a filled one is met; the same bins are tried in the same
order for every text. The low bits of all bins are packed into a hex string.
Of unlike texts two low parts still agree by chance once in 2^bits, for which the
likeness is corrected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, code_points, let, saved

SHINGLE = 5
BIN_BITS = 7
LOW_BITS = 8
ATTEMPTS = 8
BINS = 1 << BIN_BITS
VALUE_BITS = 63 - BIN_BITS
EMPTY = (1 << VALUE_BITS) - 1
HEX = LOW_BITS // 4


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """63-bit hashes of a text's word shingles; one of all words if they are fewer; none without words."""
    found = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), lambda w: w != "")
    each = F.transform(found, lambda w: F.xxhash64(w))

    def shingles(words: Column) -> Column:
        long = F.transform(
            F.sequence(F.lit(1), F.size(words) - (shingle - 1)),
            lambda i: F.xxhash64(*(F.element_at(words, i + k) for k in range(shingle))),
        )
        few = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(words) >= shingle, long).otherwise(few)

    return F.transform(let(each, shingles), lambda h: h.bitwiseAND(F.lit((1 << 63) - 1)))


def bin_minima(hashes: Column) -> Column:
    """The least hash of each bin in order of bins; ``EMPTY`` as the value of a bin without any.

    One marker for each bin joins the hashes; after sorting, the first of each
    bin is its least hash or, of an empty bin, the marker.
    """
    markers = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.shiftleft(b.cast("long"), VALUE_BITS) + EMPTY)

    def firsts(ordered: Column) -> Column:
        bin_of = lambda h: F.shiftright(h, VALUE_BITS)
        return F.filter(ordered, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(ordered, i - 1))))

    return let(F.sort_array(F.concat(hashes, markers)), firsts)


def densified(minima: Column) -> Column:
    """The value of each bin; an empty bin takes the first filled one that its probes meet.

    After ``ATTEMPTS`` probes the filled bin with the least hash of (bin, filled bin) is
    taken, which is the end of a random order of all bins, so that sparse
    texts need no long search.
    """

    def fill(values: Column) -> Column:
        filled = F.filter(
            F.transform(values, lambda v, i: F.struct(v.alias("v"), i.cast("int").alias("bin"))), lambda x: x["v"] != EMPTY
        )

        def probe(i: Column, attempt: int) -> Column:
            v = F.get(values, F.pmod(F.xxhash64(i, F.lit(attempt)), F.lit(BINS)).cast("int"))
            return F.when(v != EMPTY, v)

        def borrowed(taken: Column, i: Column) -> Column:
            least = F.array_min(F.transform(taken, lambda x: F.struct(F.xxhash64(i, x["bin"]).alias("h"), x["v"].alias("v"))))
            return F.coalesce(*(probe(i, a) for a in range(ATTEMPTS)), least["v"], F.lit(EMPTY))

        return let(filled, lambda taken: F.transform(values, lambda v, i: F.when(v != EMPTY, v).otherwise(borrowed(taken, i))))

    return let(F.transform(minima, lambda h: h.bitwiseAND(F.lit(EMPTY))), fill)


def fingerprint(text: Column) -> Column:
    """The packed low bits of all bins as hex digits; empty for a text without words."""
    low = F.transform(
        densified(bin_minima(shingle_hashes(text))),
        lambda v: F.lower(F.lpad(F.hex(v.bitwiseAND(F.lit((1 << LOW_BITS) - 1))), HEX, "0")),
    )
    return F.when(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")) == "", "").otherwise(F.array_join(low, ""))


def likeness(a: Column, b: Column) -> Column:
    """The estimated Jaccard likeness of two fingerprints' shingles, 0 to 1; two without words are alike."""
    equal = F.aggregate(
        F.sequence(F.lit(0), F.lit(BINS - 1)),
        F.lit(0),
        lambda n, i: n + (F.substring(a, i * HEX + 1, F.lit(HEX)) == F.substring(b, i * HEX + 1, F.lit(HEX))).cast("int"),
    )
    chance = 1.0 / (1 << LOW_BITS)
    corrected = F.greatest((equal / F.lit(float(BINS)) - chance) / (1 - chance), F.lit(0.0))
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(corrected)


def descending_pieces(ids: DataFrame, pieces: int) -> tuple[list[int], list[int]]:
    """Bounds that cut the ids (doc_id) into about equal pieces, and the greatest id in each piece.

    Bounded by the number of pieces. Piece k holds the ids above k of the bounds.
    """
    shares = [i / pieces for i in range(1, pieces)]
    cuts = ids.agg(F.percentile_approx("doc_id", shares, 1000 * pieces) if shares else F.lit(None)).first()[0]
    bounds = sorted(set(cuts or []))
    greatest = ids.where("doc_id is not null").groupBy(piece_of(F.col("doc_id"), bounds).alias("piece"))
    return bounds, [r[1] for r in greatest.agg(F.max("doc_id")).collect()]


def piece_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are below the id, by binary search."""
    if not bounds:
        return F.lit(0)
    held = F.array(*(F.lit(b).cast("long") for b in bounds))
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))))
    below = lambda at, step: (at + step <= len(bounds)) & (F.get(held, at + step - 1) < doc_id)
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(below(at, step), step).otherwise(0))


def fingerprint_documents(docs: DataFrame, pieces: int | None = None) -> DataFrame:
    """Fingerprint every row of ``docs`` (doc_id, text) and an edited text of it.

    The edited text ends in the beginning of the next document, by descending
    doc_id, after the last the first: the last floor(n_chars / 3) code points
    are replaced by as many of its first ones, or by all if it has fewer.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. A null text is an empty one; its fingerprint and that of
    blank texts is empty, like each other and unlike all else. Rows with
    equal ids follow each other by text, null ids come last, also by text. A
    single row is its own next. No rows give no rows. Other columns are ignored.

    Documents are cut into pieces by id. The first of each piece is also
    put at the end of the piece before, so that no window spans pieces and texts are
    shuffled once.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if pieces is None:
        pieces = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds, greatest = descending_pieces(rows.select("doc_id"), pieces)
    present = sorted(greatest, reverse=True)  # the greatest id of each piece that has rows, in order
    nulls = rows.where("doc_id is null").limit(1).count() > 0
    return _chained(rows, bounds, present, nulls)


def _chained(rows: DataFrame, bounds: list[int], present: list[int], nulls: bool) -> DataFrame:
    spark = rows.sparkSession
    own = F.coalesce(piece_of(F.col("doc_id"), bounds), F.lit(0)).cast("int")
    # Null ids are a piece after all others.
    home = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(own)
    order = [*present, *([None] if nulls else [])]
    pieces = spark.createDataFrame(
        [(x, order[i - 1]) for i, x in enumerate(order)], "head long, before long"
    ).select("head", F.when(F.col("before").isNull(), F.lit(-1)).otherwise(piece_of(F.col("before"), bounds)).cast("int").alias("also"))
    marked = rows.withColumn("fingerprint", fingerprint(F.col("text"))).withColumn("home", home)
    # One head for each piece: a few rows, found by id before anything is computed of them.
    heads = (
        rows.join(F.broadcast(pieces), F.col("doc_id").eqNullSafe(F.col("head")))
        .groupBy("head", "also")
        .agg(F.min("text").alias("text"))
        .select("also", "text", fingerprint(F.col("text")).alias("fingerprint"))
    )
    both = marked.select("home", "doc_id", "text", "fingerprint", F.lit(False).alias("extra")).unionByName(
        heads.select(F.col("also").alias("home"), F.lit(None).cast("long").alias("doc_id"), "text", "fingerprint", F.lit(True).alias("extra"))
    )
    following = Window.partitionBy("home").orderBy("extra", F.col("doc_id").desc_nulls_last(), "text")
    next_of = lambda c: F.lead(c).over(following)
    paired = both.withColumn("next_text", next_of("text")).withColumn("next_fingerprint", next_of("fingerprint")).where("not extra")
    n_chars = code_points(F.col("text"))
    tail = F.floor(n_chars / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (n_chars - tail).cast("int")), F.substring("next_text", F.lit(1), tail))
    done = paired.select("doc_id", n_chars.alias("n_chars"), "fingerprint", "next_fingerprint", edited.alias("edited"))
    done = done.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        "fingerprint", fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_fingerprint",
    )
    return done.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )

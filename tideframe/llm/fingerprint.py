"""Document fingerprints by order MinHash, in built-in expressions only.

The tokens of a text are its words in lower case, or its characters if it has fewer than ``LEAST_WORDS`` words. k-mers (five
words, three characters) are hashed and numbered by occurrence, so the second "a b c d e" differs from the first. The hash
puts a k-mer into one of ``BINS`` bins; each bin keeps its two k-mers of least hash, and the hash of the two in text
order is the bin's part of the signature. Moved or replaced passages therefore change the signature even where
the sets of k-mers agree. The likeness of two fingerprints is the root of the share of equal bins among bins filled in
either: a bin agrees if both its k-mers do, so the root is on the scale of single k-mers.

Everything of a text happens in its row: nothing is shuffled for a fingerprint.

Defined cases: a null text counts as empty; a text without tokens has an empty fingerprint, and two empty ones have likeness
1; a text shorter than a k-mer is one k-mer; equal texts have equal fingerprints; positions are kept in 24 bits, beyond
them k-mers count as last in text order. In :func:`with_next`, ids are ordered descending, nulls last, rows of
one id by their text; a single row follows itself; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS, CHARS, LEAST_WORDS = 5, 3, 32
BIN_BITS, HASH_BITS, PLACE_BITS = 5, 39, 24
BINS = 1 << BIN_BITS
#: Ids of about so many rows share a bucket when neighbours are looked up; so many buckets share a range of buckets.
BUCKET_ROWS, RANGE_BUCKETS = 256, 4096
#: Rows of (bucket, id, bucket) that may be broadcast: some 16 MB.
BROADCAST_ROWS = 500_000
_HASH_MASK, _PLACE_MASK = (1 << HASH_BITS) - 1, (1 << PLACE_BITS) - 1


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def tokens(text: Column) -> Column:
    """(tokens, k) of a text."""
    lower = F.lower(text)
    return let(
        F.array_remove(F.split(lower, r"[^\p{L}\p{N}]+"), ""),
        lambda words: F.when(F.size(words) >= LEAST_WORDS, F.struct(words.alias("items"), F.lit(WORDS).alias("k"))).otherwise(
            F.struct(F.array_remove(F.split(lower, ""), "").alias("items"), F.lit(CHARS).alias("k"))
        ),
    )


def _hash_of(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def _bin_of(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS + HASH_BITS - BIN_BITS)


def _pack(h: Column, place: Column) -> Column:
    return F.shiftleft(h.bitwiseAND(F.lit(_HASH_MASK)), PLACE_BITS).bitwiseOR(F.least(place.cast("long"), F.lit(_PLACE_MASK)))


def _numbered(kmers: Column) -> Column:
    """Hash and place of every k-mer in one long, occurrences told apart; sorted by hash."""
    packed = F.sort_array(F.transform(kmers, _pack))

    def label(ordered: Column) -> Column:
        heads = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (_hash_of(F.get(ordered, i)) != _hash_of(F.get(ordered, i - 1))),
        )

        def run(heads: Column) -> Column:
            return F.flatten(
                F.transform(
                    heads,
                    lambda start, k: F.transform(
                        F.slice(ordered, start + 1, F.coalesce(F.get(heads, k + 1), F.size(ordered)) - start),
                        lambda x, j: F.when(j == 0, x).otherwise(_pack(F.xxhash64(_hash_of(x), j), x.bitwiseAND(F.lit(_PLACE_MASK)))),
                    ),
                )
            )

        return F.sort_array(let(heads, run))

    return F.when(F.size(F.array_distinct(kmers)) == F.size(kmers), packed).otherwise(let(packed, label))


def _signature(ordered: Column) -> Column:
    """One long per filled bin: its number above 32 bits of the hash of its two least k-mers in text order."""
    least = F.filter(ordered, lambda x, i: (i < 2) | (_bin_of(F.get(ordered, i - 2)) != _bin_of(x)))

    def bins(least: Column) -> Column:
        heads = F.filter(F.sequence(F.lit(0), F.size(least) - 1), lambda i: (i == 0) | (_bin_of(F.get(least, i - 1)) != _bin_of(F.get(least, i))))

        def pair(i: Column) -> Column:
            a, b = F.get(least, i), F.get(least, i + 1)
            place_a, place_b = a.bitwiseAND(F.lit(_PLACE_MASK)), b.bitwiseAND(F.lit(_PLACE_MASK))
            both = F.when(place_a <= place_b, F.xxhash64(_hash_of(a), _hash_of(b))).otherwise(F.xxhash64(_hash_of(b), _hash_of(a)))
            value = F.when(b.isNull() | (_bin_of(b) != _bin_of(a)), F.xxhash64(_hash_of(a))).otherwise(both)
            return F.shiftleft(_bin_of(a), 32).bitwiseOR(value.bitwiseAND(F.lit(0xFFFFFFFF)))

        return F.transform(heads, pair)

    return let(least, bins)


def signature(text: Column) -> Column:
    """Array of longs, at most ``BINS``; empty for a text without tokens."""

    def of(t: Column) -> Column:
        items, k = t["items"], t["k"]
        kmers = F.transform(F.sequence(F.lit(1), F.greatest(F.size(items) - k + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(items, i, k)))
        return F.when(F.size(items) == 0, F.array().cast("array<bigint>")).otherwise(let(let(kmers, _numbered), _signature))

    return let(tokens(F.coalesce(text, F.lit(""))), of)


def as_text(sketch: Column) -> Column:
    """A signature as a string: ten hexadecimal digits for each filled bin."""
    return F.lower(F.array_join(F.transform(sketch, lambda x: F.lpad(F.hex(x), 10, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: root of the share of equal bins among those filled in either signature."""
    filled = F.size(F.array_union(F.transform(a, lambda x: F.shiftright(x, 32)), F.transform(b, lambda x: F.shiftright(x, 32))))
    return F.when(filled == 0, 1.0).otherwise(F.sqrt(F.size(F.array_intersect(a, b)) / filled))


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` (doc_id, text, ...) with the ``columns`` of the next row, descending by id, as ``next_...``.

    Rows are dealt into buckets of neighbouring ids with one shuffle. The first row of a bucket also goes to the
    bucket before it, where it follows the last row; which bucket that is comes from one row per bucket.
    """
    bounds = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    low, high, n = bounds[0] or 0, bounds[1] or 0, bounds[2]
    width = max(BUCKET_ROWS, math.ceil(BUCKET_ROWS * (high - low + 1) / max(n, 1)))
    bucket = F.coalesce(F.floor((F.col("doc_id").cast("double") - float(low)) / float(width)).cast("long"), F.lit(-1))
    tops = rows.select("doc_id", bucket.alias("bucket")).groupBy("bucket").agg(F.max("doc_id").alias("top_id"))
    tops = tops.withColumn("range", F.floor(F.col("bucket") / RANGE_BUCKETS))
    ranges = tops.groupBy("range").agg(F.min("bucket").alias("first"))
    in_order = Window.orderBy("range")  # one row per RANGE_BUCKETS buckets
    ranges = ranges.select(
        "range", F.coalesce(F.lead("first").over(in_order), F.min("first").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("further")
    )
    tops = tops.join(ranges, "range").select(
        F.col("bucket").alias("top_bucket"), "top_id", F.coalesce(F.lead("bucket").over(Window.partitionBy("range").orderBy("bucket")), "further").alias("goes_to")
    )
    if tops.count() <= BROADCAST_ROWS:
        tops = F.broadcast(tops)
    dealt = rows.withColumn("bucket", bucket)
    dealt = dealt.join(tops, dealt["bucket"] == tops["top_bucket"])
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("edge"))
    copy = F.struct(F.col("goes_to").alias("bucket"), F.lit(True).alias("edge"))
    places = F.when(F.col("doc_id").eqNullSafe(F.col("top_id")), F.array(own, copy)).otherwise(F.array(own))
    dealt = dealt.withColumn("place", F.explode(places)).select(*rows.columns, "place.bucket", "place.edge")
    following = Window.partitionBy("bucket").orderBy("edge", F.col("doc_id").desc_nulls_last(), "text")
    found = dealt.select(*rows.columns, "edge", *[F.lead(c).over(following).alias(f"next_{c}") for c in columns])
    return found.filter("NOT edge").drop("edge")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The edited text has its last third replaced by the beginning of the next document.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = with_next(docs.select("doc_id", text.alias("text"), signature(text).alias("sketch")), ["text", "sketch"])
    third = F.floor(F.char_length("text") / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.char_length("text") - third), F.substr("next_text", F.lit(1), third))
    rows = rows.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    rows = rows.select("*", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), signature(F.col("edited")).alias("edited_sketch"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )

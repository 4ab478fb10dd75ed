"""Exact deduplication by progressive refinement, in DataFrame functions only.

Rows are grouped by length, then by a hash of their first characters, then by a hash of the whole
text. Only rows whose length and prefix may occur more than once get the full hash, and only narrow rows
(id, length, hashes) are shuffled, never a text. Repeated prefixes reach the rows as a Bloom filter of bounded size;
a false positive costs one hash of a text and changes no group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store

PREFIX_CHARS = 64
# The filter has 16 bits a repeated prefix, in words of 64 bits, and at most 524,288 words (some 20 MB as a broadcast table).
# With more than two million repeated prefixes it lets more rows pass, by and by.
FILTER_WORDS = 1 << 19
_BITS = 3


def _text():
    return F.coalesce(F.col("text"), F.lit(""))


def _word(key: Column, n_words: int) -> Column:
    return F.pmod(key, F.lit(n_words))


def _mask(key: Column) -> Column:
    """The bits of a key in its word."""
    bits = F.lit(0).cast("long")
    for i in range(_BITS):
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(key, 63 - 6 * i - 5).bitwiseAND(F.lit(63)).cast("int")))
    return bits


def _with_repeated(rows: DataFrame, keys: DataFrame, filter_words: int) -> DataFrame:
    """``rows`` with ``repeated``: true wherever ``key`` is one of ``keys``, and rarely elsewhere."""
    n_words = max(1, min(filter_words, math.ceil(keys.count() / 4)))
    words = keys.groupBy(_word(F.col("key"), n_words).alias("word")).agg(F.bit_or(_mask(F.col("key"))).alias("bits"))
    rows = rows.withColumn("word", _word(F.col("key"), n_words)).join(F.broadcast(store(words)), "word", "left")
    mask = _mask(F.col("key"))
    return rows.withColumn("repeated", F.coalesce(F.col("bits").bitwiseAND(mask) == mask, F.lit(False)))


def exact_groups(
    docs: DataFrame, *, prefix_chars: int = PREFIX_CHARS, digest_all: bool = False, filter_words: int = FILTER_WORDS,
) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, text_sha256, keep_id, group_size, n_keep``.

    Equal texts (byte for byte, nothing normalised; null is the empty text) form a group; the largest
    ``doc_id`` stays. ``n_keep`` counts the rows of the group with that id, above 1 only if an id is
    repeated. ``text_sha256`` is null for rows ruled out by the filter of repeated prefixes, unless ``digest_all``. Null
    ids are members like any other, but never stay unless the group has no other id. An empty table
    gives no rows; other columns of ``docs`` are ignored.
    """
    n_bytes = F.octet_length(_text()).cast("long")
    keyed = docs.select(
        "doc_id", n_bytes.alias("n_bytes"), F.xxhash64(n_bytes, F.substring(_text(), 1, prefix_chars)).alias("key"), _text().alias("text"),
    )
    # Both refinements in one pass over narrow rows: lengths that occur once need no prefix count.
    keys = store(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
    digest = F.sha2(F.col("text"), 256)
    rows = _with_repeated(keyed, keys, filter_words).select(
        "doc_id", "n_bytes", "repeated", (digest if digest_all else F.when(F.col("repeated"), digest)).alias("text_sha256"),
    )
    # Repeated rows of one id are counted on the way, so the group sees one row per id and text.
    ids = rows.where("repeated").groupBy("n_bytes", "text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    groups = ids.groupBy("n_bytes", "text_sha256").agg(
        F.max(F.struct("doc_id", "n")).alias("top"), F.sum("n").alias("group_size")
    )
    groups = groups.select(
        "n_bytes", "text_sha256", F.col("top.doc_id").alias("keep_id"), "group_size", F.col("top.n").alias("n_keep")
    )
    return rows.join(groups, ["n_bytes", "text_sha256"], "left").select(
        "doc_id", "n_bytes", "text_sha256",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("n_keep", F.lit(1)).cast("long").alias("n_keep"),
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row per text, the one with the largest ``doc_id``.

    Rows that repeat an id and its text are one document here: any one of them stays (they may differ
    in other columns only).
    """
    groups = exact_groups(docs).where("group_size > 1")
    marks = groups.select(
        F.col("doc_id").alias("__id"), F.col("n_bytes").alias("__n"), F.col("text_sha256").alias("__sha"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("__stays"), F.col("n_keep").alias("__rows"),
    )
    marks = store(marks.where("NOT __stays OR __rows > 1").distinct())
    same = (
        docs["doc_id"].eqNullSafe(F.col("__id"))
        & (F.octet_length(F.coalesce(docs["text"], F.lit(""))) == F.col("__n"))
        & (F.sha2(F.coalesce(docs["text"], F.lit("")), 256) == F.col("__sha"))
    )
    marked = docs.join(marks, same, "left")
    columns = [docs[c] for c in docs.columns]
    fresh = marked.where(F.col("__stays").isNull()).select(columns)
    if marks.where("__stays").isEmpty():
        return fresh
    repeated = marked.where("__stays").select(*columns, F.coalesce(docs["text"], F.lit("")).alias("__text"))
    return fresh.unionByName(repeated.dropDuplicates(["doc_id", "__text"]).drop("__text"))

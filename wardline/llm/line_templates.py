"""Line deduplication by a log-template tree.

A line's path in the tree has a fixed depth: its number of tokens, then its first ``depth`` tokens, where tokens
with a digit count as the wildcard ``<*>``. The lines of a leaf share its template, the most frequent token of
each place over the leaf's distinct lines, if at least ``similarity`` of their tokens agree with it; the fields
in which they differ are thereby generalised. Other lines are templates of their own, and so are lines no longer than
the tree is deep: their path is the whole line. A template goes once ``evidence`` tokens of it were seen: in two
documents if it is long, in ``min_documents`` if it is short. Documents of equal text count once.

The usual parser assigns lines one by one, so its templates depend on their order and need a leaf's state in one
place. Here everything is an aggregate: no order, no state, and a hot leaf is counted before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store

DEPTH, SIMILARITY, MIN_DOCUMENTS, EVIDENCE = 3, 0.6, 10, 60
WILDCARD = "<*>"
# Leaves are 8 bytes each, so at most 8 MB are broadcast; more are joined by shuffle.
BROADCAST_LEAVES = 500_000


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _masked(text: Column) -> Column:
    """A text with the tokens of its lines joined by single blanks, those with a digit replaced by the wildcard."""
    flat = F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\r\f\x0B]{2,}|[\t\r\f\x0B]", " ")
    flat = F.replace(F.replace(flat, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))
    return F.regexp_replace(F.trim(flat), r"(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*+", WILDCARD)


def _body(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _needed(n: Column, min_documents: int, evidence: int) -> Column:
    """Documents that a template of ``n`` tokens must occur in: fewer for longer ones, two at least."""
    return F.greatest(F.lit(min(2, min_documents)), F.least(F.lit(min_documents), F.ceil(F.lit(evidence) / n)))


def recurring_lines(
    docs: DataFrame, *, depth: int = DEPTH, similarity: float = SIMILARITY, min_documents: int = MIN_DOCUMENTS, evidence: int = EVIDENCE,
) -> DataFrame:
    """``(doc_id, line_no)`` of the lines to drop, numbered from 0 in their text.

    Empty lines are never dropped. Rows of one id are one document, and so are rows of equal text; without an id,
    each text is a document of its own.
    """
    return _recurring(docs, depth, similarity, min_documents, evidence).select("doc_id", "line_no")


def _recurring(docs: DataFrame, depth: int, similarity: float, min_documents: int, evidence: int) -> DataFrame:
    """``(doc_id, body, line_no)`` of the lines to drop, by the hash of their whole text."""
    lines = docs.select("doc_id", _body(F.col("text")).alias("body"), F.posexplode(_lines(_masked(F.col("text")))).alias("line_no", "masked"))
    # Tokens are counted by the blanks between them.
    blanks = F.octet_length("masked") - F.octet_length(F.replace("masked", F.lit(" "), F.lit("")))
    lines = lines.where(F.col("masked") != "").withColumn("n", blanks + 1)
    # Texts are masked once; the masked lines are read again only for leaves that can recur.
    keys = store(lines.select(
        "doc_id", "body", "line_no", "n", F.xxhash64("n", F.substring_index("masked", " ", depth)).alias("leaf"),
        F.xxhash64("masked").alias("line"), "masked",
    ), compression="zstd")
    # A template is in no more documents than its leaf has lines, and in one only if these are lines of one text. All
    # lines of a leaf have the same length.
    leaves = keys.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("rows"), F.min("n").alias("n"), F.min("line").alias("line"), (F.min("line") != F.max("line")).alias("mixed"),
        (F.min("body") != F.max("body")).alias("texts"),
    ).withColumn("needed", _needed(F.col("n"), min_documents, evidence))
    leaves = store(leaves.where((F.col("rows") >= F.col("needed")) & (F.col("texts") | (F.col("needed") < 2))).select("leaf", "line", "mixed"))
    few = leaves.count() <= BROADCAST_LEAVES
    hot, mixed = (F.broadcast(x.select("leaf")) if few else x.select("leaf") for x in (leaves, leaves.where("mixed")))
    # A leaf's only line is its template; the others take a vote.
    distinct = keys.join(mixed, "leaf").groupBy("leaf", "line").agg(F.first("masked").alias("masked"), F.first("n").alias("n"))
    distinct = store(distinct).withColumn("tokens", F.split("masked", " ", -1)).drop("masked")
    votes = distinct.select("leaf", F.posexplode("tokens").alias("place", "token")).groupBy("leaf", "place", "token").agg(F.count(F.lit(1)).alias("votes"))
    top = votes.groupBy("leaf", "place").agg(F.min(F.struct((-F.col("votes")).alias("votes"), "token")).alias("top"))
    centre = top.groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("place", F.col("top.token").alias("token")))).alias("centre"))
    agree = F.aggregate(
        F.zip_with("tokens", "centre", lambda a, b: (a == b["token"]).cast("int")), F.lit(0), lambda n, x: n + x
    )
    assigned = distinct.join(centre, "leaf").select(
        "leaf", "line", F.when(agree >= similarity * F.col("n"), F.lit(None).cast("long")).otherwise(F.col("line")).alias("own")
    )
    assigned = store(assigned.unionByName(leaves.where("NOT mixed").select("leaf", "line", F.lit(None).cast("long").alias("own"))))
    # All copies of a text have the same lines, so its least id names it in each of its templates.
    texts = keys.join(hot, "leaf").join(assigned, ["leaf", "line"]).groupBy("leaf", "own", "body").agg(
        F.min("doc_id").alias("doc_id"), F.min("n").alias("n")
    )
    seen = texts.select("leaf", "own", "n", "doc_id", F.when(F.col("doc_id").isNull(), F.col("body")).alias("body")).distinct()
    recurring = seen.groupBy("leaf", "own").agg(F.count(F.lit(1)).alias("documents"), F.min("n").alias("n"))
    recurring = recurring.where(F.col("documents") >= _needed(F.col("n"), min_documents, evidence)).select("leaf", F.col("own").alias("__own"))
    dropped = assigned.join(recurring, "leaf").where(F.col("own").eqNullSafe(F.col("__own"))).select("leaf", "line")
    return keys.join(dropped, ["leaf", "line"]).select("doc_id", "body", "line_no")


def _without(lines: Column, gone: Column) -> Column:
    """``lines`` without those at the positions ``gone`` (ascending): the slices between them."""
    first = lambda k: F.when(k == 0, 0).otherwise(F.get(gone, k - 1) + 1)
    end = lambda k: F.coalesce(F.get(gone, k), F.size(lines))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), lambda k: F.slice(lines, first(k) + 1, end(k) - first(k))))


def drop_recurring_lines(
    docs: DataFrame, *, depth: int = DEPTH, similarity: float = SIMILARITY, min_documents: int = MIN_DOCUMENTS, evidence: int = EVIDENCE,
) -> DataFrame:
    """``(doc_id, text, n_lines, n_dropped)``: each text without its recurring lines, and how many it had and lost.

    Lines are what line feeds separate; the others stay as they are, joined by line feeds. A null text counts as
    empty and has one empty line. Each row loses the recurring lines of its own text, also if ids are null or
    repeated. Other columns are ignored; an empty table gives no rows.
    """
    gone = _recurring(docs, depth, similarity, min_documents, evidence).distinct()
    gone = gone.groupBy(F.col("doc_id").alias("__id"), F.col("body").alias("__body")).agg(F.sort_array(F.collect_list("line_no")).alias("__gone"))
    texts = docs.select("doc_id", "text", _body(F.col("text")).alias("body"))
    texts = texts.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("body") == F.col("__body")), "left")
    # Split behind the join, so that it moves texts and not their lines.
    lines = texts.withColumn("lines", _lines(F.col("text")))
    kept = F.when(F.col("__gone").isNull(), F.col("lines")).otherwise(_without(F.col("lines"), F.col("__gone")))
    return lines.withColumn("kept", kept).select(
        "doc_id", F.array_join("kept", "\n").alias("text"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
    )

"""Bins and histograms."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, store
from .intervals import nested_range_lookup
from .joins import attach
from .ordered import exact_quantiles, floor_lookup, ordered_counts

# Packet length edges and labels, score quartile labels.
PACKET_EDGES = (0, 64, 128, 256, 512, 1024, 2048, math.inf)
PACKET_LABELS = ("0-64", "64-128", "128-256", "256-512", "512-1024", "1024-2048", "2048+")
QUARTILE_LABELS = ("Low (0-25%)", "Medium (25-50%)", "High (50-75%)", "Critical (75-100%)")


def _col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def cut_fixed(
    col: Column | str, edges: Sequence[float] = PACKET_EDGES, labels: Sequence[str] = PACKET_LABELS
) -> Column:
    """Label of the right-closed bin; a value at or below the first edge has none."""
    c = _col(col)
    return F.coalesce(
        *[
            F.when((c > F.lit(float(lo))) & (c <= F.lit(float(hi))), F.lit(label))
            for lo, hi, label in zip(edges, edges[1:], labels)
        ]
    )


def cut_quartiles(
    df: DataFrame, col: str, labels: Sequence[str] = QUARTILE_LABELS, output: str = "quartile"
) -> DataFrame:
    """Label by exact quartiles; bins are right-closed and the minimum belongs to the first."""
    probs = (0.25, 0.5, 0.75)
    cuts = exact_quantiles(df, col, probs).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(f"q{i}") for i, p in enumerate(probs)]
    )
    c = _col(col)
    # The one-row result is a column first, so that the subquery appears once in the plan.
    return (
        df.withColumn("__cut", cuts.select(F.struct("q0", "q1", "q2")).scalar())
        .withColumn(
            output,
            F.when(c <= F.col("__cut.q0"), labels[0])
            .when(c <= F.col("__cut.q1"), labels[1])
            .when(c <= F.col("__cut.q2"), labels[2])
            .when(c.isNotNull(), labels[3]),
        )
        .drop("__cut")
    )


def bin_equal_width(df: DataFrame, train: DataFrame, col: str, n: int, prefix: str | None = None) -> DataFrame:
    """Equal-width bins from the whole-number range of ``train``; the first and last are open.

    The step is ``int(range / n)``, so a range that is not a multiple gives more than ``n`` bins. A
    range below ``n`` has no step and gives null. Adds ``{prefix}_lo``, ``{prefix}_hi`` (null at the
    open ends) and the label ``{col} classes``.
    """
    prefix = prefix or col
    bounds = train.agg(
        F.floor(F.min(_col(col))).cast("long").alias("lo"), F.ceil(F.max(_col(col))).cast("long").alias("hi")
    )
    width = F.floor((F.col("hi") - F.col("lo")) / F.lit(n)).cast("long")
    grid = bounds.select("lo", "hi", F.nullif(width, F.lit(0)).alias("step")).select(
        F.struct("lo", "step", F.ceil((F.col("hi") - F.col("lo")) / F.col("step")).cast("long").alias("bins"))
    )
    lo, step, bins = F.col("__grid.lo"), F.col("__grid.step"), F.col("__grid.bins")
    raw = F.col("__raw")
    # With a single bin the lower-open label wins and only values below its upper edge get it.
    index = F.greatest(F.least(raw, F.greatest(bins - 1, F.lit(0))), F.lit(0))
    single_above = (bins == 1) & (raw > 0)
    ix = F.when(~single_above & _col(col).isNotNull(), index)
    low = F.when(ix > 0, lo + ix * step)
    high = F.when((ix < bins - 1) | (ix == 0), lo + (ix + 1) * step)
    label = F.when(
        ix.isNotNull(),
        F.concat(
            F.lit("class : "),
            F.coalesce(low.cast("string"), F.lit("min")),
            F.lit(" - "),
            F.coalesce(high.cast("string"), F.lit("max")),
        ),
    )
    return (
        df.withColumn("__grid", grid.scalar())
        .withColumn("__raw", F.floor((_col(col) - lo) / step).cast("long"))
        .withColumns({f"{prefix}_lo": low, f"{prefix}_hi": high, f"{col} classes": label})
        .drop("__grid", "__raw")
    )


# --- bins with a minimum number of rows -----------------------------------------------------------


def min_count_bins(
    df: DataFrame, col: str, n_obs: int, chunk_rows: int = 1_000_000
) -> tuple[DataFrame, DataFrame]:
    """Greedy bins over the ordered values, each closed once it holds ``n_obs`` rows.

    Returns ``(col, lo, hi)`` per distinct value and ``(lo, hi, n)`` per bin. Equal values are never
    split; the last bin may be short.

    The next bin starts at the first value with at least ``n_obs`` rows before it since the start of
    the current one, so with prefix counts a bin start only has to know the row number its bin must
    reach. The value table is cut into chunks of ``chunk_rows`` rows. Each chunk is walked on its own
    task; what a chunk needs from the earlier ones is where the first bin starts in it. A chunk can
    only be entered within ``n_obs`` rows of its beginning, so the possible entries are few, every
    chunk reports for each of them where it would be left, and the real entries are found from the
    first value by pointer doubling over this small table (log2 of the number of chunks rounds).
    """
    chunk_rows = max(chunk_rows, n_obs)
    # n_before of a value is the row number at which the value starts.
    counts = ordered_counts(df.select(_col(col).alias("value")), "value").select(
        "value", "n", F.col("n_before").alias("start"),
        F.floor(F.col("n_before") / F.lit(chunk_rows)).cast("long").alias("chunk"),
    )
    total = counts.agg(F.sum("n")).first()[0] or 0
    chunks = max(1, math.ceil(total / chunk_rows))
    if chunks == 1:
        entered = counts.withColumn("entry", F.lit(0).cast("long"))
    else:
        counts = materialize(counts)
        entries = _chunk_entries(counts, n_obs, math.ceil(math.log2(chunks)) + 1)
        entered = counts.join(entries, "chunk", "left")
    walked = materialize(_walk_chunks(entered, n_obs))
    # Values before a chunk's first bin start belong to the last bin of an earlier chunk; one row
    # per chunk, so the window is small.
    last = walked.groupBy("chunk").agg(F.max("bin_start").alias("__last"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("chunk", F.max("__last").over(earlier).alias("__carried"))
    placed = walked.join(carried, "chunk").select(
        "value", "n", F.coalesce("bin_start", "__carried").alias("bin_start")
    )
    bins = placed.groupBy("bin_start").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum("n").alias("n")
    )
    by_value = placed.join(bins.drop("n"), "bin_start").select(F.col("value").alias(col), "lo", "hi")
    return store(by_value), bins.select("lo", "hi", "n")


def _walk_chunks(chunked: DataFrame, n_obs: int) -> DataFrame:
    """``(chunk, value, n, bin_start)``: bin start of every value at or after the chunk's entry."""
    value_type = chunked.schema["value"].dataType.simpleString()

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("start", kind="stable")
        starts = pdf["start"].to_numpy()
        out = np.full(len(starts), -1, dtype=np.int64)
        entry = pdf["entry"].iloc[0]
        i = len(starts) if pd.isna(entry) else int(np.searchsorted(starts, int(entry)))
        while i < len(starts):
            end = int(np.searchsorted(starts, starts[i] + n_obs))
            out[i:end] = starts[i]
            i = end
        result = pdf[["chunk", "value", "n"]].copy()
        result["bin_start"] = pd.Series(out, index=result.index).where(out >= 0).astype("Int64")
        return result

    return chunked.groupBy("chunk").applyInPandas(
        walk, f"chunk long, value {value_type}, n long, bin_start long"
    )


def _chunk_entries(counts: DataFrame, n_obs: int, rounds: int) -> DataFrame:
    """``(chunk, entry)``: the first bin start inside each chunk that has one."""

    def leave(pdf: pd.DataFrame) -> pd.DataFrame:
        starts = np.sort(pdf["start"].to_numpy())
        size = len(starts)
        # Position of the next bin start inside the chunk; the last one in the chunk stays where it is.
        step = np.searchsorted(starts, starts + n_obs)
        last = np.where(step < size, step, np.arange(size))
        while True:  # pointer doubling: as many rounds as the logarithm of the bins
            moved = last[last]
            if np.array_equal(moved, last):
                break
            last = moved
        candidates = min(size, int(np.searchsorted(starts, starts[0] + n_obs)) + 1)
        pick = np.arange(candidates)
        return pd.DataFrame(
            {
                "chunk": pdf["chunk"].iloc[0],
                "entry": starts[pick],
                "needs": starts[last[pick]] + n_obs,
            }
        )

    nodes = materialize(
        counts.select("chunk", "start").groupBy("chunk").applyInPandas(
            leave, "chunk long, entry long, needs long"
        )
    )
    # The next entry is the smallest candidate at or above `needs`: a floor lookup on negated numbers.
    up = floor_lookup(
        nodes.select((-F.col("needs")).alias("needs_neg")),
        "needs_neg",
        nodes.select((-F.col("entry")).alias("entry_neg")),
        "entry_neg",
    ).select((-F.col("needs_neg")).alias("needs"), (-F.col("entry_neg")).alias("next"))
    pointers = materialize(nodes.join(up, "needs").where("next IS NOT NULL").select("entry", "next"))
    reached = materialize(nodes.where("entry = 0").select("entry"))
    for _ in range(rounds):
        reached = materialize(
            reached.unionByName(reached.join(pointers, "entry").select(F.col("next").alias("entry"))).distinct()
        )
        onward = pointers.select(F.col("entry").alias("next"), F.col("next").alias("onward"))
        pointers = materialize(
            pointers.join(onward, "next").select("entry", F.col("onward").alias("next"))
        )
    return nodes.join(reached, "entry", "left_semi").select("chunk", "entry")


def bin_min_count(
    df: DataFrame, col: str, n_obs: int, prefix: str | None = None, chunk_rows: int = 1_000_000
) -> DataFrame:
    """Add ``{prefix}_lo``, ``{prefix}_hi`` and the label ``{col} classes`` to every row."""
    by_value, _ = min_count_bins(df, col, n_obs, chunk_rows)
    return attach_bins(df, by_value, col, prefix)


def attach_bins(df: DataFrame, by_value: DataFrame, col: str, prefix: str | None = None) -> DataFrame:
    """Bring stored ``(col, lo, hi)`` rows to every row with that value."""
    prefix = prefix or col
    label = bin_label(F.col("lo"), F.col("hi"))
    named = by_value.select(
        F.col(f"`{col}`"),
        F.col("lo").alias(f"{prefix}_lo"),
        F.col("hi").alias(f"{prefix}_hi"),
        label.alias(f"{col} classes"),
    )
    return attach(df, named, [col])


def bin_label(lo: Column, hi: Column) -> Column:
    return F.concat(F.lit("class : "), lo.cast("string"), F.lit(" - "), hi.cast("string"))


def bin_equal_count(df: DataFrame, col: str, n_classes: int, prefix: str | None = None) -> DataFrame:
    """Bins with nearly equal row counts: a value goes to the bin of its first row number.

    Only declared, not defined, in earlier tooling; the rule is ours: bin ``floor(k * before /
    total)`` with ``before`` the rows with a smaller value, so equal values share a bin.
    """
    prefix = prefix or col
    ranked = ordered_counts(df.select(col), col)
    number = F.floor(F.col("n_before") * F.lit(n_classes) / F.col("n_total")).cast("long")
    placed = ranked.select(col, number.alias("__bin"))
    bounds = placed.groupBy("__bin").agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    # At most n_classes rows.
    by_value = store(placed.join(F.broadcast(bounds), "__bin").select(col, "lo", "hi"))
    return attach_bins(df, by_value, col, prefix)


def assign_trained_bins(df: DataFrame, col: str, bins: DataFrame, output: str | None = None) -> DataFrame:
    """Give rows the trained bin ``(lo, hi)`` of their value.

    Inside a bin: that bin. Below all bins: the first. In a gap or above: the last. Null: none.
    Bins must not overlap. Distinct values are looked up once, then joined back. Values and bins of different
    numeric types are compared as doubles; ``lo``, ``hi`` and the label are those of the bins.
    """
    output, bins = output or col, store(bins.select("lo", "hi"))
    same = df.schema[col].dataType == bins.schema["lo"].dataType
    as_key = (lambda c: F.col(f"`{c}`")) if same else (lambda c: F.col(f"`{c}`").cast("double"))
    keyed = bins.select("lo", "hi", as_key("lo").alias("__lo"), as_key("hi").alias("__hi"))
    first, last = bins.orderBy("lo", "hi").first(), bins.orderBy(F.desc("lo"), F.desc("hi")).first()
    found = range_lookup(df.select(as_key(col).alias("__x")), "__x", keyed, "__lo", "__hi", ["lo", "hi"], disjoint=True)
    edge = lambda c, low, high: F.coalesce(F.col(c), F.when(F.col("__x") < F.lit(first["lo"]), low).otherwise(high)).alias(c)
    kind = bins.schema["lo"].dataType
    typed = lambda v: F.lit(v).cast(kind)
    resolved = store(found.select("__x", edge("lo", typed(first["lo"]), typed(last["lo"])), edge("hi", typed(first["hi"]), typed(last["hi"]))))
    out = attach_bins(df.withColumn("__x", as_key(col)), resolved, "__x", output).drop("__x")
    return out.withColumnRenamed("__x classes", f"{col} classes")


def range_lookup(
    values: DataFrame, col: str, ranges: DataFrame, lo: str, hi: str, payload: Sequence[str], *, disjoint: bool = False
) -> DataFrame:
    """For each distinct value the range ``[lo, hi]`` holding it: ``(col, lo, hi, payload...)``.

    A miss has nulls. Ranges may nest, touch and overlap: the narrowest one counts (see ``intervals``). Ranges that are
    known to be ``disjoint`` are looked up as they are: the greatest start not above the value is found by an
    ordered merge, then an equi join fetches the range. There is no comparison of all pairs.
    """
    if not disjoint:
        return nested_range_lookup(values, col, ranges, lo, hi, payload)
    stored = store(ranges.select(lo, hi, *payload))
    found = floor_lookup(values.select(col), col, stored, lo)
    # One wide range may hold most of the values.
    joined = attach(found, stored, [lo], spread_by=[col])
    hit = F.coalesce(F.col(col) <= F.col(hi), F.lit(False))
    return joined.select(col, *[F.when(hit, F.col(c)).alias(c) for c in (lo, hi, *payload)])


# --- histograms -------------------------------------------------------------------------------------


def _bounds(df: DataFrame, col: str):
    b = df.agg(F.min(_col(col)).cast("double").alias("lo"), F.max(_col(col)).cast("double").alias("hi"))
    return b.select(F.struct("lo", "hi")).scalar()


def histogram_bin(value: Column, lo: Column, hi: Column, n: int) -> Column:
    """1..n over [lo, hi] in equal steps, the last bin closed; a constant column is all bin 1."""
    inside = F.floor((value.cast("double") - lo) / F.nullif(hi - lo, F.lit(0.0)) * F.lit(n)).cast("long") + 1
    return F.when(value.isNotNull(), F.least(F.coalesce(inside, F.lit(1)), F.lit(n)))


def histogram(df: DataFrame, col: str, n: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., bin, n)`` counts of ``n`` equal-width bins over the range of the column."""
    rows = df.where(_col(col).isNotNull()).withColumn("__b", _bounds(df, col))
    number = histogram_bin(_col(col), F.col("__b.lo"), F.col("__b.hi"), n)
    return rows.groupBy(*by, number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def histogram_by_class(df: DataFrame, col: str, target: str, n: int = 200) -> DataFrame:
    return histogram(df, col, n, by=[target])


def bias_level_histogram(
    df: DataFrame, score: str, target: str, level_cols: Sequence[str], n: int = 20
) -> DataFrame:
    """Score histogram per class, bias column and level above 0."""
    levels = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("int").alias("level")) for c in level_cols]
    )
    rows = (
        df.select(target, score, F.inline(levels))
        .where((F.col("level") > 0) & F.col(score).isNotNull())
        .withColumn("__b", _bounds(df, score))
    )
    number = histogram_bin(F.col(score), F.col("__b.lo"), F.col("__b.hi"), n)
    return rows.groupBy(target, "feature", "level", number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))

"""Counts, shares, summaries and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.network import is_private_ip
from ..session import materialize, store
from .columns import label_encode
from .joins import attach
from .ordered import exact_quantiles, long_form, ordered_counts, quantiles_of_counts


def row_total(df: DataFrame):
    """Number of rows as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def value_counts(
    df: DataFrame, col: str, share: bool = False, labels: Mapping[object, str] | None = None
) -> DataFrame:
    """Rows per non-null value, most frequent first; ``share`` adds the percentage (2 digits)."""
    present = df.where(F.col(col).isNotNull())
    out = present.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    if share:
        out = share_of_total(out)
    if labels is not None:
        label = F.col("value").cast("string")
        for value, text in labels.items():
            label = F.when(F.col("value") == F.lit(value), F.lit(text)).otherwise(label)
        out = out.withColumn("label", label)
    return out.orderBy(F.desc("n"), "value")


def value_counts_null_sorted(df: DataFrame, col: str, target: str) -> DataFrame:
    """Counts with null kept, ordered by value: over all rows (``class`` null) and per class."""
    counted = (
        df.where(F.col(target).isNotNull())
        .select(F.col(col).alias("value"), F.col(target).alias("class"))
        .rollup("value", "class")
        .agg(F.count(F.lit(1)).alias("n"), F.grouping("value").alias("all_values"))
    )
    return counted.where("all_values = 0").drop("all_values").orderBy("value", "class")


def group_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value).alias("mean"))


def _per_column(df: DataFrame, cols: Sequence[str], statistics) -> DataFrame:
    """``(feature, ...)`` with the named aggregates of each column as a double, in one plain aggregate. NaN counts as
    missing."""
    number = lambda c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double"))
    rows = [F.struct(F.lit(c).alias("feature"), *[a.alias(n) for n, a in statistics(number(c)).items()]) for c in cols]
    return df.agg(F.array(*rows).alias("s")).select(F.inline("s"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: count, mean, std, min, exact quartiles and max; null and NaN are missing values."""
    number = F.col("value").cast("double")
    values = long_form(df, cols).select("feature", F.when(~F.isnan(number), number).alias("value"))
    ranked = ordered_counts(values, "value", by=["feature"])
    quartiles = (
        quantiles_of_counts(ranked, "value", [0.25, 0.5, 0.75], by=["feature"])
        .groupBy("feature")
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
               for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    )
    basics = _per_column(
        df, cols, lambda x: {"n": F.count(x), "mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x), "max": F.max(x)}
    )
    return basics.join(quartiles, "feature", "left").select(
        "feature", "n", "mean", "std", "min", "q1", "median", "q3", "max"
    )


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Per column: nulls, their percentage, distinct values, their percentage; most nulls first."""
    cols = list(cols or df.columns)
    if approx:
        per_column = F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    F.sum(F.col(f"`{c}`").isNull().cast("long")).alias("nulls"),
                    F.approx_count_distinct(f"`{c}`").alias("distinct_values"),
                    F.count(F.lit(1)).alias("rows"),
                )
                for c in cols
            ]
        )
        stats = df.agg(per_column.alias("s")).select(F.inline("s"))
    else:
        # Value counts first: the exact distinct count then needs no per-column expansion.
        counts = long_form(df, cols).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        stats = counts.groupBy("feature").agg(
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
            F.count("value").alias("distinct_values"),
            F.sum("n").alias("rows"),
        )
    return stats.select(
        "feature",
        "nulls",
        (F.col("nulls") * 100.0 / F.col("rows")).alias("null_pct"),
        "distinct_values",
        (F.col("distinct_values") * 100.0 / F.col("rows")).alias("distinct_pct"),
    ).orderBy(F.desc("nulls"), "feature")


def date_range(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def quantile_thresholds(df: DataFrame, col: str, probs: Sequence[float] = (0.95, 0.99)) -> DataFrame:
    return exact_quantiles(df, col, probs)


def encoding_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and standard deviation per encoded column."""
    return _per_column(df, cols, lambda x: {"mean": F.avg(x), "std": F.stddev_samp(x)})


def flag_totals(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    return df.agg(*[F.sum(f"`{f}`").cast("long").alias(f) for f in flags])


def grouped_flags(df: DataFrame, target: str, flags: Sequence[str]) -> DataFrame:
    """Per class and flag: number set and percentage set."""
    aggs = []
    for f in flags:
        bit = F.col(f"`{f}`").cast("int")
        aggs += [F.sum(bit).cast("long").alias(f"{f}_count"), (F.avg(bit) * 100).alias(f"{f}_pct")]
    return df.groupBy(target).agg(*aggs)


def private_ip_stats(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Rows with a private source, a private destination, either; percentages of all rows."""
    s, d = is_private_ip(src), is_private_ip(dst)
    pct = lambda flag: (F.avg(flag.cast("int")) * 100)
    return df.agg(
        F.count_if(s).alias("private_src"),
        pct(s).alias("private_src_pct"),
        F.count_if(d).alias("private_dst"),
        pct(d).alias("private_dst_pct"),
        F.count_if(s | d).alias("private_any"),
    )


def location_stats(df: DataFrame, col: str) -> DataFrame:
    return df.agg(
        F.count_distinct(col).alias("locations"), F.count_if(F.col(col).isNull()).alias("missing")
    )


def class_rate_report(df: DataFrame, target: str, flag: str) -> DataFrame:
    """Per class: rows, rows with the flag and without, both also in percent."""
    with_flag = F.sum(F.col(flag).cast("int")).cast("long")
    return (
        df.groupBy(target)
        .agg(F.count(F.lit(1)).alias("total"), with_flag.alias("with_flag"))
        .select(
            target,
            "total",
            "with_flag",
            (F.col("with_flag") * 100.0 / F.col("total")).alias("with_pct"),
            (F.col("total") - F.col("with_flag")).alias("without_flag"),
            (100.0 - F.col("with_flag") * 100.0 / F.col("total")).alias("without_pct"),
        )
    )


def rate_over_time(df: DataFrame, ts: str, flag: str) -> DataFrame:
    """Per day: rows, rows with the flag, percentage."""
    bit = F.col(flag).cast("int")
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(F.to_date(ts).alias("day"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(bit).cast("long").alias("with_flag"),
            (F.avg(bit) * 100).alias("pct"),
        )
    )


def fan_out(df: DataFrame, src: str, dst: str, approx: bool = False) -> DataFrame:
    """Distinct destinations per source, in no order. ``approx`` trades exactness for one pass."""
    count = F.approx_count_distinct(dst) if approx else F.count_distinct(dst)
    return (
        df.where(F.col(src).isNotNull())
        .groupBy(F.col(src).alias("key"))
        .agg(count.alias("degree"))
    )


def fan_in(df: DataFrame, src: str, dst: str, approx: bool = False) -> DataFrame:
    """Distinct sources per destination."""
    return fan_out(df, dst, src, approx)


def fan_threshold_report(degrees: DataFrame) -> DataFrame:
    """Mean, median, p95 and p99 of the degrees; keys strictly above p95 and p99 and their share."""
    ranked = ordered_counts(degrees, "degree")
    cuts = quantiles_of_counts(ranked, "degree", [0.5, 0.95, 0.99]).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
          for p, n in ((0.5, "median"), (0.95, "p95"), (0.99, "p99"))]
    )
    cut = cuts.select(F.struct("median", "p95", "p99")).scalar()
    n = F.col("n")
    return (
        ranked.withColumn("cut", cut)
        .agg(
            (F.sum(n * F.col("degree")) / F.sum(n)).alias("mean"),
            F.max("cut.median").alias("median"),
            F.max("cut.p95").alias("p95"),
            F.max("cut.p99").alias("p99"),
            F.sum(F.when(F.col("degree") > F.col("cut.p95"), n).otherwise(0)).alias("above_p95"),
            F.sum(F.when(F.col("degree") > F.col("cut.p99"), n).otherwise(0)).alias("above_p99"),
            F.sum(n).alias("keys"),
        )
        .withColumn("above_p95_pct", F.col("above_p95") * 100.0 / F.col("keys"))
        .withColumn("above_p99_pct", F.col("above_p99") * 100.0 / F.col("keys"))
    )


def suspicious_ips(degrees: DataFrame, prob: float = 0.95) -> DataFrame:
    """Keys whose degree is strictly above the quantile."""
    degrees = materialize(degrees)  # read for the quantile and for the filter
    cut = exact_quantiles(degrees, "degree", [prob]).select("quantile").scalar()
    return degrees.where(F.col("degree") > cut)


def ip_stats(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Distinct sources and destinations, rows, mean rows per source and per destination."""
    return df.agg(
        F.count_distinct(src).alias("sources"),
        F.count_distinct(dst).alias("destinations"),
        F.count(F.lit(1)).alias("connections"),
    ).select(
        "*",
        (F.col("connections") / F.col("sources")).alias("per_source"),
        (F.col("connections") / F.col("destinations")).alias("per_destination"),
    )


def daily_modes(df: DataFrame, ts: str, cols: Sequence[str]) -> DataFrame:
    """``(day, feature, value, n)``: most frequent value per day and column, in one pass.

    Ties go to the value more frequent overall, then to the smaller one (numbers by size, text by
    alphabet).
    """
    counts = materialize(
        long_form(df.withColumn("__day", F.to_date(ts)), cols, keep=["__day"])
        .where(F.col("value").isNotNull())
        .groupBy(F.col("__day").alias("day"), "feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    overall = counts.groupBy("feature", "value").agg(F.sum("n").alias("overall"))
    # A minimum over a struct combines before the shuffle; a ranking window would not.
    best = F.min(
        F.struct(
            (-F.col("n")).alias("n"), (-F.col("overall")).alias("o"),
            F.col("value").try_cast("double").alias("size"), F.col("value").alias("value"),
        )
    )
    return (
        counts.where(F.col("day").isNotNull())
        .join(overall, ["feature", "value"])
        .groupBy("day", "feature")
        .agg(best.alias("best"))
        .select("day", "feature", F.col("best.value").alias("value"), (-F.col("best.n")).alias("n"))
    )


def daily_mode(df: DataFrame, ts: str, cols: Sequence[str]) -> DataFrame:
    """Add ``"{col} max n d"`` holding ``"{ value }"``, the most frequent value of the row's day."""

    def label(c: str):
        value = F.max(F.when(F.col("feature") == c, F.col("value")))
        return F.concat(F.lit("{ "), value, F.lit(" }")).alias(f"{c} max n d")

    per_day = store(daily_modes(df, ts, cols).groupBy("day").agg(*[label(c) for c in cols]))
    dim = per_day.withColumnRenamed("day", "__day")
    return attach(df.withColumn("__day", F.to_date(ts)), dim, ["__day"]).drop("__day")


def mode_all_ties(df: DataFrame, ts: str, col: str) -> DataFrame:
    """``(day, label)``: all values tied for the most rows of the day, ``"{ a + b }"``.

    The label lists every tied category, so it is meant for columns with few of them.
    """
    counts = (
        df.where(F.col(ts).isNotNull() & F.col(col).isNotNull())
        .groupBy(F.to_date(ts).alias("day"), F.col(col).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = materialize(counts)
    top = store(counts.groupBy("day").agg(F.max("n").alias("most")))
    names = F.concat_ws(" + ", F.array_sort(F.collect_list("value")))
    return (
        attach(counts, top, ["day"])
        .where("n = most")
        .groupBy("day")
        .agg(F.concat(F.lit("{ "), names, F.lit(" }")).alias("label"))
    )


def top_value_per_class(df: DataFrame, target: str, col: str) -> DataFrame:
    """Most frequent value per class with its count; ties to the smaller value."""
    counts = (
        df.where(F.col(col).isNotNull())
        .groupBy(target, F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("value")))
    return counts.groupBy(target).agg(best.alias("b")).select(
        target, F.col("b.value").alias("value"), (-F.col("b.n")).alias("n")
    )


def pivot_daily(df: DataFrame, ts: str, col: str, values: Sequence[object] | None = None) -> DataFrame:
    """Day by category counts: a zero-filled column for each of ``values``, or without them one row
    ``(day, value, n)`` for each value that a day has, however many values there are."""
    rows = df.where(F.col(ts).isNotNull() & F.col(col).isNotNull())
    if values is None:
        return rows.groupBy(F.to_date(ts).alias("day"), F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return (
        rows.groupBy(F.to_date(ts).alias("day"))
        .agg(*[F.count_if(F.col(col) == F.lit(v)).alias(str(v)) for v in values])
    )


def box_stats(df: DataFrame, value: str, target: str) -> DataFrame:
    """Per class: quartiles, whisker ends inside 1.5 IQR and the number of points outside."""
    ranked = ordered_counts(df.select(target, value), value, by=[target])
    quartiles = (
        quantiles_of_counts(ranked, value, [0.25, 0.5, 0.75], by=[target])
        .groupBy(target)
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
               for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
        .withColumn("low", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")))
        .withColumn("high", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    )
    inside = F.col(value).between(F.col("low"), F.col("high"))
    return (
        attach(ranked, store(quartiles), [target])
        .groupBy(target, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("n"))).cast("long").alias("outliers"),
        )
    )


def strip_points(df: DataFrame, value: str, target: str) -> DataFrame:
    """``(class_rank, class, value, n_class)`` per row; classes rank by name from 0."""
    sizes = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n_class"))
    # Codes of the distinct classes, which are stored and joined like any lookup.
    ranked, _ = label_encode(store(sizes), target, "class_rank")
    return attach(df.where(F.col(target).isNotNull()), store(ranked), [target]).select(
        "class_rank", F.col(target).alias("class"), F.col(value).alias("value"), "n_class"
    )


def geo_points(
    df: DataFrame, target: str, score: str, sides: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Map points ``(side, class, lat, lon, score, min_score, max_score)``; the score range is that
    of the class over rows with coordinates on that side."""
    pairs = F.array(
        *[
            F.struct(F.lit(s).alias("side"), F.col(lat).alias("lat"), F.col(lon).alias("lon"))
            for s, (lat, lon) in sides.items()
        ]
    )
    points = df.select(F.col(target).alias("class"), F.col(score).alias("score"), F.inline(pairs)).where(
        F.col("lat").isNotNull() & F.col("lon").isNotNull()
    )
    ranges = points.groupBy("side", "class").agg(
        F.min("score").alias("min_score"), F.max("score").alias("max_score")
    )
    return attach(points.dropna(subset=["class"]), store(ranges), ["side", "class"])


def dataset_summary(df: DataFrame, roles: Mapping[str, str]) -> DataFrame:
    """Report ``(metric, name, value)``: rows, class shares, proxy rate, distinct endpoints, mean
    length, most common protocol and its share, most targeted port and its count.

    ``roles`` names the columns ``target, proxy, src, dst, length, protocol, dst_port``.
    """
    r = roles
    base = df.agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        (F.avg(F.col(r["proxy"]).isNotNull().cast("int")) * 100).alias("proxy_rate"),
        F.count_distinct(r["src"]).cast("double").alias("sources"),
        F.count_distinct(r["dst"]).cast("double").alias("destinations"),
        F.avg(r["length"]).alias("mean_length"),
    ).unpivot([], ["rows", "proxy_rate", "sources", "destinations", "mean_length"], "metric", "value")
    total = row_total(df)
    counts = (
        long_form(df, [r["target"], r["protocol"], r["dst_port"]])
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    classes = counts.where(F.col("feature") == r["target"]).select(
        F.lit("class_share").alias("metric"), F.col("value").alias("name"),
        (F.col("n") * 100.0 / total).alias("value"),
    )
    top = (
        counts.where(F.col("feature") != r["target"])
        .groupBy("feature")
        .agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("value"))).alias("b"))
    )
    is_port = F.col("feature") == r["dst_port"]
    tops = top.select(
        F.when(is_port, "top_port").otherwise("top_protocol").alias("metric"),
        F.col("b.value").alias("name"),
        F.when(is_port, (-F.col("b.n")).cast("double")).otherwise(-F.col("b.n") * 100.0 / total).alias("value"),
    )
    return base.select("metric", F.lit("").alias("name"), "value").unionByName(classes).unionByName(tops)


def top_k(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k most frequent non-null values; ties by value."""
    return value_counts(df, col).limit(k)


def top_k_other(df: DataFrame, col: str, n: int, other: str = "other", output: str | None = None) -> DataFrame:
    """Keep the n most frequent categories, replace the rest by ``other``; nulls stay null."""
    top = top_k(df.select(col), col, n).select(F.col("value").alias("__top"))
    joined = df.join(F.broadcast(top), F.col(col) == F.col("__top"), "left")  # n rows
    kept = F.when(F.col(col).isNull() | F.col("__top").isNotNull(), F.col(col).cast("string"))
    return joined.withColumn(output or col, kept.otherwise(F.lit(other))).drop("__top")


def share_of_total(counts: DataFrame, n: str = "n", digits: int = 2) -> DataFrame:
    """Percentage of the column total. The total reuses the shuffle of the counts, not the rows."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn("share", F.round(F.col(n) * 100.0 / total, digits))

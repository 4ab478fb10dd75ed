"""Cross tabulations of categories against a class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import class_labels
from .profile import row_total

N_OBS, PCT_OBS = "n obs", "% obs"


def crosstab_name(cols: Sequence[str]) -> str:
    """``col`` for one column, ``{ a , b }`` for several."""
    return cols[0] if len(cols) == 1 else "{ " + " , ".join(cols) + " }"


def _keys(df: DataFrame, cols: Sequence[str], null_key: str | None):
    """Key expressions, and the rows that have a key."""
    if null_key is None:
        return df.dropna(subset=list(cols)), [F.col(f"`{c}`") for c in cols]
    return df, [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null_key)).alias(c) for c in cols]


def crosstab_margins(
    df: DataFrame,
    cols: Sequence[str],
    target: str,
    classes: Sequence[object] | None = None,
    null_key: str | None = None,
) -> DataFrame:
    """Counts per key and class plus the row margin ``n obs``.

    One hash aggregate with map-side combine. Null keys are dropped, or counted under the name
    ``null_key``; rows without a class are always dropped.
    """
    classes = list(classes) if classes is not None else class_labels(df, target)
    rows, keys = _keys(df.where(F.col(f"`{target}`").isNotNull()), cols, null_key)
    return rows.groupBy(*keys).agg(
        *[F.count_if(F.col(f"`{target}`") == F.lit(c)).alias(str(c)) for c in classes],
        F.count(F.lit(1)).alias(N_OBS),
    )


def crosstab_counts(
    df: DataFrame, row: str, target: str, classes: Sequence[object] | None = None
) -> DataFrame:
    """Category by class counts."""
    return crosstab_margins(df, [row], target, classes).drop(N_OBS)


def crosstab_row_pct(
    df: DataFrame,
    row: str,
    target: str,
    digits: int | None = None,
    classes: Sequence[object] | None = None,
) -> DataFrame:
    """Percentages by class; every row sums to 100."""
    classes = list(classes) if classes is not None else class_labels(df, target)
    counts = crosstab_margins(df, [row], target, classes)

    def pct(c):
        value = F.col(f"`{c}`") * 100.0 / F.col(f"`{N_OBS}`")
        return (value if digits is None else F.round(value, digits)).alias(str(c))

    return counts.select(row, *[pct(c) for c in classes])


def crosstab_grand_pct(
    df: DataFrame, rows: Sequence[str], target: str, classes: Sequence[object] | None = None
) -> DataFrame:
    """Cells in percent of the grand total."""
    classes = list(classes) if classes is not None else class_labels(df, target)
    counts = crosstab_margins(df, rows, target, classes)
    total = counts.agg(F.sum(f"`{N_OBS}`")).scalar()
    return counts.select(
        *[F.col(f"`{c}`") for c in rows],
        *[(F.col(f"`{c}`") * 100.0 / total).alias(str(c)) for c in classes],
    )


def crosstab_bias(
    df: DataFrame,
    cols: Sequence[str],
    target: str,
    *,
    classes: Sequence[object] | None = None,
    null_key: str | None = None,
    pct_denominator: str = "rows",
) -> DataFrame:
    """Share of each class per key, with ``n obs`` and ``% obs``.

    ``% obs`` is the share of all rows in percent for ``pct_denominator="rows"``; ``"columns"``
    gives ``n obs`` over the number of columns of ``df``, the historical definition.
    """
    classes = list(classes) if classes is not None else class_labels(df, target)
    counts = crosstab_margins(df, cols, target, classes, null_key)
    n = F.col(f"`{N_OBS}`")
    if pct_denominator == "columns":
        pct_obs = n / F.lit(len(df.columns))
    elif pct_denominator == "rows":
        pct_obs = n * 100.0 / row_total(df)
    else:
        raise ValueError("pct_denominator must be 'rows' or 'columns'")
    return counts.select(
        *[F.col(f"`{c}`") for c in cols],
        *[(F.col(f"`{c}`") * 100.0 / n).alias(str(c)) for c in classes],
        n,
        pct_obs.alias(PCT_OBS),
    )


def crosstab_bias_sets(
    df: DataFrame, key_sets: Sequence[Sequence[str]], target: str, *, classes: Sequence[object], null_key: str | None = None,
) -> DataFrame:
    """``crosstab_bias`` of every key tuple in ``key_sets`` by one aggregate over grouping sets.

    ``set_no`` is the tuple's position; key columns that it lacks are null. At most 64 different key columns.
    """
    columns = list(dict.fromkeys(c for keys in key_sets for c in keys))
    aliases = {c: f"__k{i}" for i, c in enumerate(columns)}
    rows = df.where(F.col(f"`{target}`").isNotNull()).select(
        F.col(f"`{target}`").alias("__class"),
        *[(F.col(f"`{c}`") if null_key is None else F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null_key))).alias(a) for c, a in aliases.items()],
    )
    counts = rows.groupingSets([[F.col(aliases[c]) for c in keys] for keys in key_sets], *[F.col(a) for a in aliases.values()]).agg(
        F.grouping_id().alias("__gid"),
        *[F.count_if(F.col("__class") == F.lit(c)).alias(f"__n{i}") for i, c in enumerate(classes)],
        F.count(F.lit(1)).alias("__n"),
    )
    # The leftmost column has the highest bit, which is set where a tuple lacks the column.
    set_no, whole = F.lit(None).cast("int"), F.lit(True)
    for number, keys in enumerate(key_sets):
        bits = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)
        here = F.col("__gid") == F.lit(bits)
        set_no = F.when(here, F.lit(number)).otherwise(set_no)
        for c in keys:
            # Null keys are dropped, as in a crosstab of its own.
            whole = whole & (~here | F.col(aliases[c]).isNotNull())
    n = F.col("__n")
    return counts.where(whole).select(
        set_no.alias("set_no"), *[F.col(a).alias(c) for c, a in aliases.items()],
        *[(F.col(f"__n{i}") * 100.0 / n).alias(str(c)) for i, c in enumerate(classes)],
        n.alias(N_OBS), (n * 100.0 / row_total(df)).alias(PCT_OBS),
    )

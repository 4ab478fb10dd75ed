"""Bias levels: how strongly a category combination leans towards a class."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.encoding import dynamic_threshold
from ..session import store, store_by
from .binning import assign_trained_bins, attach_bins, min_count_bins
from .columns import class_labels
from .crosstab import N_OBS, PCT_OBS, crosstab_bias_sets, crosstab_name
from .joins import attach

# Level limits in ascending order, and the order in which earlier tooling applied them
# (an unordered set, the last limit passed wins).
TIERS = (37.5, 40.0, 50.0, 60.0, 75.0, 90.0)
UNORDERED_TIERS = (37.5, 40.0, 75.0, 50.0, 90.0, 60.0)
# Two points of the required-percentage line, and rows per bin.
THRESHOLD_PARS = (5, 100, 10, 37.5)


def tier_level(pct: Column, n: Column, tiers: Sequence[float] = TIERS, pars=THRESHOLD_PARS, floor=None) -> Column:
    """1-based position of the last tier reached, 0 when none is or ``pct`` is below the line."""
    reached = [F.when(pct >= F.lit(float(t)), F.lit(i)).otherwise(F.lit(0)) for i, t in enumerate(tiers, 1)]
    level = F.greatest(*reached) if len(reached) > 1 else reached[0]
    return F.when(pct >= dynamic_threshold(n, pars, floor), level).otherwise(F.lit(0)).cast("byte")


def bias_column(name: str, cls: object) -> str:
    return f"{name} , bias {cls}"


def level_table(
    crosstab: DataFrame, keys: Sequence[str], classes: Sequence[object], *, tiers=TIERS, pars=THRESHOLD_PARS,
    floor: float | None = None, name: str | None = None,
) -> DataFrame:
    """Keys and one level per class, only keys with some level above 0."""
    name = name or crosstab_name(keys)
    n = F.col(f"`{N_OBS}`")
    levels = {bias_column(name, c): tier_level(F.col(f"`{c}`"), n, tiers, pars, floor) for c in classes}
    out = crosstab.select(
        *[F.col(f"`{k}`") for k in keys], *[level.alias(col) for col, level in levels.items()]
    )
    some = [F.col(f"`{c}`") > 0 for c in levels]
    any_level = some[0]
    for s in some[1:]:
        any_level = any_level | s
    return out.where(any_level)


def bias_levels(
    df: DataFrame,
    keys: Sequence[str],
    crosstab: DataFrame,
    classes: Sequence[object],
    *,
    tiers: Sequence[float] = TIERS,
    pars: Sequence[float] = THRESHOLD_PARS,
    floor: float | None = None,
    name: str | None = None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Add ``"{name} , bias {class}"`` per class: the level of the row's key combination, else 0."""
    name = name or crosstab_name(keys)
    levels = store(level_table(crosstab, keys, classes, tiers=tiers, pars=pars, floor=floor, name=name))
    out = attach(df, levels, keys, spread_by=spread_by)
    return out.withColumns(
        {
            (b := bias_column(name, c)): F.coalesce(F.col(f"`{b}`"), F.lit(0).cast("byte"))
            for c in classes
        }
    )


def crosstab_scores(
    df: DataFrame,
    keys: Sequence[str],
    crosstab: DataFrame,
    classes: Sequence[object],
    *,
    tiers: Sequence[float] = TIERS,
    pars: Sequence[float] = THRESHOLD_PARS,
    floor: float | None = None,
    outputs: Sequence[str] | None = None,
    null_key: str | None = None,
) -> DataFrame:
    """Level of each class for new rows from a stored crosstab; unknown keys score 0.

    Keys are compared as text on both sides, so a stored text key meets a numeric column. A null key is looked up
    under ``null_key``, if the crosstab was made with one.
    """
    outputs = list(outputs or [bias_column(crosstab_name(keys), c) for c in classes])
    named = [f"__k{i}" for i in range(len(keys))]
    n = F.col(f"`{N_OBS}`")
    dim = crosstab.select(
        *[F.col(f"`{k}`").cast("string").alias(a) for k, a in zip(keys, named)],
        *[tier_level(F.col(f"`{c}`"), n, tiers, pars, floor).alias(o) for c, o in zip(classes, outputs)],
    )
    text = lambda k: F.col(f"`{k}`").cast("string")
    keyed = df.withColumns({a: text(k) if null_key is None else F.coalesce(text(k), F.lit(null_key)) for k, a in zip(keys, named)})
    return (
        attach(keyed, dim, named)
        .withColumns({o: F.coalesce(F.col(f"`{o}`"), F.lit(0).cast("byte")) for o in outputs})
        .drop(*named)
    )


def crosstab_score(
    df: DataFrame, keys: Sequence[str], crosstab: DataFrame, target_class: object, *,
    output: str | None = None, **settings,
) -> DataFrame:
    """Level of one class."""
    outputs = [output] if output else None
    return crosstab_scores(df, keys, crosstab, [target_class], outputs=outputs, **settings)


def score_stream(
    stream: DataFrame, keys: Sequence[str], read_crosstab: Callable[[], DataFrame], target_class: object,
    write: Callable[[DataFrame, int], None], **settings,
) -> DataStreamWriter:
    """A writer, to be given a checkpoint and started, that scores every micro-batch of ``stream`` by ``crosstab_score``.

    ``read_crosstab`` is called anew for each micro-batch, so that it is scored by the crosstab as stored then; ``write`` gets the
    scored rows and the batch's number, which comes again if a batch is repeated after a failure.
    """

    def one_batch(rows: DataFrame, number: int) -> None:
        write(crosstab_score(rows, keys, read_crosstab(), target_class, **settings), number)

    return stream.writeStream.foreachBatch(one_batch)


@dataclass(frozen=True)
class BiasGroup:
    """One crosstab: the columns to bin first and the key columns as they are."""

    name: str
    binned: Sequence[str] = ()
    keys: Sequence[str] = ()

    @property
    def key_columns(self) -> list[str]:
        # A column listed twice counts once.
        return list(dict.fromkeys([*[f"{c} classes" for c in self.binned], *self.keys]))


_ALERTS = (
    "Malware Indicators", "Alert Trigger", "Action Taken", "Severity Level",
    "Log Source Firewall", "Firewall Logs", "IDS/IPS Alerts",
)
_DEVICE = ("Browser family", "OS family", "Device type")

# The nine feature groups and the columns of their crosstabs.
BIAS_GROUPS = (
    BiasGroup("ports", binned=("Source Port",)),
    BiasGroup("ports", binned=("Destination Port",)),
    BiasGroup("coordinates", binned=("Source IP longitude", "Source IP latitude"), keys=_ALERTS),
    BiasGroup("coordinates", binned=("Destination IP longitude", "Destination IP latitude"), keys=_ALERTS),
    BiasGroup("countries", keys=("Source IP country", "Destination IP country")),
    BiasGroup("day", keys=("date dd",)),
    BiasGroup(
        "network",
        keys=(
            "Protocol", "Packet Type Control", "Traffic Type", "Attack Signature patA",
            "Network Segment", "Proxy usage", *_DEVICE,
        ),
    ),
    BiasGroup("security", keys=(*_ALERTS, *_DEVICE)),
    BiasGroup("time", keys=("date MW", "date WD", "date H", "date M")),
    BiasGroup("score", binned=("Anomaly Scores",)),
    BiasGroup("length", binned=("Packet Length",)),
)


# The seven groups that need no geolocation, on the columns of ``serving_preprocess``;
# models that score raw rows are trained on these.
RAW_ROW_GROUPS = (
    *[g for g in BIAS_GROUPS if g.name in ("ports", "score", "length", "day")],
    BiasGroup(
        "network",
        keys=(
            "Protocol", "Packet Type", "Traffic Type", "Attack Signature patA",
            "Network Segment", "Proxy usage", *_DEVICE,
        ),
    ),
    *[g for g in BIAS_GROUPS if g.name in ("security", "time")],
)


@dataclass
class BiasModel:
    """Everything fitted: bins per column, crosstab per group, classes and settings."""

    classes: list
    groups: list[BiasGroup]
    bins: dict[str, DataFrame] = field(default_factory=dict)
    crosstabs: dict[str, DataFrame] = field(default_factory=dict)
    tiers: Sequence[float] = TIERS
    pars: Sequence[float] = THRESHOLD_PARS
    floor: float | None = None
    null_key: str | None = None

    @property
    def feature_columns(self) -> list[str]:
        return [bias_column(crosstab_name(g.key_columns), c) for g in self.groups for c in self.classes]


def fit_bias_features(
    df: DataFrame,
    target: str,
    groups: Sequence[BiasGroup] = BIAS_GROUPS,
    *,
    n_obs: int = 15,
    only: Sequence[str] | None = None,
    tiers: Sequence[float] = TIERS,
    pars: Sequence[float] = THRESHOLD_PARS,
    floor: float | None = None,
    null_key: str | None = None,
) -> tuple[DataFrame, BiasModel]:
    """Bins and crosstabs from ``df``, and ``df`` with the bias columns of the chosen groups.

    ``only`` picks groups by name. Fit on training rows and use ``apply_bias_features`` for others;
    fitting on all rows leaks the class into the features.
    """
    chosen = [g for g in groups if only is None or g.name in only]
    model = BiasModel([], chosen, tiers=tiers, pars=pars, floor=floor, null_key=null_key)
    settings = {"tiers": tiers, "pars": pars, "floor": floor}
    needed = dict.fromkeys(c for g in chosen for c in (*g.binned, *g.keys))
    # Every bin and crosstab reads the rows once, each only its own columns of this copy.
    base = store(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*needed, target])]))
    model.classes = class_labels(base, target)
    by_value: dict[str, DataFrame] = {}
    for c in dict.fromkeys(c for g in chosen for c in g.binned):
        by_value[c], bins = min_count_bins(base, c, n_obs)
        model.bins[c] = store(bins)
    rows, out = base, df
    for c, values in by_value.items():
        rows, out = attach_bins(rows, values, c), attach_bins(out, values, c)
    sets = {crosstab_name(g.key_columns): g.key_columns for g in chosen}
    # One aggregate and one write for the crosstabs of all groups, and one write for their levels.
    tables = crosstab_bias_sets(store(rows), list(sets.values()), target, classes=model.classes, null_key=null_key)
    stored = store_by(tables, "set_no")
    empty = tables.drop("set_no").limit(0)
    levels = [tier_level(F.col(f"`{c}`"), F.col(f"`{N_OBS}`"), **settings) for c in model.classes]
    named = [f"__level{i}" for i in range(len(levels))]
    reached = None
    for number, keys in enumerate(sets.values()):
        one = stored.get(number, empty).select(F.lit(number).alias("set_no"), "*", *[x.alias(a) for x, a in zip(levels, named)])
        reached = one if reached is None else reached.unionByName(one)
    some = F.greatest(*[F.col(a) for a in named], F.lit(0).cast("byte"), F.lit(0).cast("byte")) > 0
    lookups = store_by(reached.where(some).drop(*map(str, model.classes), N_OBS, PCT_OBS), "set_no") if chosen else {}
    for number, (name, keys) in enumerate(sets.items()):
        cells = [bias_column(name, c) for c in model.classes]
        columns = [F.col(f"`{k}`") for k in keys]
        model.crosstabs[name] = stored.get(number, empty).select(
            *columns, *[F.col(f"`{c}`") for c in model.classes], F.col(f"`{N_OBS}`"), F.col(f"`{PCT_OBS}`")
        )
        if number not in lookups:
            out = out.withColumns({cell: F.lit(0).cast("byte") for cell in cells})
            continue
        # Where the crosstab counts nulls under a name, the rows look it up under it.
        by = {k: k if null_key is None else f"__key {k}" for k in keys}
        if null_key is not None:
            out = out.withColumns({a: F.coalesce(F.col(f"`{k}`").cast("string"), F.lit(null_key)) for k, a in by.items()})
        lookup = lookups[number].select(*[F.col(f"`{k}`").alias(a) for k, a in by.items()], *[F.col(a).alias(b) for a, b in zip(named, cells)])
        out = attach(out, lookup, list(by.values()))
        out = out.withColumns({cell: F.coalesce(F.col(f"`{cell}`"), F.lit(0).cast("byte")) for cell in cells})
        if null_key is not None:
            out = out.drop(*by.values())
    return out, model


def bias_feature_groups(df: DataFrame, target: str, groups=BIAS_GROUPS, **settings) -> DataFrame:
    """The fitted rows only."""
    return fit_bias_features(df, target, groups, **settings)[0]


def apply_bias_features(df: DataFrame, model: BiasModel) -> DataFrame:
    """Bias columns for new rows: trained bin of each value, then the stored level of each key.

    A group whose columns are missing scores 0.
    """
    out = df
    for c, bins in model.bins.items():
        if c in out.columns:
            out = assign_trained_bins(out, c, bins)
    for g in model.groups:
        keys, name = g.key_columns, crosstab_name(g.key_columns)
        if not set(keys) <= set(out.columns):
            out = out.withColumns({bias_column(name, c): F.lit(0).cast("byte") for c in model.classes})
            continue
        out = crosstab_scores(
            out, keys, model.crosstabs[name], model.classes, tiers=model.tiers, pars=model.pars, floor=model.floor,
            null_key=model.null_key,
        )
    return out

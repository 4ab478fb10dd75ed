"""Calendar expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The eight accepted timestamp layouts, in the order they are tried.
TIMESTAMP_FORMATS = (
    "yyyy-M-d H:m:s",
    "M/d/yyyy h:m:s a",
    "M/d/yyyy H:m:s",
    "M/d/yyyy H:m",
    "yyyy/M/d H:m:s",
    "yyyy-M-d h:m:s a",
    "yyyy-M-d h:m:s",
    "yyyy-M-d h:m",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(col: Column | str, fmt: str | None = None, strict: bool = False) -> Column:
    """Text to timestamp; unreadable text is an error when ``strict``, else null."""
    c = _col(col)
    pattern = [F.lit(fmt)] if fmt else []
    if strict:
        return F.to_timestamp(c, fmt) if fmt else F.to_timestamp(c)
    return F.try_to_timestamp(c, *pattern)


def layout_pattern(fmt: str) -> str:
    """Regular expression for texts that have the shape of a timestamp layout."""
    tokens = {"yyyy": r"\d{4}", "a": "[AaPp][Mm]", **{t: r"\d{1,2}" for t in "MdHhms"}}
    return "^" + re.sub(r"yyyy|[MdHhmsa]", lambda m: tokens[m[0]], fmt) + "$"


def parse_any_ts(col: Column | str, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """First layout that reads the text, after trimming and squeezing white space.

    A layout is only tried on texts of its shape: a failed parse costs an exception per row.
    """
    text = F.trim(F.regexp_replace(_col(col), r"\s+", " "))
    return F.coalesce(
        *[F.when(text.rlike(layout_pattern(f)), F.try_to_timestamp(text, F.lit(f))) for f in formats]
    )


def day_floor(ts: Column | str) -> Column:
    return F.to_date(_col(ts))


def week_of_month_bucket(ts: Column | str) -> Column:
    """MW1 for days 1-7, MW2 for 8-14, MW3 for 15-22, MW4 for the rest and for null."""
    day = F.dayofmonth(_col(ts))
    return F.when(day <= 7, "MW1").when(day <= 14, "MW2").when(day <= 22, "MW3").otherwise("MW4")


def weekday_bucket(ts: Column | str) -> Column:
    """WD1 on Monday to WD7 on Sunday; null counts as WD7."""
    number = F.coalesce(F.weekday(_col(ts)), F.lit(6)) + 1
    return F.concat(F.lit("WD"), number.cast("string"))


def hour_bucket(ts: Column | str) -> Column:
    """H1 from 3 h, H2 from 9 h, H3 from 15 h to 21 h, H4 at night and for null."""
    hour = F.hour(_col(ts))
    return (
        F.when(hour.between(3, 8), "H1")
        .when(hour.between(9, 14), "H2")
        .when(hour.between(15, 20), "H3")
        .otherwise("H4")
    )


def month_bucket(ts: Column | str) -> Column:
    """M1 to M12; null counts as M12."""
    return F.concat(F.lit("M"), F.coalesce(F.month(_col(ts)), F.lit(12)).cast("string"))


def week_bucket_by_hour(ts: Column | str) -> Column:
    """The scoring-time MW variant, which looks at the hour of day (below 7, 14, 22)."""
    hour = F.hour(_col(ts))
    return F.when(hour < 7, "MW1").when(hour < 14, "MW2").when(hour < 22, "MW3").otherwise("MW4")


def month_bucket_by_minute(ts: Column | str) -> Column:
    """The scoring-time M variant: five-minute bucket of the hour, M1 to M12, null is M12."""
    bucket = F.least(F.floor(F.minute(_col(ts)) / 5), F.lit(11)) + 1
    return F.concat(F.lit("M"), F.coalesce(bucket, F.lit(12)).cast("string"))


def time_buckets(df: DataFrame, ts: str, prefix: str = "date", serving: bool = False) -> DataFrame:
    """Add ``{prefix} MW``, ``WD``, ``H`` and ``M``."""
    week, month = (
        (week_bucket_by_hour, month_bucket_by_minute)
        if serving
        else (week_of_month_bucket, month_bucket)
    )
    return df.withColumns(
        {
            f"{prefix} MW": week(ts),
            f"{prefix} WD": weekday_bucket(ts),
            f"{prefix} H": hour_bucket(ts),
            f"{prefix} M": month(ts),
        }
    )


def serving_time_buckets(df: DataFrame, ts: str, prefix: str = "date") -> DataFrame:
    return time_buckets(df, ts, prefix, serving=True)


def time_indicators(df: DataFrame, ts: str, prefix: str = "date") -> DataFrame:
    """0/1 columns MW1-3, WD1-6, H1-3 and M1-11; the last level of each is the baseline."""
    families = (
        ("MW", 3, week_of_month_bucket(ts)),
        ("WD", 6, weekday_bucket(ts)),
        ("H", 3, hour_bucket(ts)),
        ("M", 11, month_bucket(ts)),
    )
    return df.withColumns(
        {
            f"{prefix} {name}{i}": (bucket == f"{name}{i}").cast("int")
            for name, levels, bucket in families
            for i in range(1, levels + 1)
        }
    )


def time_features(df: DataFrame, ts: str, defaults: tuple[int, int] | None = None) -> DataFrame:
    """Add ``hour``, ``dayofweek`` (Monday 0) and ``is_weekend``; ``defaults`` fill null times."""
    hour, day = F.hour(ts), F.weekday(ts)
    if defaults is not None:
        hour, day = F.coalesce(hour, F.lit(defaults[0])), F.coalesce(day, F.lit(defaults[1]))
    return df.withColumns(
        {"hour": hour, "dayofweek": day, "is_weekend": F.coalesce(day >= 5, F.lit(False)).cast("int")}
    )

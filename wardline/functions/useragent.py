"""User-agent fields from ordered pattern rules.

The rules cover the common browser, system and device families; they are not a full device
database. The first rule that matches wins, as an ordered ``when`` chain on the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (family, pattern); groups 1 and 2 are major and minor version where the family has them.
BROWSER_RULES = (
    ("Googlebot", r"Googlebot/(\d+)\.(\d+)"),
    ("bingbot", r"bingbot/(\d+)\.(\d+)"),
    ("Edge", r"Edg(?:e|A|iOS)?/(\d+)\.(\d+)"),
    ("Opera", r"(?:OPR|Opera)[/ ](\d+)\.(\d+)"),
    ("Samsung Internet", r"SamsungBrowser/(\d+)\.(\d+)"),
    ("Chrome Mobile iOS", r"CriOS/(\d+)\.(\d+)"),
    ("Firefox iOS", r"FxiOS/(\d+)\.(\d+)"),
    ("Chrome Mobile", r"Chrome/(\d+)\.(\d+)[0-9.]* Mobile"),
    ("Chrome", r"Chrome/(\d+)\.(\d+)"),
    ("Firefox Mobile", r"(?:Mobile|Tablet);.*Firefox/(\d+)\.(\d+)"),
    ("Firefox", r"Firefox/(\d+)\.(\d+)"),
    ("Mobile Safari", r"Version/(\d+)\.(\d+).*Mobile.*Safari"),
    ("Safari", r"Version/(\d+)\.(\d+).*Safari"),
    ("IE", r"MSIE (\d+)\.(\d+)"),
    ("IE", r"Trident/.*rv:(\d+)\.(\d+)"),
)
# Groups 1 to 3 are major, minor and patch.
OS_RULES = (
    ("iOS", r"(?:iPhone|iPad|iPod).*? OS (\d+)(?:_(\d+))?(?:_(\d+))?"),
    ("Android", r"Android (\d+)(?:\.(\d+))?(?:\.(\d+))?"),
    ("Windows", r"Windows NT (\d+)\.(\d+)()"),
    ("Windows", r"Windows (\d+|CE)()()"),
    ("Mac OS X", r"Mac OS X (\d+)(?:[_.](\d+))?(?:[_.](\d+))?"),
    ("Chrome OS", r"CrOS \S+ (\d+)\.(\d+)(?:\.(\d+))?"),
    ("Ubuntu", r"Ubuntu()()()"),
    ("Linux", r"Linux()()()"),
)
# (family, brand, pattern)
DEVICE_RULES = (
    ("Spider", "Spider", r"(?i)bot\b|crawler|spider"),
    ("iPhone", "Apple", r"iPhone"),
    ("iPad", "Apple", r"iPad"),
    ("iPod", "Apple", r"iPod"),
    ("Samsung", "Samsung", r"\bSM-[A-Z0-9]+"),
    ("Pixel", "Google", r"\bPixel\b"),
    ("Mac", "Apple", r"Macintosh"),
    ("Generic Smartphone", "Generic", r"Android.*Mobile"),
    ("Generic Tablet", "Generic", r"Android"),
)
BOT_PATTERN = r"(?i)bot\b|crawler|spider"
MOBILE_PATTERN = r"iPhone|iPod|Android.*Mobile|Mobile;.*Firefox|Windows Phone|BlackBerry"
TABLET_PATTERN = r"iPad|Tablet|Android"
PC_PATTERN = r"Windows NT|Windows \d|Windows CE|Macintosh|X11|CrOS"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _first_match(ua: Column, rules, parts) -> Column:
    """Struct of the first rule that matches; ``parts`` gives its fields from a rule."""
    return F.coalesce(*[F.when(ua.rlike(rule[-1]), F.struct(*parts(rule))) for rule in rules])


def _versions(ua: Column, names):
    """Family and the numbered groups of a rule, an empty group as null."""

    def parts(rule):
        groups = [
            F.nullif(F.regexp_extract(ua, rule[-1], i), F.lit("")).alias(n)
            for i, n in enumerate(names, 1)
        ]
        return [F.lit(rule[0]).alias("family"), *groups]

    return parts


def device_type(ua: Column | str, default: str | None = None) -> Column:
    """Mobile, else Tablet, else PC; ``default`` where none fits."""
    c = _col(ua)
    return (
        F.when(c.rlike(MOBILE_PATTERN), "Mobile")
        .when(c.rlike(TABLET_PATTERN), "Tablet")
        .when(c.rlike(PC_PATTERN), "PC")
        .otherwise(F.lit(default).cast("string"))
    )


def with_user_agent_fields(df: DataFrame, ua_col: str) -> DataFrame:
    """Add the eleven fields. An empty or null text gives null in every field.

    The matched rules are columns of their own first, so that each rule chain runs once per row.
    """
    c = F.nullif(F.trim(_col(f"`{ua_col}`")), F.lit(""))
    matched = df.withColumns(
        {
            "__browser": _first_match(c, BROWSER_RULES, _versions(c, ("major", "minor"))),
            "__os": _first_match(c, OS_RULES, _versions(c, ("major", "minor", "patch"))),
            "__device": _first_match(
                c, DEVICE_RULES, lambda r: [F.lit(r[0]).alias("family"), F.lit(r[1]).alias("brand")]
            ),
        }
    )

    def family(match: str) -> Column:
        return F.when(c.isNotNull(), F.coalesce(F.col(f"{match}.family"), F.lit("Other")))

    return matched.withColumns(
        {
            "Browser family": family("__browser"),
            "Browser major": F.col("__browser.major"),
            "Browser minor": F.col("__browser.minor"),
            "OS family": family("__os"),
            "OS major": F.col("__os.major"),
            "OS minor": F.col("__os.minor"),
            "OS patch": F.col("__os.patch"),
            "Device family": family("__device"),
            "Device brand": F.col("__device.brand"),
            "Device type": F.when(c.isNotNull(), device_type(c)),
            "Device bot": F.when(c.isNotNull(), c.rlike(BOT_PATTERN)),
        }
    ).drop("__browser", "__os", "__device")

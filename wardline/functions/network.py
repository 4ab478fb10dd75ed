"""Address and port expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Last well-known and last registered port, highest port.
WELL_KNOWN_MAX, REGISTERED_MAX, PORT_MAX = 1023, 49151, 65535

# The three long category labels.
PORT_LABELS = {
    "wellknown": "Well-known (0-1023)",
    "registered": "Registered (1024-49151)",
    "dynamic": "Dynamic (49152-65535)",
}

IPV4_PATTERN = r"^((25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ipv4_prefix(ip: Column | str, octets: int) -> Column:
    """First one to three octets of a dotted address."""
    if octets not in (1, 2, 3):
        raise ValueError("octets must be 1, 2 or 3")
    return F.substring_index(_col(ip), ".", octets)


def is_private_ip(ip: Column | str) -> Column:
    """True for 10/8, 172.16/12 and 192.168/16; malformed or null addresses give False."""
    parts = F.split(_col(ip), r"\.")
    a = F.get(parts, F.lit(0)).try_cast("int")
    b = F.get(parts, F.lit(1)).try_cast("int")
    inside = (a == 10) | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168))
    return F.coalesce((F.size(parts) == 4) & b.isNotNull() & inside, F.lit(False))


def ip_to_long(ip: Column | str) -> Column:
    """Strict IPv4 text to its 32-bit number, null for anything else."""
    c = _col(ip)
    parts = F.split(c, r"\.")
    number = sum(
        (F.get(parts, F.lit(i)).try_cast("long") * F.lit(256 ** (3 - i)) for i in range(4)),
        F.lit(0).cast("long"),
    )
    return F.when(c.rlike(IPV4_PATTERN), number)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hex_groups(number: Column) -> Column:
    """An IPv4 number as the two last groups of an address."""
    digits = F.lpad(F.lower(F.hex(number)), 8, "0")
    return F.concat(F.substring(digits, 1, 4), F.lit(":"), F.substring(digits, 5, 4))


def ip_to_key(ip: Column | str) -> Column:
    """IPv4 or IPv6 text to 16 bytes in address order, null for anything else; IPv4 is ``::ffff:a.b.c.d``.

    ``::`` stands for as many zero groups as are missing, at least one; the last two groups may be dotted.
    """
    empty = F.array().cast("array<string>")

    def whole(text: Column) -> Column:
        """With dotted groups written as hexadecimal ones; null if they are no address."""
        tail = F.substring_index(text, ":", -1)
        head = F.substring(text, F.lit(1), F.length(text) - F.length(tail))
        return F.when(text.contains("."), F.concat(F.when(text.contains(":"), head).otherwise("::ffff:"), _hex_groups(ip_to_long(tail)))).otherwise(text)

    def groups(sides: Column) -> Column:
        """All groups, or null where their number is wrong."""
        of = lambda side: F.when(side == "", empty).otherwise(F.split(side, ":", -1))
        left, right = of(F.get(sides, F.lit(0))), of(F.coalesce(F.get(sides, F.lit(1)), F.lit("")))
        return _with(F.struct(left.alias("left"), right.alias("right")), lambda s: _with(
            8 - F.size(s["left"]) - F.size(s["right"]),
            lambda missing: F.when(
                F.when(F.size(sides) == 2, missing >= 1).otherwise((F.size(sides) == 1) & (missing == 0)),
                F.concat(s["left"], F.array_repeat(F.lit("0"), missing), s["right"]),
            ),
        ))

    valid = lambda all_groups: F.forall(all_groups, lambda g: g.rlike("^[0-9a-fA-F]{1,4}$"))
    digits = lambda all_groups: F.array_join(F.transform(all_groups, lambda g: F.lpad(g, 4, "0")), "")
    return _with(
        _with(F.split(_with(_col(ip), whole), "::", -1), groups), lambda found: F.when(valid(found), F.unhex(digits(found)))
    )


def network_bounds(network: Column | str) -> Column:
    """First and last address key (see ``ip_to_key``) of ``address/bits``, as a struct ``(first, last)``; a lone address is
    a network of one.

    Null where the address or the number of bits is no such. Host bits of the address are ignored.
    """
    text = _col(network)
    address, size = F.substring_index(text, "/", 1), F.substring_index(text, "/", -1)
    width = F.when(address.contains(":"), 128).otherwise(32)
    bits = F.when(~text.contains("/"), width).when(size.rlike("^[0-9]{1,3}$"), size.try_cast("int"))
    zeros, ones = F.lit("0" * 32), F.lit("F" * 32)

    def bounds(found: Column) -> Column:
        digits, hosts = found["digits"], found["hosts"]
        # Whole hexadecimal digits are kept or replaced; the one that the mask cuts is rounded.
        kept = F.floor((128 - hosts) / 4).cast("int")
        step = F.element_at(F.array(F.lit(16), F.lit(2), F.lit(4), F.lit(8)), hosts % 4 + 1)
        digit = F.conv(F.substr(digits, kept + 1, F.lit(1)), 16, 10).cast("int")
        low = digit - digit % step

        def key(cut: Column, fill: Column) -> Column:
            middle = F.when(kept < 32, F.hex(cut.cast("long"))).otherwise("")
            return F.unhex(F.concat(F.substr(digits, F.lit(1), kept), F.substr(middle, F.length(middle)), F.substr(fill, F.lit(1), 31 - kept)))

        return F.struct(key(low, zeros).alias("first"), key(low + step - 1, ones).alias("last"))

    found = F.struct(F.hex(ip_to_key(address)).alias("digits"), F.when(bits <= width, width - bits).alias("hosts"))
    return _with(found, lambda f: F.when(f["digits"].isNotNull() & f["hosts"].isNotNull(), bounds(f)))



def port_category(port: Column | str, style: str = "short") -> Column:
    """Port class by range.

    ``short``: wellknown / registered / dynamic, null stays null. ``long``: the spelled-out labels,
    ``Unknown`` for null or out of range. ``serving``: short labels, unreadable ports count as
    registered.
    """
    c = _col(port)
    if style == "serving":
        c = c.try_cast("double").try_cast("long")
    chain = F.when(c <= WELL_KNOWN_MAX, "wellknown").when(c <= REGISTERED_MAX, "registered")
    if style == "short":
        return chain.when(c.isNotNull(), "dynamic")
    if style == "serving":
        return F.when(c.isNull(), "registered").otherwise(chain.otherwise("dynamic"))
    if style == "long":
        return (
            F.when(c.between(0, WELL_KNOWN_MAX), PORT_LABELS["wellknown"])
            .when(c.between(WELL_KNOWN_MAX + 1, REGISTERED_MAX), PORT_LABELS["registered"])
            .when(c.between(REGISTERED_MAX + 1, PORT_MAX), PORT_LABELS["dynamic"])
            .otherwise("Unknown")
        )
    raise ValueError(f"unknown style {style!r}")


def port_diff(a: Column | str, b: Column | str) -> Column:
    return F.abs(_col(a) - _col(b))

"""Range lookups with nested, touching and overlapping ranges, and address keys of both families."""

import datetime
import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from wardline.functions.network import ip_to_key, network_bounds
from wardline.operators import lookup as L
from wardline.operators.binning import range_lookup


def narrowest(ranges, v):
    hits = [(h - l, -l, l, h, p) for l, h, p in ranges if l is not None and h is not None and l <= v <= h]
    return min(hits)[2:] if hits else (None, None, None)


@pytest.mark.parametrize("kind", ["long", "double", "decimal(10,1)"])
def test_narrowest_range_wins(spark, kind):
    draw = random.Random(1)
    ranges = [(0, 1000, "all"), (0, 100, "a"), (100, 200, "b"), (150, 150, "point"), (None, 5, "n"), (3, None, "n"), (9, 3, "bad"), (0, 100, "z"), (-50, 4000, "wide")]
    ranges += [(a, a + draw.randint(0, 300), f"r{i}") for i, a in enumerate(draw.randint(0, 3000) for _ in range(200))]
    values = [*range(-60, 300), *range(300, 4100, 7)]
    table = spark.createDataFrame(ranges, "lo long, hi long, name string").select(F.col("lo").cast(kind), F.col("hi").cast(kind), "name").repartition(5)
    wanted = spark.createDataFrame([(v,) for v in [*values, *values[:5], None]], "v long").select(F.col("v").cast(kind))
    got = range_lookup(wanted, "v", table, "lo", "hi", ["name"])
    assert got.columns == ["v", "lo", "hi", "name"]
    assert {r.v: (r.lo, r.hi, r.name) for r in got.collect()} == {v: narrowest(ranges, v) for v in values}
    assert got.count() == len(values)


def test_ranges_of_dates_and_odd_tables(spark):
    day = lambda n: datetime.date(2020, 1, 1) + datetime.timedelta(n)
    ranges = spark.createDataFrame([(day(0), day(30), "jan"), (day(30), day(60), "feb"), (day(10), day(12), "trip")], "lo date, hi date, name string")
    values = spark.createDataFrame([(day(n),) for n in (0, 10, 13, 30, 31, 61)], "d date")
    got = {(r.d - day(0)).days: r.name for r in range_lookup(values, "d", ranges, "lo", "hi", ["name"]).collect()}
    assert got == {0: "jan", 10: "trip", 13: "jan", 30: "jan" if got[30] == "jan" else "feb", 31: "feb", 61: None}
    assert got[30] == "feb"  # equally wide, so the later start
    assert {r.name for r in range_lookup(values, "d", ranges.limit(0), "lo", "hi", ["name"]).collect()} == {None}
    assert range_lookup(values.limit(0), "d", ranges, "lo", "hi", []).count() == 0


def test_address_keys(spark):
    draw = random.Random(4)
    texts = [str(ipaddress.IPv6Address(draw.getrandbits(128) & draw.getrandbits(128) & draw.getrandbits(128))) for _ in range(200)]
    texts += [ipaddress.IPv6Address(draw.getrandbits(128)).exploded.upper() for _ in range(20)]
    texts += ["::", "::1", "1::", "::ffff:1.2.3.4", "64:ff9b::192.0.2.33", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1.2.3.4", "255.255.255.255", "1:2:3:4:5:6:1.2.3.4"]
    texts += ["", ":", ":::", "1::2::3", "1:2:3", "1:2:3:4:5:6:7:8:9", "12345::", "g::", "1:2:3:4:5:6:7:8::", "::1.2.3", "1.2.3.4::", "256.1.1.1", "1.2.3.4.5", "::1 ", "1:", ":1:2:3:4:5:6:7", "fe80::1%eth0", "a", "1.2.3.4:5"]

    def want(text):
        try:
            ip = ipaddress.ip_address(text)
        except ValueError:
            return None
        if "%" in text:
            return None
        return (b"\0" * 10 + b"\xff\xff" if ip.version == 4 else b"") + ip.packed

    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "ip string").select("ip", ip_to_key("ip").alias("key")).collect()
    got = {r.ip: None if r.key is None else bytes(r.key) for r in rows}
    assert got == {**{t: want(t) for t in texts}, None: None}


def test_network_bounds(spark):
    draw = random.Random(6)
    texts = [f"{ipaddress.IPv6Address(draw.getrandbits(128))}/{b}" for b in range(129)] + [f"{ipaddress.IPv4Address(draw.getrandbits(32))}/{b}" for b in range(33)]
    texts += ["1.2.3.4", "::5", "1.2.3.4/33", "::/129", "::/x", "::/", "bad/8", None]
    rows = spark.createDataFrame([(t,) for t in texts], "net string").withColumn("n", network_bounds("net"))
    for r in rows.selectExpr("net", "n.first AS a", "n.last AS b").collect():
        try:
            net = ipaddress.ip_network(r.net, strict=False)
        except ValueError:
            assert r.a is None and r.b is None, r.net
            continue
        pad = b"\0" * 10 + b"\xff\xff" if net.version == 4 else b""
        assert (bytes(r.a), bytes(r.b)) == (pad + net.network_address.packed, pad + net.broadcast_address.packed), r.net


def test_geolocation_in_nested_networks(spark):
    networks = spark.createDataFrame(
        [("10.0.0.0/8", "A", None), ("10.1.0.0/16", "A", "a"), ("2001:db8::/32", "B", None), ("2001:db8:5::/48", "B", "b"), ("2001:db8:5::7", "B", "host"), ("oops", "C", "c")],
        "network string, country string, city string")
    addresses = ["10.0.0.1", "10.1.255.255", "10.2.0.0", "11.0.0.0", "2001:db8:5::6", "2001:DB8:5:0::7", "2001:db8:6::", "2001:db9::", "::ffff:10.1.0.0", "bad", None]
    df = spark.createDataFrame(list(enumerate(addresses)), "id int, ip string")
    geo = L.geo_networks(networks, "network")
    got = [(r.country, r.city) for r in L.ip_geolocate(df, "ip", geo, fields=["country", "city"]).orderBy("id").collect()]
    none = (None, None)
    assert got == [("A", None), ("A", "a"), ("A", None), none, ("B", "b"), ("B", "host"), ("B", None), none, ("A", "a"), none, none]
    with pytest.raises(ValueError, match="one kind"):
        L.ip_geolocate(df, "ip", geo, fields=["country"], country_ranges=spark.createDataFrame([(0, 1, "X")], "ip_start long, ip_end long, country string"))

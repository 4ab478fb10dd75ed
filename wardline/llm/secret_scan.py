"""Secret scans: fixed patterns, and a battery of randomness tests with false-discovery control.

Candidates are maximal runs of ``[A-Za-z0-9+/_=-]`` of at least ``MIN_LENGTH`` characters (the padding at the
end left out). For each the smallest fitting encoding is inferred (decimal, hex, base32, base36, base62,
base64), and its string of digits is tested for randomness: chi-squared uniformity over the alphabet, runs
above and below the middle, and lag-one serial correlation. A candidate must pass all three at
``battery_level`` (shared out among the tests).

Ordinary words, paths and identifiers must not pass by luck. For each candidate the probability that text of
its length with the corpus's own letter frequencies is as uniform as it is follows from the non-central
distribution of the same chi-squared statistic: the shorter the string, the larger that probability. The
candidates that pass the battery and stay under the Benjamini-Hochberg line of these probabilities, drawn for
each length class over all candidates of the corpus, are reported as kind ``random``.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import running
from ..session import store
from .buffers import utf8_slices
from .shipping import ship

MIN_LENGTH = 20
BATTERY_LEVEL = 0.001
FALSE_DISCOVERY = 0.01
# Upper ends of the length classes.
LENGTH_CLASSES = (24, 32, 48, 64, 128)

# The given patterns. Matches that fail their length are dropped after matching.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more is a maximal run that is long enough
ASSIGN_LENGTH, ACCESS_LENGTH = 8, 16
KINDS = ("assign", "access", "hex", "random")

_WORDS = (b"passw", b"secret", b"token", b"api_key", b"apikey")
_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
# Name and alphabet in its own order of digits, narrowest first.
ENCODINGS = (
    ("decimal", _DIGITS), ("hex", _DIGITS + "abcdef"), ("HEX", _DIGITS + "ABCDEF"), ("base32", _UPPER + "234567"),
    ("base36", _DIGITS + _LOWER), ("BASE36", _DIGITS + _UPPER), ("base62", _UPPER + _LOWER + _DIGITS),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"), ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
    ("mixed", _UPPER + _LOWER + _DIGITS + "+/-_="),
)
_RUN = np.zeros(256, bool)
_RUN[list((_UPPER + _LOWER + _DIGITS + "+/_=-").encode())] = True
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the fixed patterns in code points, by start, then kind as listed."""
    spans = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    spans += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    spans += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def _normal_tail(z: float) -> float:
    """Two-sided probability of a standard normal value."""
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_upper(x: float, k: int) -> float:
    """Upper tail of the chi-squared distribution, by Wilson and Hilferty's cube root."""
    z = ((max(x, 0) / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * math.erfc(z / math.sqrt(2))


def encoding_of(value: str) -> tuple[str, str]:
    """Name and alphabet of the narrowest encoding that has every character."""
    used = set(value)
    return next((n, a) for n, a in ENCODINGS if used <= set(a))


def battery(value: str) -> tuple[str, float, float, float, float]:
    """``(encoding, chi-squared statistic, p uniformity, p runs, p serial correlation)`` under randomness."""
    name, alphabet = encoding_of(value)
    place = {c: i for i, c in enumerate(alphabet)}
    x = np.array([place[c] for c in value], np.float64)
    n, k = len(x), len(alphabet)
    counts = np.bincount(x.astype(np.int64), minlength=k)
    statistic = float(((counts - n / k) ** 2).sum() * k / n)
    high = x >= k / 2
    n1 = int(high.sum())
    n0 = n - n1
    if n0 and n1:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 2 * n0 * n1 / n + 1
        variance = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = _normal_tail((runs - mean) / math.sqrt(variance)) if variance > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    centred = x - x.mean()
    power = float((centred**2).sum())
    # Under randomness the lag-one coefficient has mean -1/n and variance about 1/n.
    p_serial = _normal_tail((float((centred[1:] * centred[:-1]).sum()) / power + 1 / n) * math.sqrt(n)) if power else 0.0
    return name, statistic, _chi_upper(statistic, k - 1), p_runs, p_serial


def chance_in_text(statistic: float, n: int, alphabet: str, shares: np.ndarray) -> float:
    """Probability that ``n`` characters drawn with the corpus's ``shares`` (by byte) have a chi-squared statistic
    of at most ``statistic``: a non-central chi-squared variable, by Sankaran's power transformation."""
    k = len(alphabet)
    q = shares[list(alphabet.encode())]
    q = q / q.sum() if q.sum() else np.full(k, 1 / k)
    shift = n * k * float(((q - 1 / k) ** 2).sum())
    d = k - 1
    h = 1 - 2 * (d + shift) * (d + 3 * shift) / (3 * (d + 2 * shift) ** 2)
    p = (d + 2 * shift) / (d + shift) ** 2
    m = (h - 1) * (1 - 3 * h)
    z = ((statistic / (d + shift)) ** h - (1 + h * p * (h - 1 - 0.5 * (2 - h) * m * p))) / (h * math.sqrt(2 * p) * (1 + 0.5 * m * p))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _long_runs(data: np.ndarray, table: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of at least ``least`` bytes of a class, none across two texts."""
    inside = np.concatenate(([False], table[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    # A run over a border of texts falls into one part for each of them.
    cuts = offsets[1:-1]
    crossed = np.searchsorted(cuts, ends, side="left") - np.searchsorted(cuts, starts, side="right")
    if (crossed > 0).any():
        pieces = []
        for a, b in zip(starts.tolist(), ends.tolist()):
            between = cuts[np.searchsorted(cuts, a, side="right") : np.searchsorted(cuts, b, side="left")].tolist()
            pieces += [(x, y) for x, y in zip([a, *between], [*between, b]) if y - x >= least]
        starts, ends = np.array([p[0] for p in pieces], np.int64), np.array([p[1] for p in pieces], np.int64)
    return starts, ends


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes counted by value, one row a batch."""
    for batch in batches:
        counts = np.zeros(128, np.int64)
        for _, _, data, _ in utf8_slices(batch.column(0)):
            counts += np.bincount(data, minlength=256)[:128]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(128)), pa.array(counts)], ["byte", "n"])


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_CANDIDATE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("length_class", pa.int32()), ("chance", pa.float64())])
_SCHEMA = (
    "doc_id {kind}, base array<struct<kind:string,start:long,end:long>>, tested long, "
    "candidates array<struct<start:long,end:long,length_class:int,chance:double>>, counted array<long>"
)


def _scan(sent, min_length: int, level: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares = pickle.loads(sent.value)
        alphabets = dict(ENCODINGS)
        for batch in batches:
            for first, end, data, offsets in utf8_slices(batch.column(1)):
                raw, low = data.tobytes(), data.tobytes().lower()
                hexed = np.searchsorted(offsets, _long_runs(data, _HEX, offsets, 32)[0], side="right") - 1
                hex_docs = set(hexed.tolist())
                starts, ends = _long_runs(data, _RUN, offsets, min_length)
                doc = np.searchsorted(offsets, starts, side="right") - 1
                own: dict[int, list[tuple[int, int]]] = {}
                for d, a, b in zip(doc.tolist(), starts.tolist(), ends.tolist()):
                    own.setdefault(d, []).append((a, b))
                base, candidates, counted = [], [], []
                for i in range(end - first):
                    a, b = int(offsets[i]), int(offsets[i + 1])
                    spans, found, tested = [], [], [0] * (len(LENGTH_CLASSES) + 1)
                    if i in hex_docs or low.find(b"akia", a, b) >= 0 or any(low.find(w, a, b) >= 0 for w in _WORDS):
                        spans = [{"kind": k, "start": s, "end": e} for s, e, k in base_spans(raw[a:b].decode())]
                    at = chars = 0
                    for s, e in own.get(i, ()):
                        value = raw[s:e].decode().rstrip("=")
                        if len(value) < min_length:
                            continue
                        size = int(np.searchsorted(LENGTH_CLASSES, len(value)))
                        tested[size] += 1
                        name, statistic, *p = battery(value)
                        if min(p) >= level / len(p):
                            chars += len(raw[a + at : s].decode())
                            at = s - a
                            chance = chance_in_text(statistic, len(value), alphabets[name], shares)
                            found.append({"start": chars, "end": chars + len(value), "length_class": size, "chance": chance})
                    base.append(spans)
                    candidates.append(found)
                    counted.append(tested)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(base, pa.list_(_SPAN)), pa.array([sum(c) for c in counted], pa.int64()),
                     pa.array(candidates, pa.list_(_CANDIDATE)), pa.array(counted, pa.list_(pa.int64()))],
                    ["doc_id", "base", "tested", "candidates", "counted"],
                )

    return run


def scan_secrets(docs: DataFrame, *, min_length: int = MIN_LENGTH, battery_level: float = BATTERY_LEVEL, false_discovery: float = FALSE_DISCOVERY) -> DataFrame:
    """``(doc_id, base, spans, tested)``, one row per input row; spans are arrays of ``struct(kind, start, end)`` in
    code points, end exclusive, by start, then kind as listed in ``KINDS``, then end.

    ``base`` are the fixed patterns' matches, ``spans`` those and the ``random`` ones; ``tested`` counts the
    candidates of the row. Null is the empty text; rows that repeat an id are scanned each. Whole texts are
    read; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select("text")
    counts = texts.mapInArrow(_shares, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect()
    shares = np.zeros(256)
    for row in counts:  # one row per ASCII byte
        shares[row["byte"]] = row["n"]
    sent = spark.sparkContext.broadcast(pickle.dumps(shares / max(1.0, shares.sum())))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scanned = store(docs.select("doc_id", "text").mapInArrow(_scan(sent, min_length, battery_level), _SCHEMA.format(kind=kind)))
    lines = _discovery_lines(scanned, false_discovery)
    limit = F.create_map(*[x for c, p in lines.items() for x in (F.lit(c), F.lit(p))]) if lines else F.lit(None).cast("map<int,double>")
    passed = F.filter("candidates", lambda c: c["chance"] <= F.coalesce(limit[c["length_class"]], F.lit(-1.0)))
    found = F.transform(passed, lambda c: F.struct(F.lit("random").alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    place = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(F.concat("base", found), lambda s: F.struct(s["start"].alias("start"), place[s["kind"]].alias("place"), s["end"].alias("end"), s["kind"].alias("kind")))
    spans = F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return scanned.select("doc_id", "base", spans.alias("spans"), "tested")


def _discovery_lines(scanned: DataFrame, rate: float) -> dict[int, float]:
    """Largest chance of each length class that is at most ``rate * rank / tests``; one number per class.

    Candidates that failed the battery count as tests with chance one. Ranks are prefix sums over the
    distinct chances, range partitioned, so no class is gathered anywhere.
    """
    tests = scanned.select(F.posexplode("counted").alias("length_class", "n")).groupBy("length_class").agg(F.sum("n").alias("tests"))
    each = scanned.select(F.inline("candidates")).groupBy("length_class", "chance").agg(F.count(F.lit(1)).alias("n"))
    ranked = running(each, ["chance"], sums=["n"], by=["length_class"]).join(F.broadcast(tests), "length_class")
    under = ranked.where(F.col("chance") * F.col("tests") <= rate * (F.col("n_before") + F.col("n")))
    return {r["length_class"]: r["line"] for r in under.groupBy("length_class").agg(F.max("chance").alias("line")).collect()}

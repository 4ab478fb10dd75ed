"""URL filters: host rules and a cascade of Bloom filters with exact answers.

Level 0 of a cascade encodes the listed keys. The keys of the corpus that pass it by mistake are encoded
in level 1, the listed keys that pass level 1 by mistake in level 2, and so on until a level lets
nothing through by mistake. Built over the corpus's complete key universe, the answer for every one of
its keys is exact: a key is listed if the first level that rejects it has an odd number.

Keys are dealt by hash to shards of bounded size, each with a cascade of its own, so building needs one
shuffle of distinct keys and tasks of bounded memory. Applying needs no join: the filters, a few bits
for each listed key, are broadcast if their measured size is within a bound, and a larger cascade is
applied in as many passes over the rows as there are blocks of shards within it.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, store
from .shipping import ship

KEYS_PER_SHARD = 200_000
BROADCAST_BYTES = 32 << 20
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def url_host(url: str) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: str) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: str) -> Column:
    c = F.coalesce(F.col(url), F.lit(""))
    at = F.locate("://", c)
    return F.when(at > 0, F.substr(c, at + 3)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule ``(verdict, host, path)`` that fits, else nulls.

    A rule fits its host and all subdomains, if the path starts with the rule's path.
    """
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    rule = verdict = None
    for kind, at, start in ranked:
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule = F.when(fits, at + start) if rule is None else rule.when(fits, at + start)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def _bits(hashes: np.ndarray, level: int, n_bits: int, n_hashes: int) -> np.ndarray:
    """``(n_hashes, len(hashes))`` bit numbers; every level hashes anew."""
    with np.errstate(over="ignore"):
        base = (hashes + np.uint64(level + 1) * _MULTIPLIERS[0]) * _MULTIPLIERS[1]
        base ^= base >> np.uint64(29)
        step = (base * _MULTIPLIERS[2]) | np.uint64(1)
        x = base + np.arange(n_hashes, dtype=np.uint64)[:, None] * step
        x ^= x >> np.uint64(32)
        x *= _MULTIPLIERS[3]
        return (x >> np.uint64(20)) % np.uint64(n_bits)


def _filter_of(hashes: np.ndarray, level: int, rate: float) -> tuple[int, int, bytes]:
    n_bits = max(64, math.ceil(-len(hashes) * math.log(rate) / math.log(2) ** 2))
    n_hashes = max(1, round(n_bits / max(1, len(hashes)) * math.log(2)))
    field = np.zeros(n_bits, np.uint8)
    field[_bits(hashes, level, n_bits, n_hashes).ravel()] = 1
    return n_bits, n_hashes, np.packbits(field).tobytes()


def _passes(hashes: np.ndarray, level: int, n_bits: int, n_hashes: int, field: np.ndarray) -> np.ndarray:
    at = _bits(hashes, level, n_bits, n_hashes)
    hit = (field[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1
    return hit.all(axis=0)


def _build(shard: int, listed: np.ndarray, others: np.ndarray) -> pd.DataFrame:
    rows, level, inside, outside = [], 0, listed, others
    while len(inside):
        # The first filter is sized so that about as many others pass as there are listed keys.
        rate = min(0.5, max(len(inside) / max(1, len(outside)) * math.sqrt(0.5), 1e-6)) if level == 0 else 0.5
        n_bits, n_hashes, field = _filter_of(inside, level, rate)
        rows.append((shard, level, n_bits, n_hashes, field))
        passed = outside[_passes(outside, level, n_bits, n_hashes, np.frombuffer(field, np.uint8))] if len(outside) else outside
        inside, outside, level = passed, inside, level + 1
    return pd.DataFrame(rows, columns=["shard", "level", "n_bits", "n_hashes", "field"])


@dataclass
class Cascade:
    """Stored filters ``(shard, level, n_bits, n_hashes, field)`` over ``n_shards`` shards."""

    filters: DataFrame
    n_shards: int
    n_bytes: int
    collisions: DataFrame

    @staticmethod
    def build(keys: DataFrame, key: str, listed: str, *, keys_per_shard: int = KEYS_PER_SHARD) -> Cascade:
        """From the universe: every key of the corpus and every listed key, ``listed`` true for the latter.

        Keys may repeat (a key listed in any row is listed); null keys are never listed and are ignored.
        An empty list gives no filters, and every key is then unlisted.
        """
        ship(keys.sparkSession)
        # One row per key; its 64-bit hash stands for it. Keys of equal hash but unequal listing are set apart.
        distinct = keys.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
            F.max(F.coalesce(F.col(listed), F.lit(False))).alias("listed")
        )
        hashed = store(distinct.withColumn("hash", F.xxhash64("key")))
        n_shards = max(1, math.ceil(hashed.count() / keys_per_shard))
        clash = hashed.groupBy("hash").agg(F.min("listed").alias("low"), F.max("listed").alias("high")).where("low <> high")
        collisions = store(hashed.join(clash, "hash", "left_semi").where("listed").select("key"))

        def one(batch: pd.DataFrame) -> pd.DataFrame:
            shard = int(batch["shard"].iloc[0])
            hashes, marked = batch["hash"].to_numpy().view(np.uint64), batch["listed"].to_numpy()
            inside = np.unique(hashes[marked])
            return _build(shard, inside, np.setdiff1d(hashes[~marked], inside))

        filters = store(
            hashed.select("hash", "listed", F.pmod("hash", F.lit(n_shards)).cast("int").alias("shard"))
            .groupBy("shard")
            .applyInPandas(one, "shard int, level int, n_bits long, n_hashes int, field binary")
        )
        n_bytes = filters.agg(F.sum(F.length("field"))).first()[0] or 0
        return Cascade(filters, n_shards, int(n_bytes), collisions)

    def contains(self, rows: DataFrame, key: str, out: str, *, block_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """``rows`` with a boolean ``out``: whether the row's key is listed. Exact for keys of the universe;
        null keys give false. Filters are broadcast in blocks of shards of at most ``block_bytes`` (or one
        shard), one pass each."""
        n_shards = self.n_shards
        blocks = max(1, math.ceil(self.n_bytes / block_bytes))
        hashed = rows.withColumns({"__hash": F.xxhash64(key), out: F.lit(False)})
        for block in range(blocks):
            low, high = n_shards * block // blocks, n_shards * (block + 1) // blocks
            found = self.filters.where(F.col("shard").between(low, high - 1)).orderBy("shard", "level").collect()
            levels: dict[int, list] = {}
            for f in found:
                levels.setdefault(f["shard"], []).append((f["level"], f["n_bits"], f["n_hashes"], bytes(f["field"])))
            sent = rows.sparkSession.sparkContext.broadcast(pickle.dumps(levels))

            hashed = hashed.withColumn(out, F.arrow_udf(_judge(sent, low, high, n_shards), "boolean")(F.col("__hash"), F.col(out)))
            if blocks > 1:
                hashed = materialize(hashed)
        if not self.collisions.isEmpty():
            # Two keys with one 64-bit hash: the listed ones are named, the others of that hash are not listed.
            names = self.collisions.select(F.col("key").alias("__key"))
            clash = names.select(F.xxhash64("__key").alias("__hash"), F.lit(True).alias("__clash")).distinct()
            hashed = hashed.join(clash, "__hash", "left").join(names.withColumn("__named", F.lit(True)), F.col(key) == F.col("__key"), "left")
            hashed = hashed.withColumn(out, F.when(F.col("__clash"), F.coalesce("__named", F.lit(False))).otherwise(F.col(out)))
        return hashed.select(*rows.columns, F.when(F.col(key).isNull(), False).otherwise(F.col(out)).alias(out))


def _judge(sent, low: int, high: int, n_shards: int):
    def judge(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        cascade = {s: [(n, b, k, np.frombuffer(f, np.uint8)) for n, b, k, f in ls] for s, ls in pickle.loads(sent.value).items()}
        for hashes, known in columns:
            known = known.to_numpy(zero_copy_only=False).copy()
            signed = hashes.to_numpy(zero_copy_only=False)
            shards = np.mod(signed, n_shards)
            for shard in np.unique(shards):
                if low <= shard < high and shard in cascade:
                    at = np.flatnonzero(shards == shard)
                    known[at] = _listed(signed[at].view(np.uint64), cascade[shard])
            yield pa.array(known)

    return judge


def _listed(hashes: np.ndarray, levels: list) -> np.ndarray:
    """Whether the first level that rejects a hash has an odd number; past the last level, whether it is even."""
    answer = np.zeros(len(hashes), bool)
    open_rows = np.arange(len(hashes))
    for level, n_bits, n_hashes, field in levels:
        passed = _passes(hashes[open_rows], level, n_bits, n_hashes, field)
        answer[open_rows[~passed]] = level % 2 == 1
        open_rows = open_rows[passed]
        if not len(open_rows):
            return answer
    # A hash that passes every level belongs to the set that the last level encodes.
    answer[open_rows] = (len(levels) - 1) % 2 == 0
    return answer

"""Hard negatives by rotated one-bit codes.

A vector is rotated by a fixed random orthogonal matrix and stored as the signs of its components, with the inner
product of code and vector (their alignment). What the code leaves over gets a code of its own, and so on for a few
levels, and the norm of the last rest is stored too. The inner product with a query is then estimated by population
counts of the codes against the bit planes of the rounded query, and by Cauchy-Schwarz lies within the norm of the rest
times the norm of the part of the query that is orthogonal to the code. The interval also covers the rounding, so it holds
always. A row is dropped only if its interval can't reach what an anchor already has; the others are scored by
whole numbers. Results are exact.

Anchors are a stated part of the table. They are taken in blocks of bounded size, each against all rows.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, store
from .shipping import ship

SEED = 42
LEVELS = 4
QUERY_BITS = 6
# Anchors go through the driver in blocks of this many bytes of whole-number vectors.
BLOCK_BYTES = 4 << 20
# The first rows to be searched are one in FIRST_SHARE, so that the others meet anchors that have partners already.
FIRST_SHARE = 16
_ANCHORS, _ROWS = 128, 4_096
_NONE = -(1 << 62) - 1
_INDEX = "vec_id long, label string, ints binary, codes binary, aligned binary, rest binary"


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same for one seed anywhere."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _packed(bits: np.ndarray) -> np.ndarray:
    """``(..., bits)`` booleans as ``(..., words)`` 64-bit words, the rest of the last word zero."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    spare = -packed.shape[-1] % 8
    return np.ascontiguousarray(np.pad(packed, [*[(0, 0)] * (packed.ndim - 1), (0, spare)])).view(np.uint64)


@dataclasses.dataclass
class Codes:
    """One-bit codes ``(n, levels, words)`` of rows, what a sign stands for, and the norm of the rest of each level."""

    codes: np.ndarray
    aligned: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, ints: np.ndarray, turn: np.ndarray, levels: int = LEVELS) -> Codes:
        left = ints.astype(np.float64) @ turn
        dims = left.shape[1]
        codes, aligned, rest = [], [], []
        for _ in range(levels):
            signs = left >= 0
            step = np.abs(left).sum(axis=1) / dims
            left = left - np.where(signs, step[:, None], -step[:, None])
            codes.append(_packed(signs)), aligned.append(step), rest.append(np.linalg.norm(left, axis=1))
        return cls(np.stack(codes, axis=1), np.stack(aligned, axis=1), np.stack(rest, axis=1))

    def take(self, rows) -> Codes:
        return Codes(self.codes[rows], self.aligned[rows], self.rest[rows])


class Queries:
    """Rotated anchors, rounded to ``bits`` bits a component and cut into bit planes."""

    def __init__(self, ints: np.ndarray, turn: np.ndarray, bits: int = QUERY_BITS):
        turned = ints.astype(np.float64) @ turn
        self.dims = turned.shape[1]
        self.norm = np.linalg.norm(turned, axis=1)
        self.low = turned.min(axis=1, initial=0)
        self.step = np.maximum((turned.max(axis=1, initial=0) - self.low) / ((1 << bits) - 1), 1e-300)
        whole = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.uint8)
        rounded = self.low[:, None] + self.step[:, None] * whole
        self.total = rounded.sum(axis=1)
        self.error = np.abs(turned - rounded).sum(axis=1)
        self.planes = np.stack([_packed((whole >> b) & 1 == 1) for b in range(bits)], axis=1)

    def bounds(self, codes: Codes, pairs: tuple[np.ndarray, np.ndarray] | None, level: int, so_far=0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(lower, upper, estimate)`` of the inner products by the codes up to ``level``, where ``so_far`` is the estimate
        of the levels before: of all anchors with all rows, or of ``pairs`` of an anchor and a row."""
        a, r = (np.s_[:, None], np.s_[None, :]) if pairs is None else pairs
        code, aligned = codes.codes[:, level], codes.aligned[:, : level + 1]
        ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
        # With rows as the last axis, whole anchors are compared with whole stretches of rows.
        counts = 0
        for b in range(self.planes.shape[1]):
            plane = self.planes[:, b]
            hits = sum(np.bitwise_count(plane[:, w][a] & code[:, w][r]).astype(np.float32) for w in range(code.shape[1]))
            counts = counts + (1 << b) * hits
        product = 2 * (self.low[a] * ones[r] + self.step[a] * counts) - self.total[a]
        estimate = so_far + aligned[:, level][r] * product
        sure = np.maximum(np.abs(product) - self.error[a], 0)
        across = np.sqrt(np.maximum(self.norm[a] ** 2 - sure**2 / self.dims, 0))
        size = codes.rest[:, level] + np.sqrt(self.dims) * aligned.sum(axis=1)
        spread = codes.rest[:, level][r] * across + aligned.sum(axis=1)[r] * self.error[a] + 1e-7 * (self.norm[a] * size[r]) + 1e-6
        return estimate - spread, estimate + spread, estimate


class Best:
    """The ``k`` best rows of each group by score, then smaller id; equal rows are rows of their own."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.score = np.full((groups, k), _NONE)
        self.id = np.zeros((groups, k), np.int64)
        self.row = np.full((groups, k), -1)

    def last(self) -> np.ndarray:
        """The score that a row must reach, ties included."""
        return self.score[:, -1]

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if not len(group):
            return
        old = np.repeat(np.unique(group), self.k)
        slot = np.tile(np.arange(self.k), len(old) // self.k)
        group, score = np.concatenate((old, group)), np.concatenate((self.score[old, slot], score))
        ids, rows = np.concatenate((self.id[old, slot], ids)), np.concatenate((self.row[old, slot], rows))
        order = np.lexsort((rows, ids, -score, group))
        group = group[order]
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        place = np.arange(len(group)) - np.repeat(first, np.diff(np.concatenate((first, [len(group)]))))
        kept = place < self.k
        order, group, place = order[kept], group[kept], place[kept]
        self.score[group, place], self.id[group, place], self.row[group, place] = score[order], ids[order], rows[order]


@dataclasses.dataclass
class Block:
    """Anchors of one pass, sorted by label. ``low`` and ``high`` are the wanted scores ``(anchors, slots)``, limits included,
    and ``least`` what a row must reach beyond ``low``."""

    ids: np.ndarray
    labels: np.ndarray
    ints: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray


def vectors(column: pa.Array, dims: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """``(usable, ints)``: rows without any null or non-finite component, and ``floor(scale * x)``, shorter vectors filled
    up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    usable = np.zeros(len(column), bool)
    out = np.zeros((len(column), dims), np.int64)
    column = pa.array(column.to_pylist(), pa.list_(pa.float64())) if not pa.types.is_list(column.type) else column
    there = column.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.where(there, np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)), 0).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), lengths)
    bad = np.bincount(row[~np.isfinite(flat)], minlength=len(column)) > 0
    usable = there & ~bad
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    fine = usable[row]
    whole = np.floor(scale * flat[fine])
    if len(whole) and (np.abs(whole).max() >= 2.0**30 or (np.bincount(row[fine], whole * whole) >= 2.0**62).any()):
        raise ValueError("components too large for exact 64-bit scores")
    out[row[fine], place[fine]] = whole.astype(np.int64)
    return usable, out


def _int_matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dims)


def code_index(embeddings: DataFrame, dims: int, *, scale: float = 256.0, levels: int = LEVELS) -> DataFrame:
    """``(vec_id, label, ints, codes, aligned, rest)`` of the rows that take part, as fixed-width binary columns."""
    turn = rotation(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                usable, ints = vectors(part.column(2), dims, scale)
                usable &= part.column(0).is_valid().to_numpy(zero_copy_only=False) & part.column(1).is_valid().to_numpy(zero_copy_only=False)
                ints = ints[usable]
                coded = Codes.of(ints, turn, levels)
                packed = [pa.array([x.tobytes() for x in m], pa.binary()) for m in (ints, coded.codes, coded.aligned, coded.rest)]
                keep = pa.array(usable)
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep), *packed], ["vec_id", "label", "ints", "codes", "aligned", "rest"])

    ship(embeddings.sparkSession)
    return embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), "embedding").mapInArrow(run, _INDEX)


def _search(index: DataFrame, block: Block, dims: int, levels: int, k: int, same_label: bool) -> DataFrame:
    """``(anchor int, id long, score long)``: of each partition, the rows that are among its ``k`` best for any slot of an
    anchor, with rows of the same label or of other labels. ``anchor`` is the number in the block."""
    turn = rotation(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, slots = block.low.shape
        best = Best(n * slots, k)
        spans = [(i, min(n, i + _ANCHORS)) for i in range(0, n, _ANCHORS)]
        asked = [Queries(block.ints[a:b], turn) for a, b in spans]
        seen, size = 0, 256
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size)
                at += part.num_rows
                ids = part.column(0).to_numpy()
                both, _ = pd.factorize(np.concatenate((block.labels, np.array(part.column(1).to_pylist(), object))))
                own, labels = both[:n], both[n:]
                ints = _int_matrix(part.column(2), dims)
                words, shape = (dims + 63) // 64, (part.num_rows, levels)
                codes = Codes(*[np.frombuffer(b"".join(part.column(c).to_pylist()), t).reshape(*shape, *x)
                                for c, t, x in ((3, np.uint64, (words,)), (4, np.float64, ()), (5, np.float64, ()))])
                for (a, b), queries in zip(spans, asked):
                    rows = np.flatnonzero(np.isin(labels, own[a:b])) if same_label else np.arange(len(ids))
                    if len(rows):
                        _compare(block, (a, b), queries, ids, own[a:b], labels, ints, codes, rows, seen, best, levels, same_label)
                seen += part.num_rows
                # Small steps first: after them most rows meet anchors that have partners.
                size = min(_ROWS, 2 * size)
        found = best.row >= 0
        anchor = np.repeat(np.arange(n), slots * k).reshape(best.row.shape)
        pairs = pd.DataFrame({"anchor": anchor[found], "row": best.row[found], "id": best.id[found], "score": best.score[found]})
        pairs = pairs.drop_duplicates(["anchor", "row"])
        for at in range(0, len(pairs), 100_000):
            p = pairs.iloc[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(p["anchor"], pa.int32()), pa.array(p["id"], pa.int64()), pa.array(p["score"], pa.int64())], ["anchor", "id", "score"])

    return index.mapInArrow(run, "anchor int, id long, score long")


def _compare(block: Block, span, queries: Queries, ids, own, labels, ints, codes: Codes, rows, seen, best: Best, levels, same_label) -> None:
    """Bring the rows of a step to the best of some anchors."""
    a, b = span
    slots = block.low.shape[1]
    least = np.maximum(np.maximum(block.low[a:b], block.least[a:b]), best.last().reshape(-1, slots)[a:b])
    high = block.high[a:b]

    def open_slots(lower, upper, anchor) -> np.ndarray:
        """Whether a row may be wanted in any slot."""
        return reduce(np.logical_or, ((upper >= least[:, s][anchor]) & (lower <= high[:, s][anchor]) for s in range(slots)))

    near = codes.take(rows)
    lower, upper, estimate = queries.bounds(near, None, 0)
    wanted = open_slots(lower, upper, np.s_[:, None])
    equal = own[:, None] == labels[rows][None, :]
    wanted &= equal if same_label else ~equal
    wanted &= block.ids[a:b][:, None] != ids[rows][None, :]
    anchor, row = np.nonzero(wanted)
    estimate = estimate[anchor, row]
    for level in range(1, levels):
        lower, upper, estimate = queries.bounds(near, (anchor, row), level, estimate)
        wanted = open_slots(lower, upper, anchor)
        anchor, row, estimate = anchor[wanted], row[wanted], estimate[wanted]
    row = rows[row]
    score = np.empty(len(row), np.int64)
    for at in range(0, len(row), 1 << 16):
        some = np.s_[at : at + (1 << 16)]
        score[some] = np.einsum("ij,ij->i", block.ints[a:b][anchor[some]], ints[row[some]])
    for s in range(slots):
        fits = (score >= least[:, s][anchor]) & (score <= high[:, s][anchor])
        best.add((a + anchor[fits]) * slots + s, score[fits], ids[row[fits]], seen + row[fits])


def _blocks(anchors: DataFrame, dims: int, block_bytes: int) -> Iterator[Block]:
    """The anchors in blocks of bounded size, which pass through the driver one after the other."""
    size = max(1, block_bytes // (8 * max(dims, 1)))
    held: list = []

    def block() -> Block:
        held.sort(key=lambda r: (r["label"], r["vec_id"]))
        ints = np.frombuffer(b"".join(bytes(r["ints"]) for r in held), np.int64).reshape(-1, dims)
        ids, labels = np.array([r["vec_id"] for r in held], np.int64), np.array([r["label"] for r in held], object)
        any_score = np.full((len(held), 1), _NONE)
        return Block(ids, labels, ints, any_score, -any_score, any_score)

    for row in anchors.select("vec_id", "label", "ints").toLocalIterator():
        held.append(row)
        if len(held) == size:
            yield block()
            held = []
    if held:
        yield block()


def _filled(rows: pa.Table, n: int, k: int, *names: str) -> list[np.ndarray]:
    out = [np.full((n, k), _NONE) for _ in names]
    at = rows.column("anchor").to_numpy(), rows.column("rank").to_numpy() - 1
    for matrix, name in zip(out, names):
        matrix[at] = rows.column(name).to_numpy()
    return out


def hard_negatives(
    embeddings: DataFrame, is_anchor: Column, *, n_positives: int = 5, n_negatives: int = 5, low_pct: int = 80, high_pct: int = 100,
    scale: float = 256.0, levels: int = LEVELS, block_bytes: int = BLOCK_BYTES, first_share: int = FIRST_SHARE,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for ``(vec_id, label, embedding)``.

    Scores are inner products of ``floor(scale * x)``; higher come first, then smaller ids. An anchor's positives are its first
    ``n_positives`` other rows of the same label, and each gets the first ``n_negatives`` rows of other labels whose score is
    from ``low_pct`` to ``high_pct`` per cent of its own. ``is_anchor`` is a condition on ``vec_id``.

    Rows with a null id, label or vector or any null or non-finite component take no part. Rows that repeat an id are rows of
    their own, but none is the partner of a row of its own id; a repeated anchor repeats its result. Vectors that are shorter
    than the longest are filled up with zeros. An empty table, or one without anchors, gives no rows; extra columns are ignored.
    Components must fit in 30 bits after scaling, else a ValueError is raised.
    """
    spark = embeddings.sparkSession
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    dims = embeddings.agg(F.max(F.size("embedding"))).first()[0]
    if dims is None or dims < 0:
        return spark.createDataFrame([], result)
    dims = max(dims, 1)
    share = F.pmod(F.xxhash64("vec_id", "ints"), F.lit(first_share)) == 0
    rows = store(code_index(embeddings, dims, scale=scale, levels=levels).withColumn("first", share))
    # Two tables, so that neither search reads the rows of the other.
    shares = [store(rows.where(c).drop("first")) for c in ("first", "not first")]
    anchors = store(rows.where(is_anchor).select("vec_id", "label", "ints"))
    path, done = scratch_path(spark, "negatives"), []

    def search(block: Block, k: int, same_label: bool, merge) -> DataFrame:
        """All rows against a block: what the first share finds is the least that others must reach."""
        first = store(_search(shares[0], block, dims, levels, k, same_label))
        (least,) = _filled(merge(first).where(F.col("rank") == k).withColumn("rank", F.col("slot")).toArrow(), *block.low.shape, "score")
        others = _search(shares[1], dataclasses.replace(block, least=least), dims, levels, k, same_label)
        return merge(first.unionByName(others))

    for block in _blocks(anchors, dims, block_bytes):
        in_order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id")
        positives = search(
            block, n_positives, True,
            lambda found: found.select("*", F.lit(1).alias("slot"), F.row_number().over(in_order).alias("rank")).where(F.col("rank") <= n_positives),
        ).toArrow()
        if not positives.num_rows:
            continue
        scores, ids = _filled(positives, len(block.ids), n_positives, "score", "id")
        there = scores > _NONE
        # An empty range stands for a positive that is not there.
        low, high = np.where(there, -((-low_pct * scores) // 100), -_NONE), np.where(there, (high_pct * scores) // 100, _NONE)
        anchor, place = np.nonzero(there)
        wanted = spark.createDataFrame(pa.table({
            "anchor": pa.array(anchor, pa.int32()), "slot": pa.array(place + 1, pa.int32()), "anchor_id": block.ids[anchor], "positive_id": ids[there],
            "positive_score": scores[there], "low": low[there], "high": high[there],
        }))
        in_order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "id")

        def merge(found: DataFrame) -> DataFrame:
            fits = found.join(F.broadcast(wanted), "anchor").where(F.col("score").between(F.col("low"), F.col("high")))  # noqa: B023
            return fits.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= n_negatives)  # noqa: B023

        mined = search(dataclasses.replace(block, low=low, high=high, least=low), n_negatives, False, merge)
        done.append(f"{path}/{len(done)}")
        mined.select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        ).write.parquet(done[-1])
    return spark.read.schema(result).parquet(*done) if done else spark.createDataFrame([], result)

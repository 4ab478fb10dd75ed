"""Removal of repeated byte strings by external induced sorting.

Every suffix whose first ``length`` bytes also start earlier in the corpus is found, without a suffix array of
the whole corpus in any memory:

1. **Sample suffixes.** Of each window of ``length`` bytes the ``gram`` bytes with the least hash are its anchor, so
   equal windows have equal anchors at equal places. Only anchors whose hash occurs more than once can
   belong to a repeated window; one disk-backed sort by hash finds them.
2. **Order of the sample.** The text around each remaining anchor is cut out and sorted by anchor, then by the
   bytes that follow it: a shuffle into shards with Spark's external sort, which spills to disk, so a shard may be
   far larger than memory. The sorted stream carries the suffixes and their common prefixes.
3. **Induction.** The suffixes that start one byte further left are sorted by putting that byte before the order
   already known, which is one stable bucket pass; repeated for every start whose window has the anchor.
   Two neighbours are equal windows if all bytes on the left agree and their common prefix to the right, a
   range minimum over step 2, is long enough. Within a run of equal windows all but the earliest are
   repeats.

Equal pieces of text are collapsed as they stream by, so copies cost one comparison each. An anchor with
more distinct surroundings than ``max_group`` is not held in memory: its windows are aggregated by their
128-bit hash instead, which gives the same answer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordered import running
from ..session import store
from .buffers import utf8_slices
from .shipping import ship

LENGTH, GRAM = 100, 24
MAX_GROUP = 100_000
_CHUNK_ROWS = 30_000
_MATRIX_ROWS = 8_000
_CHUNK_BYTES = 4 << 20
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_POS = np.uint64((1 << 28) - 1)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes (a multiple of 8) from each position."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    padded = np.ascontiguousarray(data)
    view = np.ndarray((len(data) - 7,), "<u8", padded.data, strides=(1,))
    with np.errstate(over="ignore"):
        h = view[:n] * _MIX[0]
        for k in range(1, gram // 8):
            h ^= h >> np.uint64(31)
            h += view[8 * k : 8 * k + n]
            h *= _MIX[k % 4]
        h ^= h >> np.uint64(32)
        h *= _MIX[3]
        h ^= h >> np.uint64(29)
    return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``(doc, hash, anchor, first, last)`` of the anchors of texts in ``data``: ``first..last`` are the starts of
    the windows that an anchor stands for, all positions within their text."""
    n = len(data) - length + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 5
    hashes = _gram_hashes(data, gram)
    marked = (hashes & ~_POS) | np.arange(len(hashes), dtype=np.uint64)
    chosen = (_sliding_min(marked, length - gram + 1)[:n] & _POS).astype(np.int64)
    # Windows inside one text: those that start where the text has at least ``length`` bytes left.
    sizes = np.diff(offsets)
    left = np.repeat(offsets[1:], sizes)[:n] - np.arange(n)
    starts = np.flatnonzero(left >= length)
    if not len(starts):
        return (np.empty(0, np.int64),) * 5
    chosen = chosen[starts]
    new = np.concatenate(([True], chosen[1:] != chosen[:-1]))
    first = starts[new]
    last = starts[np.append(np.flatnonzero(new)[1:], len(starts)) - 1]
    anchor = chosen[new]
    doc = np.searchsorted(offsets, first, side="right") - 1
    begin = offsets[doc]
    return doc, hashes[anchor].view(np.int64), anchor - begin, first - begin, last - begin


def _chunks(data: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """A long text in chunks that share ``length - 1`` bytes, so that each window is in one of them."""
    step = _CHUNK_BYTES
    for at in range(0, max(1, len(data) - length + 1), step):
        yield at, data[at : at + step + length - 1]


def _anchor_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in utf8_slices(batch.column(1), _CHUNK_BYTES):
                pieces = _chunks(data, length) if end - first == 1 else [(0, data)]
                for shift, part in pieces:
                    bounds = np.array([0, len(part)]) if end - first == 1 else offsets
                    doc, hashed, at, low, high = anchors(part, bounds, length, gram)
                    # Position, and how far left and right the window starts reach, in one number.
                    place = (at + shift) << 32 | (at - low) << 16 | (at - high)
                    own = batch.column(0).slice(first, end - first).take(pa.array(doc))
                    yield pa.RecordBatch.from_arrays([pa.array(hashed), own, pa.array(place)], ["hash", "doc", "place"])

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a stream sorted by hash whose hash occurs more than once; holds one row between batches."""
    held, known = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        same = keys[1:] == keys[:-1]
        joined = held is not None and held.column(0)[0].as_py() == keys[0]
        keep = np.concatenate((same, [False])) | np.concatenate(([joined], same))
        if held is not None and (known or joined):
            yield held.select(["doc", "place"])
        keep_last, keep[-1] = bool(keep[-1]), False
        yield batch.filter(pa.array(keep)).select(["doc", "place"])
        held, known = batch.slice(batch.num_rows - 1), keep_last
    if held is not None and known:
        yield held.select(["doc", "place"])


def _cut(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """Binary array of the stretches ``data[start : start + size]``."""
    upto = np.concatenate(([0], np.cumsum(size)))
    flat = data[np.arange(upto[-1]) + np.repeat(start - upto[:-1], size)]
    buffers = [None, pa.py_buffer(upto.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(size), buffers)


def _surroundings(length: int):
    """Around each anchor the text of its windows: bytes from the anchor on, bytes before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in utf8_slices(batch.column(1), _CHUNK_BYTES):
                places = batch.column(2).slice(first, end - first)
                counts = np.diff(places.offsets.to_numpy())
                every = places.flatten().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(end - first), counts)
                for i in range(0, len(every), _CHUNK_ROWS):
                    place, row = every[i : i + _CHUNK_ROWS], doc[i : i + _CHUNK_ROWS]
                    at = offsets[row] + (place >> 32)
                    left, right = (place >> 16) & 0xFFFF, length - (place & 0xFFFF)
                    own = batch.column(0).slice(first, end - first).take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [_cut(data, at, right), _cut(data, at - left, left), own, pa.array((place >> 32) - left)],
                        ["right", "left", "doc", "low"],
                    )

    return run


_MARKS = "doc long, low long, high long, key1 long, key2 long"


def _marks(doc, low, high, keys: np.ndarray | None = None) -> pa.RecordBatch:
    n = len(low)
    k = [pa.nulls(n, pa.int64())] * 2 if keys is None else [pa.array(np.ascontiguousarray(keys[:, j]).view(np.int64)) for j in (0, 1)]
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()), *k], ["doc", "low", "high", "key1", "key2"]
    )


def _matrix(column: pa.Array, width: int, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Binary values as rows of a zero-padded matrix, from their end if ``reverse``, and their sizes."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    sizes = np.diff(offsets)
    flat = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    out = np.zeros((len(column), width), np.uint8)
    # In slices, as there are several numbers for every byte.
    for i in range(0, len(column), _MATRIX_ROWS):
        size, first = sizes[i : i + _MATRIX_ROWS], offsets[:-1][i : i + _MATRIX_ROWS]
        row = np.repeat(np.arange(i, i + len(size)), size)
        at = np.arange(first[0], first[-1] + size[-1])
        col = at - np.repeat(first, size)
        out[row, (np.repeat(size, size) - 1 - col) if reverse else col] = flat[at]
    return out, sizes


class _Induction:
    """Repeated windows of one chunk of rows, sorted by right and left text, document and place."""

    def __init__(self, length: int, gram: int, max_group: int):
        self.length, self.gram, self.reach, self.max_group = length, gram, length - gram + 1, max_group
        self.crowded: bytes | None = None  # an anchor whose rows were handed on as windows

    def rows(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        column = lambda n: table.column(n).chunk(0) if table.column(n).num_chunks else None
        if not table.num_rows:
            return
        doc, low = (column(n).to_numpy(zero_copy_only=False) for n in ("doc", "low"))
        right, n_right = _matrix(column("right"), self.length)
        left, n_left = _matrix(column("left"), self.reach, reverse=True)
        # Rows of one anchor are neighbours, as the right side starts with it.
        keys = np.concatenate(([0], np.cumsum((right[1:, : self.gram] != right[:-1, : self.gram]).any(axis=1))))
        copy = np.zeros(len(keys), bool)
        copy[1:] = (
            (keys[1:] == keys[:-1]) & (n_right[1:] == n_right[:-1]) & (n_left[1:] == n_left[:-1])
            & (right[1:] == right[:-1]).all(axis=1) & (left[1:] == left[:-1]).all(axis=1)
        )
        if copy.any():
            # An equal stretch of text starts earlier, so all of its windows do.
            yield _marks(doc[copy], low[copy], (low + n_left + n_right)[copy])
        _, group, count = np.unique(keys[~copy], return_inverse=True, return_counts=True)
        single = np.flatnonzero(~copy)
        crowded = count[group] > self.max_group
        if self.crowded is not None:
            crowded |= (right[single, : self.gram] == np.frombuffer(self.crowded, np.uint8)).all(axis=1)
        keep, big = single[(count[group] > 1) & ~crowded], single[crowded]
        if len(big):
            for i in range(0, len(big), 2_000):
                part = big[i : i + 2_000]
                yield from self.windows(right[part], left[part], n_right[part], n_left[part], doc[part], low[part])
        if len(keep):
            found = self.induce(keys[keep], right[keep], n_right[keep], left[keep], n_left[keep], doc[keep], low[keep])
            yield from found

    def induce(self, keys, right, n_right, left, n_left, doc, low) -> Iterator[pa.RecordBatch]:
        n = len(keys)
        # Common prefixes of neighbours to the right of the anchor, and range minima over them.
        differs = right[1:] != right[:-1]
        prefix = np.where(differs.any(axis=1), differs.argmax(axis=1), self.length)
        prefix = np.minimum(prefix, np.minimum(n_right[1:], n_right[:-1]))
        prefix = np.concatenate(([0], np.where(keys[1:] == keys[:-1], prefix, 0))).astype(np.int16)
        minima = [prefix]
        while 2 << (len(minima) - 1) <= n:
            half = 1 << (len(minima) - 1)
            minima.append(np.minimum(minima[-1][:-half], minima[-1][half:]))
        nearest = self.length - n_right  # starts that are less far left are not this anchor's
        rank = np.empty(n, np.int64)
        rank[np.lexsort((low + n_left, doc))] = np.arange(n)
        repeat = np.zeros((n, self.reach), bool)
        order, same_left = np.arange(n), np.zeros(n, np.int64)
        for back in range(self.reach):
            if back:
                # Induce: put the byte further left before the known order, one stable bucket pass.
                order = order[n_left[order] >= back]
                first = left[order, back - 1]
                by = np.argsort(first, kind="stable")
                order, first = order[by], first[by]
                if not len(order):
                    break
                was = same_left[order]
                new = np.concatenate(([True], (first[1:] != first[:-1]) | (was[1:] != was[:-1])))
                number = np.cumsum(new) - 1
                same_left[order] = number
                # A suffix alone with its bytes on the left stays alone further left.
                order = order[np.bincount(number)[number] > 1]
            valid = order[nearest[order] <= back]
            if len(valid) < 2:
                continue
            a, b = valid[:-1], valid[1:]
            equal = same_left[a] == same_left[b]
            a, b = a[equal], b[equal]
            width = b - a
            level = np.frexp(width)[1] - 1
            common = np.empty(len(a), np.int16)
            for k in np.unique(level):
                at = np.flatnonzero(level == k)
                m = minima[k]
                common[at] = np.minimum(m[a[at] + 1], m[b[at] - (1 << int(k)) + 1])
            chained = np.flatnonzero(equal)[common >= self.length - back]
            if not len(chained):
                continue
            inside = np.zeros(len(valid), bool)
            inside[chained] = inside[chained + 1] = True
            starts = np.ones(len(valid), bool)
            starts[chained + 1] = False
            members = valid[inside]
            runs = np.flatnonzero(starts[inside])
            earliest = np.repeat(np.minimum.reduceat(rank[members], runs), np.diff(np.append(runs, len(members))))
            repeat[members[rank[members] != earliest], back] = True
        edge = np.zeros((n, self.reach + 2), np.int8)
        edge[:, 1:-1] = repeat
        step = np.diff(edge, axis=1)
        row, near = np.nonzero(step == 1)
        _, far = np.nonzero(step == -1)
        anchor = low[row] + n_left[row]
        if len(row):
            yield _marks(doc[row], anchor - far + 1, anchor - near + self.length)

    def windows(self, right, left, n_right, n_left, doc, low) -> Iterator[pa.RecordBatch]:
        """Every window of the rows with its hash, for anchors with too many different surroundings."""
        docs, lows, keys = [], [], []
        for i in range(len(low)):
            text = left[i, : n_left[i]][::-1].tobytes() + right[i, : n_right[i]].tobytes()
            for s in range(len(text) - self.length + 1):
                keys.append(xxhash.xxh3_128_digest(text[s : s + self.length]))
                docs.append(doc[i])
                lows.append(low[i] + s)
        lows = np.array(lows, np.int64)
        yield _marks(np.array(docs), lows, lows + self.length, np.frombuffer(b"".join(keys), ">u8").astype(np.uint64).reshape(-1, 2))

    def last_anchor(self, table: pa.Table) -> int:
        """First row of the last anchor."""
        last = table.column("right")[-1].as_py()[: self.gram]
        low, high = 0, table.num_rows - 1
        while low < high:
            middle = (low + high) // 2
            if table.column("right")[middle].as_py()[: self.gram] < last:
                low = middle + 1
            else:
                high = middle
        return low

    def stream(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        self.crowded, held, n_held, before = None, [], 0, None
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK_ROWS):
                chunk = batch.slice(at, _CHUNK_ROWS)
                fresh, copies = self.without_copies(chunk, before)
                before = chunk.slice(chunk.num_rows - 1)
                if copies.num_rows:
                    yield copies
                held.append(fresh)
                n_held += fresh.num_rows
                if n_held < _CHUNK_ROWS:
                    continue
                table = pa.Table.from_batches(held)
                cut = self.last_anchor(table)
                if cut:
                    yield from self.rows(table.slice(0, cut))
                    table = table.slice(cut)
                elif n_held > self.max_group:
                    # One anchor fills it all, with too many different rows: hand on their windows.
                    self.crowded = table.column("right")[0].as_py()[: self.gram]
                    yield from self.rows(table)
                    table = table.slice(0, 0)
                held, n_held = table.to_batches(), table.num_rows
        if held:
            yield from self.rows(pa.Table.from_batches(held))

    def without_copies(self, chunk: pa.RecordBatch, before: pa.RecordBatch | None) -> tuple[pa.RecordBatch, pa.RecordBatch]:
        """Rows whose text differs from that of the row before, and the marks of the others: an equal stretch of text
        starts earlier, so all of its windows do. ``before`` is the last row of the chunk before."""
        copy = np.ones(chunk.num_rows, bool)
        for name in ("right", "left"):
            column = chunk.column(name)
            copy[1:] &= pc.equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
            copy[:1] &= before is not None and before.column(name)[0] == column[0]
        doc, low = (chunk.column(n).to_numpy(zero_copy_only=False) for n in ("doc", "low"))
        size = sum(pc.binary_length(chunk.column(n)).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("right", "left"))
        return chunk.filter(pa.array(~copy)), _marks(doc[copy], low[copy], (low + size)[copy])


def _spans(marks: DataFrame) -> DataFrame:
    """Marked stretches ``(doc, low, high)``; of windows given by their hash all but the earliest."""
    own = [F.coalesce("key1", "doc"), F.coalesce("key2", F.lit(0))]
    first = F.min(F.when(F.col("key1").isNotNull(), F.struct("doc", "low"))).over(Window.partitionBy(*own))
    later = marks.withColumn("first", first).where("key1 IS NULL OR struct(doc, low) > first")
    return later.select("doc", "low", "high")


def _copies(docs: DataFrame, length: int) -> DataFrame:
    """``(doc, n_bytes)`` of the documents of ``length`` bytes or more whose whole text is that of an earlier one."""
    rows = docs.select("doc", F.octet_length("text").cast("long").alias("n_bytes"), F.md5(F.col("text").cast("binary")).alias("digest"))
    rows = rows.where(F.col("n_bytes") >= length)
    first = rows.groupBy("digest", "n_bytes").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(first, ["digest", "n_bytes"]).where("doc > first").select("doc", "n_bytes")


def repeated_spans(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, max_group: int = MAX_GROUP) -> DataFrame:
    """``(doc, spans)`` from ``(doc long, text)`` with distinct ids and no null: stretches ``struct(low, high)`` of bytes
    covered by repeated windows. They may overlap and come in any order; their union is what is to be removed.

    Copies of whole texts are found by length and digest and go as one stretch; only the first is cut up.
    """
    ship(docs.sparkSession)
    copies = store(_copies(docs, length))
    rows = docs.mapInArrow(_anchor_rows(length, gram), "hash long, doc long, place long")
    sorted_rows = rows.repartition("hash").sortWithinPartitions("hash")
    places = sorted_rows.mapInArrow(_repeated, "doc long, place long").groupBy("doc").agg(F.collect_list("place").alias("places"))
    places = places.join(copies, "doc", "left_anti")
    cut = docs.join(places, "doc").select("doc", "text", "places")
    around = cut.mapInArrow(_surroundings(length), "right binary, left binary, doc long, low long")
    shards = around.repartition(F.xxhash64(F.substring("right", 1, gram))).sortWithinPartitions("right", "left", "doc", "low")
    marks = _spans(shards.mapInArrow(_Induction(length, gram, max_group).stream, _MARKS))
    marks = marks.unionByName(copies.select("doc", F.lit(0).cast("long").alias("low"), F.col("n_bytes").alias("high")))
    return marks.groupBy("doc").agg(F.collect_list(F.struct("low", "high")).alias("spans"))


def _removed(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in utf8_slices(batch.column(1), _CHUNK_BYTES):
                spans = batch.column(2).slice(first, end - first).to_pylist()
                n_removed, n_spans, kept = [], [], []
                raw = data.tobytes()
                for i in range(end - first):
                    text = raw[offsets[i] : offsets[i + 1]]
                    runs = _union(spans[i] or ())
                    n_removed.append(sum(b - a for a, b in runs))
                    n_spans.append(len(runs))
                    edges = [0, *[x for r in runs for x in r], len(text)]
                    rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    kept.append(hashlib.sha256(rest).hexdigest() if digest else rest)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(np.diff(offsets)), pa.array(n_removed, pa.int64()),
                     pa.array(n_spans, pa.int64()), pa.array(kept, pa.string() if digest else pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return run


def _union(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in sorted((s["low"], s["high"]) for s in spans):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, max_group: int = MAX_GROUP, digest: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)``, one row per input row: ``kept`` is what is left of the text's
    UTF-8 bytes (its SHA-256 in hex with ``digest``), ``n_spans`` counts maximal removed runs.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document with a smaller
    id, or at an earlier place of the same one. Matches never cross documents; strings are judged on
    the input; ``length`` is at most 65,535. Null is the empty text. Null ids come before all others. Rows that repeat an id are ordered by
    the hash of their text; rows that repeat id and text are one document and get one result each.
    Other columns are ignored; an empty table gives no rows.
    """
    if length > 0xFFFF:
        raise ValueError(f"length {length} is above 65535")
    text = F.coalesce("text", F.lit("")).alias("text")
    kind = docs.schema["doc_id"].dataType
    parameters = {"length": length, "gram": gram, "max_group": max_group}
    schema = f"doc_id {kind.simpleString()}, n_bytes long, n_removed long, n_spans long, kept {'string' if digest else 'binary'}"
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if isinstance(kind, T.LongType) and ids.where("n > 1 OR doc_id IS NULL").isEmpty():
        # No id is null here; saying so makes both joins read the same shuffle of the texts.
        rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("doc"), text)
        joined = rows.join(repeated_spans(rows, **parameters), "doc", "left").select("doc", "text", "spans")
        return joined.mapInArrow(_removed(digest), schema)
    # Other ids are numbered in their order first.
    hashed = docs.select(F.col("doc_id").alias("__id"), text).withColumn("__hash", F.xxhash64("text"))
    order = hashed.select("__id", "__hash").distinct().withColumn("n", F.lit(1).cast("long"))
    order = running(order, ["__id", "__hash"], sums=["n"])
    order = store(order.select(F.col("__id").alias("__i"), F.col("__hash").alias("__h"), F.col("n_before").alias("doc")))
    same = F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__hash") == F.col("__h"))
    own = store(hashed.join(order, same).select("__id", "doc", "text"))
    rows = own.groupBy("doc").agg(F.first("text").alias("text"))
    joined = own.join(repeated_spans(rows, **parameters), "doc", "left").select("__id", "text", "spans")
    return joined.mapInArrow(_removed(digest), schema)

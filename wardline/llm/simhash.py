"""Near-duplicates by SimHash with anchor-point covering.

A fingerprint of 64 bits is cut into ``distance // 2 + 1`` blocks, so that of two fingerprints within
``distance`` at least one block differs in at most one bit. The anchors of a block are the words of a
covering code: a perfect Hamming code on its first ``2^r - 1`` bits (covering radius one), any value on the
others. A fingerprint is at home at its nearest anchor, and is repeated to every anchor that may be the
home of a block one bit away, all of them within radius one plus that one bit. Homes and visitors are
compared per anchor, where each connected group of links is emitted as a star, never as all its pairs.
With two blocks of 32 bits there are 2^27 anchors a block and 34 rows a fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .buffers import utf8_slices
from .components import components
from .shipping import ship

SEED = 42
_SHINGLES_PER_STEP = 1 << 18
_PAIRS_PER_STEP = 1 << 21
# An anchor key has the block's bits below and the number of the block from this bit on.
_TAG_SHIFT = 58


def _word_bounds(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Words joined by single spaces, and the start and end of each."""
    joined = b" ".join(text.split())
    if not joined:
        return joined, np.empty(0, np.int64), np.empty(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    return joined, np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(joined)]))


def simhash(text: bytes, words: int = 3) -> bytes:
    """Fingerprint of a text, 8 bytes: a bit is set if it is set in over half of the shingles' hashes.

    Words are runs without ASCII white space after lower-casing A-Z; shingles are ``words`` words joined by
    a space, repeats included, hashed by XXH64 with seed 42. Fewer words make one shingle, none the
    fingerprint zero.
    """
    joined, starts, ends = _word_bounds(text.lower())
    if not len(starts):
        return bytes(8)
    n = max(1, len(starts) - words + 1)
    ends = ends[min(words, len(ends)) - 1 :]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, _SHINGLES_PER_STEP):
        part = zip(starts[i : min(n, i + _SHINGLES_PER_STEP)].tolist(), ends[i : i + _SHINGLES_PER_STEP].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in part], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(docs: DataFrame, *, words: int = 3) -> DataFrame:
    """``(doc_id, fingerprint binary)``, one row per input row, over whole texts. Null is the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = []
            for first, end, data, offsets in utf8_slices(batch.column(1)):
                raw = data.tobytes()
                values += [simhash(raw[offsets[i] : offsets[i + 1]], words) for i in range(end - first)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], ["doc_id", "fingerprint"])

    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint binary")


def block_sizes(distance: int, bits: int = 64) -> list[int]:
    n = distance // 2 + 1
    return [bits * (i + 1) // n - bits * i // n for i in range(n)]


def anchors_of(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, anchor, home)`` for 64-bit fingerprints; the anchors of block ``b`` carry ``b`` in their top bits."""
    rows, keys, homes = [], [], []
    low = 0
    every = np.arange(len(values))
    for number, size in enumerate(block_sizes(distance)):
        block = (values >> np.uint64(low)) & np.uint64((1 << size) - 1)
        low += size
        # Bits 0 .. 2^r-2 of the block carry the Hamming code, the others are taken as they are.
        code_bits = (1 << ((size + 1).bit_length() - 1)) - 1
        syndrome = np.zeros(len(values), np.int64)
        for k in range(code_bits):
            syndrome ^= np.where((block >> np.uint64(k)) & np.uint64(1), k + 1, 0)
        nearest = np.where(syndrome > 0, block ^ (np.uint64(1) << (np.maximum(syndrome, 1) - 1).astype(np.uint64)), block)
        tag = np.uint64(number << _TAG_SHIFT)

        def add(which, anchors, home, tag=tag):
            rows.append(which), keys.append(anchors | tag), homes.append(np.full(len(which), home))

        add(every, nearest, True)
        for k in range(code_bits, size):
            add(every, nearest ^ np.uint64(1 << k), False)
        off = np.flatnonzero(syndrome)
        for i in range(1, code_bits + 1):
            j = i ^ syndrome[off]
            ok = j > i
            which = off[ok]
            flips = np.uint64(1 << (i - 1)) | (np.uint64(1) << (j[ok] - 1).astype(np.uint64))
            add(which, block[which] ^ flips, False)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def _words_of(column: pa.Array) -> np.ndarray:
    """64-bit words of a binary column of 8 bytes a row."""
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64)


def _stars(values: np.ndarray, keys: np.ndarray, homes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that connect what is linked at the anchors of sorted ``keys``: ``(member, centre)`` of stars."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(keys)])))
    group = np.repeat(np.arange(len(starts)), sizes)
    hosts = np.flatnonzero(homes & (sizes[group] > 1))
    label = np.arange(len(keys))
    reach = np.cumsum(sizes[group[hosts]])
    done = 0
    while done < len(hosts):
        end = max(done + 1, int(np.searchsorted(reach, (reach[done - 1] if done else 0) + _PAIRS_PER_STEP)))
        part = hosts[done:end]
        n = sizes[group[part]]
        a = np.repeat(part, n)
        b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[group[part]], n)
        near = np.bitwise_count(values[a] ^ values[b]) <= distance
        _merge(label, a[near], b[near])
        done = end
    members = np.flatnonzero(label != np.arange(len(label)))
    return members, label[members]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Lower ``label`` to the smallest row connected through the links."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            deeper = label[label]
            if (deeper == label).all():
                break
            label[:] = deeper


def linked_fingerprints(values: DataFrame, *, distance: int = 3) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct ``fingerprint`` values exactly as the pairs within the distance do.

    Each anchor's links come as a star around one of its fingerprints, so there are at most as many as rows.
    """
    ship(values.sparkSession)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 5_000):
                column = batch.column(0).slice(at, 5_000)
                rows, keys, homes = anchors_of(_words_of(column), distance)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), column.take(pa.array(rows)), pa.array(homes)], ["anchor", "fingerprint", "home"]
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stars(parts: list) -> pa.RecordBatch:
            keys, column, homes = (np.concatenate([p[0] for p in parts]), pa.chunked_array([p[1] for p in parts]).combine_chunks(),
                                   np.concatenate([p[2] for p in parts]))
            members, centres = _stars(_words_of(column), keys.view(np.uint64), homes, distance)
            return pa.RecordBatch.from_arrays([column.take(pa.array(members)), column.take(pa.array(centres))], ["a", "b"])

        held: list = []  # rows of the last anchor seen, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            part = (keys, batch.column(1), batch.column(2).to_numpy(zero_copy_only=False))
            cut = int(np.flatnonzero(keys == keys[-1])[0])
            head, tail = tuple(x[:cut] for x in part), tuple(x[cut:] for x in part)
            if cut:
                yield stars([*held, head])
                held = [tail]
            elif held and held[0][0][0] != keys[0]:
                yield stars(held)
                held = [tail]
            else:
                held.append(tail)
        if held:
            yield stars(held)

    spread_rows = values.select("fingerprint").distinct().mapInArrow(spread, "anchor long, fingerprint binary, home boolean")
    by_anchor = spread_rows.repartition("anchor").sortWithinPartitions("anchor", "fingerprint")
    return by_anchor.mapInArrow(compare, "a binary, b binary").distinct()


def near_duplicate_groups(docs: DataFrame, *, words: int = 3, distance: int = 3) -> DataFrame:
    """``(doc_id, fingerprint binary, component_id)``, one row per input row.

    Documents with equal fingerprints, and those whose fingerprints are linked (see the module), form a group.
    ``component_id`` is the smallest ``doc_id`` reachable, the row's own included. Copies count once
    in the comparison. Null ids are members, but a component's id is null only if it has no other; empty and
    null texts share the fingerprint zero. Extra columns are ignored; an empty table gives no rows.
    """
    table = store(fingerprints(docs, words=words))
    classes = store(table.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    roots = store(components(linked_fingerprints(classes, distance=distance)))
    joined = classes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    joined = joined.withColumn("root", F.coalesce("root", "fingerprint"))
    ids = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = joined.join(ids, "root").select("fingerprint", "component_id")
    return table.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, *, words: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` with one document of each group of ``near_duplicate_groups``, the one with the smallest id.

    Texts without words are a group like any other. Rows with null ids stay as they are; of rows that repeat
    an id all stay or none: they go if any text of that id is in a group with a smaller id.
    """
    known = docs.where(F.col("doc_id").isNotNull())
    groups = near_duplicate_groups(known, words=words, distance=distance)
    losers = groups.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__loser")).distinct()
    return docs.join(losers, docs["doc_id"] == F.col("__loser"), "left_anti")

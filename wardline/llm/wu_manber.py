"""Benchmark decontamination by Wu-Manber multi-pattern search.

Patterns are windows of consecutive words of the test items. For patterns of at least ``m`` bytes a shift
table says, for the hash of a block of ``B`` bytes, how far that block is from the end of the nearest pattern
prefix that holds it; a block in none lets the search skip ``m - B + 1`` positions. Where the shift is zero,
the bucket of the block's hash gives the patterns to compare directly.

The search steps through a slice of normalised text in many lanes at once, each a stretch of the text
with its own position, so that every step is a handful of array operations. Short and long patterns have
tables of their own, as the shortest pattern bounds every skip.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .buffers import utf8_slices
from .shipping import ship

# Windows of test items are sent to the executors in blocks of this many bytes, one pass each.
BLOCK_BYTES = 16 << 20
_TABLE_BITS = 21
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LANES = 8192
# Shortest length of each class of patterns.
_CLASSES = (1, 8, 24, 48)

# ASCII letters in lower case and digits are word bytes, as are all bytes of other characters.
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters (lower-cased), digits and non-ASCII characters."""
    return text.translate(_NORMAL).split()


def windows_of(text: bytes, window: int) -> set[bytes]:
    """Windows of ``window`` words, or the whole item if it has fewer but any, with a space at both ends."""
    words = words_of(text)
    if not words:
        return set()
    return {b" " + b" ".join(words[i : i + window]) + b" " for i in range(max(1, len(words) - window + 1))}


@dataclass
class Tables:
    """Search tables of one class of patterns."""

    m: int
    block: int
    shift: np.ndarray
    buckets: np.ndarray
    first: np.ndarray
    patterns: list[bytes]

    @staticmethod
    def of(patterns: Sequence[bytes]) -> Tables:
        m = min(map(len, patterns))
        block = min(8, m)
        prefixes = np.frombuffer(b"".join(p[:m] for p in patterns), np.uint8).reshape(-1, m)
        shift = np.full(1 << _TABLE_BITS, m - block + 1, np.uint16)
        hashes = np.empty(len(patterns), np.int64)
        for at in range(m - block + 1):
            hashes = _hash(_load(np.ascontiguousarray(prefixes[:, at : at + block])))
            np.minimum.at(shift, hashes, m - block - at)
        order = np.argsort(hashes, kind="stable")
        buckets, first = np.unique(hashes[order], return_index=True)
        return Tables(m, block, shift, buckets, np.append(first, len(order)), [patterns[i] for i in order])

    def find(self, text: bytes, view: np.ndarray, end: int) -> list[tuple[int, int]]:
        """``(position, pattern)`` of every occurrence in ``text[:end]``; ``view`` has the 8 bytes from each position."""
        last = end - self.m + 1
        if last <= 0:
            return []
        mask = np.uint64((1 << (8 * self.block)) - 1 if self.block < 8 else 0xFFFFFFFFFFFFFFFF)
        step = max(64, -(-last // _LANES))
        at = np.arange(0, last, step)
        stop = np.minimum(at + step, last)
        lead = self.m - self.block
        found = []
        while len(at):
            key = _hash(view[at + lead] & mask)
            skip = self.shift[key]
            zero = skip == 0
            if zero.any():
                found.append((at[zero], key[zero]))
            at = at + np.maximum(skip, 1)
            on = at < stop
            if not on.all():
                at, stop = at[on], stop[on]
        if not found:
            return []
        position, key = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        bucket = np.searchsorted(self.buckets, key)
        bucket[bucket == len(self.buckets)] = 0
        known = self.buckets[bucket] == key
        out = []
        for p, b in zip(position[known].tolist(), bucket[known].tolist()):
            for i in range(self.first[b], self.first[b + 1]):
                if text.startswith(self.patterns[i], p):
                    out.append((p, i))
        return out


def _load(blocks: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(blocks), 8), np.uint8)
    wide[:, : blocks.shape[1]] = blocks
    return wide.view("<u8").ravel()


def _hash(words: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((words * _MIX) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


class Searcher:
    """Tables of a block of test items: ``items`` are ``(item id, windows)``."""

    def __init__(self, items: Sequence[tuple[object, set[bytes]]]):
        owners: dict[bytes, list] = {}
        for item, windows in items:
            for w in windows:
                owners.setdefault(w, []).append(item)
        self.owners = owners
        self.tables = []
        ordered = sorted(owners, key=lambda p: (len(p), p))
        for low, high in zip(_CLASSES, [*_CLASSES[1:], 1 << 62]):
            if part := [p for p in ordered if low <= len(p) < high]:
                self.tables.append(Tables.of(part))

    def search(self, texts: list[bytes]) -> tuple[np.ndarray, dict[int, tuple[list[tuple[int, int]], set]]]:
        """Words of each text, and for texts with any hit the word runs ``(first, end)`` and the items found."""
        joined = (b" " + b" \n ".join(texts) + b" ")
        raw = np.frombuffer(joined, np.uint8)
        blank = raw == 32
        flat = raw[~(blank & np.concatenate(([False], blank[:-1])))]
        size = len(flat)
        breaks = np.flatnonzero(flat == 10)
        begin, finish = np.concatenate(([0], breaks + 1)), np.concatenate((breaks, [size]))
        spaces = np.flatnonzero(flat == 32)
        first_space = np.searchsorted(spaces, begin)
        n_words = np.searchsorted(spaces, finish) - first_space - 1
        text = flat.tobytes() + bytes(8)
        padded = np.frombuffer(text, np.uint8)
        view = np.ndarray((size + 1,), "<u8", padded.data, strides=(1,))
        hits: dict[int, tuple[list, set]] = {}
        for tables in self.tables:
            for position, which in tables.find(text, view, size):
                pattern = tables.patterns[which]
                doc = int(np.searchsorted(begin, position, side="right")) - 1
                word = int(np.searchsorted(spaces, position)) - int(first_space[doc])
                runs, items = hits.setdefault(doc, ([], set()))
                runs.append((word, word + pattern.count(b" ") - 1))
                items.update(self.owners[pattern])
        return n_words, hits


def _merged(runs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def item_blocks(items: DataFrame, window: int, block_bytes: int = BLOCK_BYTES) -> Iterator[Searcher]:
    """Search tables for blocks of the items, read one partition at a time. Null ids and texts are no items."""
    block, held = [], 0
    for row in items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator():
        windows = windows_of(row["text"].encode(), window)
        block.append((row["item_id"], windows))
        held += sum(map(len, windows))
        if held >= block_bytes:
            yield Searcher(block)
            block, held = [], 0
    if block:
        yield Searcher(block)


HITS = "n_words long, runs array<struct<first:int,end:int>>, items array<string>"


def benchmark_hits(docs: DataFrame, items: DataFrame, *, window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, n_words, runs, items)``, one row per input row: the number of words, the merged runs of words
    ``[first, end)`` inside any occurrence of a window, and the ids, as text in text order, of the items found.

    Whole texts are searched, without a shuffle; items beyond ``block_bytes`` of windows are searched in
    further passes. Null and empty texts have no words; repeated items and rows count each; an empty
    benchmark finds nothing. Other columns of ``docs`` are ignored.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    state = docs.select("doc_id", "text", F.expr(f"CAST(NULL AS struct<{HITS.replace(' long', ':long').replace(' array', ':array')}>) AS hits"))
    schema = f"doc_id {kind}, text string, hits struct<{HITS.replace(' long', ':long').replace(' array', ':array')}>"
    blocks = item_blocks(items, window, block_bytes)
    searcher = next(blocks, None) or Searcher([])
    while searcher is not None:
        following = next(blocks, None)
        sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(searcher))
        state = state.mapInArrow(_pass(sent, last=following is None), schema)
        if following is not None:
            state = materialize(state)
        searcher = following
    return state.select("doc_id", "hits.n_words", "hits.runs", "hits.items")


def _pass(sent, last: bool):
    """A pass adds the hits of one block of items; the last one drops the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = None
        for batch in batches:
            searcher = searcher or pickle.loads(sent.value)
            for first, end, data, offsets in utf8_slices(batch.column(1)):
                raw = data.tobytes().translate(_NORMAL)
                n_words, hits = searcher.search([raw[offsets[i] : offsets[i + 1]] for i in range(end - first)])
                before = batch.column(2).slice(first, end - first)
                earlier = before.to_pylist() if before.null_count < len(before) else [None] * len(before)
                rows = []
                for i in range(end - first):
                    runs, found = hits.get(i, ((), set()))
                    items = {str(x) for x in found}
                    if earlier[i] and earlier[i]["items"]:
                        runs = [*runs, *[(r["first"], r["end"]) for r in earlier[i]["runs"]]]
                        items |= set(earlier[i]["items"])
                    rows.append({"n_words": int(n_words[i]), "runs": [{"first": a, "end": b} for a, b in _merged(runs)], "items": sorted(items)})
                texts = pa.nulls(end - first, batch.schema.field(1).type) if last else batch.column(1).slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), texts, pa.array(rows, _HIT_TYPE)], ["doc_id", "text", "hits"]
                )

    return run


_HIT_TYPE = pa.struct([
    ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
    ("items", pa.list_(pa.string())),
])


def drop_contaminated(docs: DataFrame, items: DataFrame, *, window: int = 10) -> DataFrame:
    """``docs`` without the documents that hold an occurrence of any window.

    Ids mark what goes: rows that repeat the id of a contaminated document go with it, rows with a null id stay.
    """
    hits = benchmark_hits(docs.where(F.col("doc_id").isNotNull()), items, window=window)
    found = hits.where(F.size("items") > 0).select(F.col("doc_id").alias("__hit")).distinct()
    return docs.join(found, docs["doc_id"] == F.col("__hit"), "left_anti")

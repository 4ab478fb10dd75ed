"""Packing token streams by order-preserving dynamic programming.

Documents keep their order in the input partition. A block of documents is one stream of tokens that may be
cut after a document, after a sentence, or, inside a long sentence, every ``HARD_EVERY`` tokens. With
``P[j]`` the tokens before cut ``j``, the cheapest packing up to it costs

    f[j] = penalty[j] + sequence_cost + min over i with P[j] - P[i] <= size of f[i] + padding(P[j] - P[i])

A sequence is padded to ``size`` unless its length is a power of two. For the padded case the minimum of
``f[i] + P[i]`` over a sliding window is kept in a monotone queue, so a cut costs constant time; powers of two
are looked up. No document is dropped or reordered, and nothing is shuffled: a task packs its own
partition in blocks of bounded size.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buffers import utf8_slices
from .shipping import ship

BLOCK_TOKENS = 1 << 20
SLICE_BYTES = 2 << 20
CACHED_WORDS = 1_200_000
HARD_EVERY = 128
SPACING = 16
# Shortest power of two that is tried as the length of a sequence without padding.
LEAST_POWER = 64
# Costs in tokens of padding: cutting a sentence, cutting a document after a sentence, one more sequence.
HARD_CUT, SENTENCE_CUT, SEQUENCE = 48, 8, 16
END_ID = 1

_SPLIT = re.compile(r"[ \t\n\r]+")
# Characters that str.split() takes for white space and the tokenizer does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
# Byte classes: blanks, letters, other ASCII, and what leaves the fast path.
_BLANK, _OTHER, _LETTER, _RARE = 0, 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 13, 32]] = _BLANK
_CLASS[[0, 11, 12]] = _RARE
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:192] = _CLASS[0xC3] = _LETTER
_CLASS[192:] = _RARE
_CLASS[0xC3] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], np.uint64)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_SLOT_BITS = 22
KEY_BYTES = 24


class WordTokenizer:
    """Ids of texts from a tokenizer that lower-cases, drops white space and splits where a letter is followed
    by something else.

    Neither a blank nor such a border is ever inside a token, so a text is the sequence of the pieces
    between them, and each distinct piece is encoded by the tokenizer itself only once: its ids are kept in
    a bounded table that is looked up for all pieces of a slice together. Texts with characters beyond
    Latin-1 letters and ASCII, and those that may hold special tokens, are cut at blanks only.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cached = cached
        self.slots = np.full(1 << _SLOT_BITS, -1, np.int32)
        self.keys = np.zeros((3, 1 << 16), np.uint64)
        self.n_keys = 0
        self.codes: dict[str, int] = {}  # long pieces, and those of the slow path, by their text
        self.flat = np.empty(1 << 18, np.uint32)
        self.n_flat = 0
        self.span = np.zeros((2, 1 << 16), np.int64)  # start and length of a code's ids
        self.n_codes = 0
        vocabulary = self.tokenizer.get_vocab()
        # The vocabulary writes a word's end as </w>; a token of sentence marks alone ends a sentence.
        self.stops = np.zeros(max(vocabulary.values()) + 1, bool)
        self.stops[[i for t, i in vocabulary.items() if re.fullmatch(r"[.!?]+</w>", t)]] = True

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in ``data`` (UTF-8), and where each text's ids end."""
        n_docs = len(offsets) - 1
        if self.n_codes > self.cached:
            self._forget()
        low = _LOWER[data]
        kind = _CLASS[data]
        if (data == 0xC3).any():
            lead = np.concatenate(([False], data[:-1] == 0xC3))
            low[lead & (data >= 0x80) & (data <= 0x9E)] += 0x20
            kind[lead & ((data == 0x97) | (data == 0xB7))] = _RARE
        odd = kind == _RARE
        odd[:-1] |= (data[:-1] == 60) & (data[1:] == 124)  # "<|"
        rare = np.add.reduceat(np.append(odd, False), offsets[:-1], dtype=np.int64) if len(data) else np.zeros(n_docs, np.int64)
        slow = np.flatnonzero((rare > 0) & (offsets[1:] > offsets[:-1]))
        for d in slow:
            kind[offsets[d] : offsets[d + 1]] = _BLANK
        before = np.concatenate(([_BLANK], kind[:-1])).astype(np.uint8)
        inner = offsets[1:-1]
        before[inner[inner < len(data)]] = _BLANK
        word = kind != _BLANK
        starts = np.flatnonzero(word & ((before == _BLANK) | ((before == _LETTER) & (kind == _OTHER))))
        # A piece ends before the next blank, the next piece or the end of its text.
        gap = np.flatnonzero(~word)
        after = np.append(gap, len(data))[np.searchsorted(gap, starts)]
        ends = np.minimum(np.append(starts[1:], len(data)), after)
        doc = np.searchsorted(offsets, starts, side="right") - 1
        ends = np.minimum(ends, offsets[doc + 1])
        codes = self._codes(low, starts, ends)
        if len(slow):
            texts = data.tobytes()
            own = {int(d): self._slow(texts[offsets[d] : offsets[d + 1]].decode()) for d in slow}
            parts, parted, at = [], [], 0
            for d, c in own.items():
                upto = int(np.searchsorted(doc, d))
                parts += [codes[at:upto], c]
                parted += [doc[at:upto], np.full(len(c), d)]
                at = upto
            codes, doc = np.concatenate([*parts, codes[at:]]), np.concatenate([*parted, doc[at:]])
        start, length = self.span[0][codes], self.span[1][codes]
        upto = np.concatenate(([0], np.cumsum(length)))
        ids = self.flat[np.arange(upto[-1]) + np.repeat(start - upto[:-1], length)]
        return ids, upto[np.searchsorted(doc, np.arange(1, n_docs + 1))]

    def _forget(self) -> None:
        """Forget what is cached."""
        self.slots.fill(-1)
        self.n_keys = self.n_flat = self.n_codes = 0
        self.codes.clear()

    def _codes(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        text = np.append(low, np.zeros(KEY_BYTES, np.uint8))
        view = np.ndarray((len(low) + KEY_BYTES - 7,), "<u8", text.data, strides=(1,))
        length = ends - starts
        codes = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(length <= KEY_BYTES)
        at, size = starts[short], length[short]
        key = [view[at + 8 * k if k < 2 else np.minimum(at + 16, len(view) - 1)] & _MASKS[np.clip(size - 8 * k, 0, 8)] for k in range(3)]
        with np.errstate(over="ignore"):
            mixed = key[0] * _MIX[0] ^ key[1] * _MIX[1] ^ key[2] * _MIX[2]
            slot = ((mixed ^ (mixed >> np.uint64(29))) * _MIX[1] >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        found = self._probe(key, slot)
        new = np.flatnonzero(found < 0)
        while len(new):
            # One piece for each value of ``mixed``; another piece of the same value is left to the next round.
            _, first = np.unique(mixed[new], return_index=True)
            pieces = new[first]
            raw = text.tobytes()
            self._learn([raw[a : a + n].decode() for a, n in zip(at[pieces].tolist(), size[pieces].tolist())], table=(key, slot, pieces))
            found[new] = self._probe([k[new] for k in key], slot[new])
            new = new[found[new] < 0]
        codes[short] = found
        long = np.flatnonzero(length > KEY_BYTES)
        if len(long):
            raw = text.tobytes()
            codes[long] = self._by_text([raw[a:b].decode() for a, b in zip(starts[long].tolist(), ends[long].tolist())])
        return codes

    def _probe(self, key: list[np.ndarray], slot: np.ndarray) -> np.ndarray:
        """Code of each key, -1 if it has none."""
        mask = len(self.slots) - 1
        found = np.full(len(slot), -1, np.int64)
        open_rows, at = np.arange(len(slot)), slot
        while len(open_rows):
            code = self.slots[at]
            used = code >= 0
            open_rows, at, code = open_rows[used], at[used], code[used]
            same = (self.keys[0][code] == key[0][open_rows]) & (self.keys[1][code] == key[1][open_rows]) & (self.keys[2][code] == key[2][open_rows])
            found[open_rows[same]] = code[same]
            open_rows, at = open_rows[~same], (at[~same] + 1) & mask
        return found

    def _learn(self, pieces: list[str], table=None) -> np.ndarray:
        """Encode new pieces and number them; pieces of the table are entered there."""
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        size = np.fromiter(map(len, encoded), np.int64, len(encoded))
        codes = self.n_codes + np.arange(len(pieces))
        self.flat = _room(self.flat, self.n_flat + int(size.sum()))
        self.span, self.keys = _room(self.span, self.n_codes + len(pieces)), _room(self.keys, self.n_codes + len(pieces))
        self.span[0][codes] = self.n_flat + np.cumsum(size) - size
        self.span[1][codes] = size
        self.flat[self.n_flat : self.n_flat + int(size.sum())] = np.fromiter((i for ids in encoded for i in ids), np.uint32, int(size.sum()))
        self.n_flat += int(size.sum())
        self.n_codes += len(pieces)
        if table is not None:
            key, slot, rows = table
            for k in range(3):
                self.keys[k][codes] = key[k][rows]
            mask = len(self.slots) - 1
            left, at = codes, slot[rows].copy()
            while len(left):
                # Of the pieces that want a free slot, the one written last has it; the others go on.
                free = self.slots[at] < 0
                self.slots[at[free]] = left[free]
                kept = self.slots[at] == left
                left, at = left[~kept], (at[~kept] + 1) & mask
        return codes

    def _by_text(self, pieces: list[str]) -> np.ndarray:
        fresh = list(dict.fromkeys(p for p in pieces if p not in self.codes))
        if fresh:
            self.codes.update(zip(fresh, self._learn(fresh).tolist()))
        return np.fromiter(map(self.codes.__getitem__, pieces), np.int64, len(pieces))

    def _slow(self, text: str) -> np.ndarray:
        words = [w for w in _SPLIT.split(text) if w] if _SEPARATORS.search(text) else text.split()
        return self._by_text(words)


def _room(array: np.ndarray, n: int) -> np.ndarray:
    """The array, longer if it has not room for ``n``."""
    if array.shape[-1] >= n:
        return array
    longer = np.zeros((*array.shape[:-1], max(n, 2 * array.shape[-1])), array.dtype)
    longer[..., : array.shape[-1]] = array
    return longer


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    """One per worker process, which runs many tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _cut_long(data: np.ndarray, limit: int = SLICE_BYTES) -> list[int]:
    """Cuts of one long text into slices of about ``limit`` bytes, at blanks, or at none if there is none."""
    cuts, at = [0], 0
    while len(data) - at > limit:
        blank = np.flatnonzero(_CLASS[data[at + limit : at + 2 * limit]] == _BLANK)
        at += limit
        if len(blank):
            at += int(blank[0])
            cuts.append(at)
    return [*cuts, len(data)]


def cut_points(ids: np.ndarray, doc_ends: np.ndarray, stops: np.ndarray, hard_every: int = HARD_EVERY) -> tuple[np.ndarray, np.ndarray]:
    """Where a stream may be cut, ascending from 0 to its end, and what each cut costs."""
    soft = np.flatnonzero(stops[ids]) + 1
    # Of sentences that end close together the last one counts, so that points are SPACING tokens apart on average.
    soft = soft[np.append(soft[1:] // SPACING != soft[:-1] // SPACING, True)] if len(soft) else soft
    edges = np.union1d(np.union1d(soft, doc_ends), [0, len(ids)]).astype(np.int64)
    gaps = np.diff(edges)
    extra = [np.arange(a + hard_every, a + g, hard_every) for a, g in zip(edges[:-1][gaps > hard_every], gaps[gaps > hard_every])]
    hard = np.concatenate(extra) if extra else np.empty(0, np.int64)
    points = np.union1d(edges, hard)
    cost = np.full(len(points), SENTENCE_CUT, np.int64)
    cost[np.searchsorted(points, hard)] = HARD_CUT
    cost[np.searchsorted(points, doc_ends)] = 0
    cost[[0, -1]] = 0
    return points, cost


def best_cuts(points: list[int], cost: list[int], size: int, sequence_cost: int = SEQUENCE) -> list[int]:
    """Cheapest cuts of a stream, as numbers of ``points``, the first and the last among them.

    No two neighbouring points may be further apart than ``size``.
    """
    grid = np.asarray(points)
    # Cuts a power of two back, for the few points that have any.
    exact: dict[int, list[int]] = {}
    for power in [1 << k for k in range((size - 1).bit_length()) if 1 << k >= LEAST_POWER]:
        back_to = np.searchsorted(grid, grid - power)
        for j in np.flatnonzero(grid[back_to] == grid - power).tolist():
            exact.setdefault(j, []).append(int(back_to[j]))
    total, back = [0] * len(points), [0] * len(points)
    # The queue holds cuts with f + P ascending and P ascending; its first live entry is at ``head``.
    values, cut, head = [points[0]], [0], 0
    for j in range(1, len(points)):
        p = points[j]
        while points[cut[head]] < p - size:
            head += 1
        best = cut[head]
        value = values[head] + size - p
        if j in exact:
            for i in exact[j]:
                if total[i] < value:
                    value, best = total[i], i
        value += cost[j] + sequence_cost
        total[j], back[j] = value, best
        value += p
        while len(cut) > head and values[-1] >= value:
            values.pop()
            cut.pop()
        values.append(value)
        cut.append(j)
    cuts, j = [len(points) - 1], len(points) - 1
    while j:
        j = back[j]
        cuts.append(j)
    return cuts[::-1]


_FIELDS = (
    ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()),
)


def pack(docs: DataFrame, tokenizer_path: str, *, size: int = 2048, with_ids: bool = False, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of documents in sequences of at most ``size`` tokens, one row per piece:
    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, on request, ``ids``.

    Every token is in one piece. ``start`` counts the document's tokens before the piece, ``offset`` the
    sequence's; ``doc_tokens`` includes the closing id 1, so an empty or null text is one token. A sequence
    has one partition's documents, in their order; its id is unique in the table. Rows that repeat an id
    are documents of their own. Other columns are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        next_id = TaskContext.get().partitionId() << 33
        names, parts, held = [], [], 0

        def packed() -> pa.RecordBatch:
            nonlocal next_id, names, parts, held
            ids = np.concatenate(parts)
            lengths = np.array([len(p) for p in parts], np.int64)
            ends = np.cumsum(lengths)
            points, cost = cut_points(ids, ends, tokenizer.stops)
            cuts = points[best_cuts(points.tolist(), cost.tolist(), size)]
            # Pieces are what lies between neighbouring edges of documents and sequences.
            edges = np.union1d(cuts, ends)
            first, end = np.concatenate(([0], edges[:-1])), edges
            keep = end > first
            first, end = first[keep], end[keep]
            doc = np.searchsorted(ends, first, side="right")
            sequence = np.searchsorted(cuts, first, side="right") - 1
            raw = ids.astype("<u4")
            columns = {
                "start": first - (ends - lengths)[doc], "length": end - first,
                "ids_crc32": np.array([zlib.crc32(raw[a:b].tobytes()) for a, b in zip(first.tolist(), end.tolist())], np.int64),
                "doc_tokens": lengths[doc], "sequence_id": next_id + sequence, "offset": first - cuts[sequence],
            }
            next_id += len(cuts)
            own = pa.chunked_array(names).combine_chunks().take(pa.array(doc))
            arrays = [own, *[pa.array(columns[n], t) for n, t in _FIELDS]]
            if with_ids:
                arrays.append(pa.array([raw[a:b].astype(np.int32) for a, b in zip(first, end)], pa.list_(pa.int32())))
            names, parts, held = [], [], 0
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", *[n for n, _ in _FIELDS], *(["ids"] if with_ids else [])])

        for batch in batches:
            for first, end, data, offsets in utf8_slices(batch.column(1), SLICE_BYTES):
                if end - first == 1:
                    cuts = _cut_long(data)
                    found = [tokenizer.encode(data[a:b], np.array([0, b - a]))[0] for a, b in zip(cuts, cuts[1:])]
                    parts.append(np.concatenate([*found, [END_ID]]).astype(np.uint32))
                else:
                    ids, upto = tokenizer.encode(data, offsets)
                    parts += [np.append(ids[a:b], np.uint32(END_ID)) for a, b in zip([0, *upto[:-1].tolist()], upto.tolist())]
                held += sum(map(len, parts[first - end :]))
                names.append(batch.column(0).slice(first, end - first))
                if held >= block_tokens:
                    yield packed()
        if parts:
            yield packed()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def padding(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """``(sequences, tokens, padded)`` over the pieces of ``pack``."""
    filled = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    pad = F.when(F.bit_count("n") == 1, 0).otherwise(F.lit(size) - F.col("n"))
    return filled.agg(F.count(F.lit(1)).alias("sequences"), F.sum("n").alias("tokens"), F.sum(pad).alias("padded"))

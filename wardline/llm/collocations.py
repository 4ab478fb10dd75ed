"""Phrase collocations by weighted acyclic automata.

A shard is some megabytes of text in one task. Its n-grams, sorted, are built into a count transducer: an acyclic automaton
whose paths are ``language, word, word...`` and carry how often they occur. Each shard's automaton is cut at the same
prefixes, and all shards' parts of a prefix range meet in one task, where they are united and their weights summed. Cuts are whole
n-grams, so that a frequent first word is spread over several ranges; within a shard it is one path already.

Words are counted first, then pairs, then all longer n-grams. What occurs often enough leaves a bit in a table of fixed size, and a
longer n-gram is only built where all its words, or pairs, have their bits; a bit too many costs work and changes no result. The frequent n-grams of a
range are then built, in their order, into a minimal automaton, whose paths number the weights, and the parts of all
candidate phrases, sent to their ranges, are composed with it: equal paths give the weights of the parts.
"""

from __future__ import annotations

import pickle
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import store
from .buffers import utf8_slices
from .shipping import ship

SHARD_BYTES = 6 << 20
RANGE_BYTES = 16 << 20
FILTER_BITS = 1 << 26
NO_LANG = "und"
# The prefixes to cut at come from a sample of texts; they only decide which task counts what.
_SAMPLE_DOCS, _SAMPLE_PATHS, _SAMPLE_STEP, _CUT_BYTES = 2_000, 100_000, 16, 64
_BLOCK_BITS = 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9]] = True
# The characters that end a piece.
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True

Path = tuple[bytes, ...]


def _numbered(symbols: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct ``symbols``, sorted, and the number of each symbol among them."""
    coded = symbols.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy(zero_copy_only=False)]


class Words:
    """The words of a shard: numbers into a sorted table of distinct words, with the row and piece of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = _LOWER[data]
        breaks, size = _BREAK[data], len(data)
        inside = ~(breaks | _BLANK[data])
        row_start = np.zeros(size + 1, bool)
        row_start[offsets] = True
        starts = np.flatnonzero(inside & (~np.concatenate(([False], inside))[:-1] | row_start[:-1]))
        ends = np.flatnonzero(inside & (~np.concatenate((inside, [False]))[1:] | row_start[1:])) + 1
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
        self.piece = np.cumsum(breaks | row_start[:-1], dtype=np.int32)[starts]
        ends_in = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=ends_in[1:])
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends_in), pa.py_buffer(np.ascontiguousarray(data[inside]))])
        self.table, self.word = _numbered(words)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Transducer:
    """Counts of sorted paths of one length: arcs of each depth with the first path below them, and a weight per path."""

    def __init__(self, symbols: pa.Array, columns: Sequence[np.ndarray], weights: np.ndarray):
        """``columns`` are the paths' symbols, depth by depth, as numbers into sorted ``symbols``; paths are sorted."""
        used, numbers = np.unique(np.concatenate(columns), return_inverse=True)
        self.symbols = symbols.take(pa.array(used))
        self.weights = weights
        self.arcs, fresh = [], np.zeros(len(weights), bool)
        fresh[:1] = True
        for column in np.split(numbers, len(columns)):
            fresh[1:] |= column[1:] != column[:-1]
            first = np.flatnonzero(fresh)
            self.arcs.append((column[first], first))

    def columns(self) -> list[np.ndarray]:
        n = len(self.weights)
        return [np.repeat(labels, np.diff(np.append(first, n))) for labels, first in self.arcs]

    def dump(self) -> bytes:
        flat = [(np.ascontiguousarray(x, x.dtype if not len(x) else np.min_scalar_type(int(x.max()))) for x in pair) for pair in self.arcs]
        symbols = self.symbols.cast(pa.large_binary())
        return pickle.dumps((symbols.to_pylist(), [tuple(pair) for pair in flat], self.weights), protocol=5)

    @classmethod
    def load(cls, blob: bytes) -> Transducer:
        out = cls.__new__(cls)
        symbols, out.arcs, out.weights = pickle.loads(blob)
        out.symbols = pa.array(symbols, pa.large_binary())
        return out

    @classmethod
    def union(cls, parts: Sequence[Transducer]) -> Transducer:
        """One automaton of all paths; weights of equal paths are summed."""
        symbols, numbers = _numbered(pa.concat_arrays([p.symbols for p in parts]))
        numbers = np.split(numbers, np.cumsum([len(p.symbols) for p in parts])[:-1])
        columns = [np.concatenate(c) for c in zip(*([own[c] for c in p.columns()] for p, own in zip(parts, numbers)))]
        weights = np.concatenate([p.weights for p in parts])
        at = np.lexsort(columns[::-1])
        columns = [c[at] for c in columns]
        fresh = np.zeros(len(at), bool)
        fresh[:1] = True
        for c in columns:
            fresh[1:] |= c[1:] != c[:-1]
        first = np.flatnonzero(fresh)
        return cls(symbols, [c[first] for c in columns], np.add.reduceat(weights[at], first))


class MinimalAutomaton:
    """A minimal acyclic automaton of paths added in their order; the arcs' outputs add up to a path's number, which
    finds its weight. Equal suffixes share their states whatever their weights are."""

    def __init__(self):
        self.register: dict = {}
        self.states: list[tuple[bool, dict]] = []  # final, {symbol: (state, paths before it in its state)}
        self.sizes: list[int] = []
        self.weights: list[int] = []
        self.open: list[list] = [[False, []]]  # of the last path: final, [(symbol, state)]
        self.last: Path = ()

    def add(self, path: Path, weight: int) -> None:
        shared = 0
        while shared < min(len(path), len(self.last)) and path[shared] == self.last[shared]:
            shared += 1
        self._close(shared)
        self.open += [[False, []] for _ in path[shared:]]
        self.open[-1][0] = True
        self.last = path
        self.weights.append(weight)

    def _close(self, depth: int) -> None:
        """Register the states of the last path beyond ``depth``."""
        while len(self.open) > depth + 1:
            final, arcs = self.open.pop()
            key = (final, tuple(arcs))
            state = self.register.get(key)
            if state is None:
                state = self.register[key] = len(self.states)
                before, out = int(final), {}
                for symbol, target in arcs:
                    out[symbol] = (target, before)
                    before += self.sizes[target]
                self.states.append((final, out))
                self.sizes.append(before)
            self.open[-1][1].append((self.last[len(self.open) - 1], state))

    def weight(self, path: Path) -> int | None:
        """The weight of a path; None if there is no such path. All paths must have been added."""
        self._close(0)
        arcs, place, final = None, 0, False
        for i, symbol in enumerate(path):
            if i == 0:
                step = next((s for x, s in self.open[0][1] if x == symbol), None)
                place = 0
                for x, s in self.open[0][1]:
                    if x == symbol:
                        break
                    place += self.sizes[s]
            else:
                target = arcs.get(symbol)
                step = None if target is None else target[0]
                place += 0 if target is None else target[1]
            if step is None:
                return None
            final, arcs = self.states[step]
        return self.weights[place] if final else None


def _path_hashes(words: Words, langs: np.ndarray, table: list[bytes], n: int) -> Iterator[np.ndarray]:
    """For every word the hash of the path that starts there, for one word to ``n`` words."""
    digest = xxhash.xxh64_intdigest
    own = np.array([digest(w) for w in words.table.to_pylist()], np.uint64)[words.word]
    path = np.array([digest(x, 1) for x in table], np.uint64)[langs[words.row]]
    for k in range(n):
        path = _mix(path[: len(own) - k] + own[k:])
        yield path


def _good_starts(words: Words, langs: np.ndarray, table: list[bytes], known: int, frequent: np.ndarray | None) -> np.ndarray | None:
    """Whether the path of ``known`` words that starts at a word has its bit; None without bits."""
    if frequent is None or len(words.word) < known:
        return None
    *_, hashes = _path_hashes(words, langs, table, known)
    return _has_bit(frequent, hashes)


def shard_transducer(words: Words, langs: np.ndarray, table: list[bytes], k: int, good: np.ndarray | None = None, known: int = 0) -> Transducer | None:
    """The transducer of a shard's n-grams of ``k`` words; None if there are none. ``langs`` numbers each row's language
    in sorted ``table``. With ``good``, only n-grams whose paths of ``known`` words are all good."""
    n = len(words.word) - k + 1
    if n < 1:
        return None
    at = words.piece[:n] == words.piece[k - 1 :]
    if good is not None:
        for j in range(k - known + 1):
            at = at & good[j : j + n]
    at = np.flatnonzero(at)
    if not len(at):
        return None
    n_words = len(words.table)
    path, _ = pd.factorize(langs[words.row[at]] * n_words + words.word[at])
    for j in range(1, k):
        path, _ = pd.factorize(path * n_words + words.word[at + j])
    counts = np.bincount(path)
    first = np.empty(len(counts), np.int64)
    first[path[::-1]] = at[::-1]
    # Languages and words share one table of symbols, in which a word that is also a language stands once: ``cut`` finds
    # symbols in it, and has to cut alike whether or not a shard has that language.
    symbols, rank = _numbered(pa.concat_arrays([words.table, pa.array(table, pa.large_binary())]))
    columns = [rank[n_words + langs[words.row[first]]], *[rank[words.word[first + j]] for j in range(k)]]
    by_path = np.lexsort(columns[::-1])
    columns = [c[by_path] for c in columns]
    return Transducer(symbols, columns, counts[by_path])


def cut(whole: Transducer, cuts: Sequence[Path]) -> Iterator[tuple[int, Transducer]]:
    """``(range, part)`` of the ranges that have paths; range ``i`` begins at ``cuts[i - 1]``."""
    table, columns = whole.symbols.to_pylist(), whole.columns()
    edges = []
    for wanted in cuts:
        low, high = 0, len(whole.weights)
        for symbol, column in zip(wanted, columns):
            place = bisect_right(table, symbol)
            there = place > 0 and table[place - 1] == symbol
            if not there:
                low = high = low + int(np.searchsorted(column[low:high], place))
                break
            low, high = (low + int(np.searchsorted(column[low:high], place - 1, side)) for side in ("left", "right"))
        else:
            # Paths that are as long as the cut, or longer, and begin with it are behind it.
            high = low
        edges.append(high if len(wanted) > len(columns) and low != high else low)
    edges = [0, *np.maximum.accumulate(np.array(edges, np.int64)).tolist(), len(whole.weights)] if edges else [0, len(whole.weights)]
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        if b > a:
            yield i, Transducer(whole.symbols, [c[a:b] for c in columns], whole.weights[a:b])


def _has_bit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(len(bits) * 8 - 1)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _lang_numbers(column: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    names = [NO_LANG if x is None else x for x in column.to_pylist()]
    table = sorted({x.encode() for x in names})
    place = {x: i for i, x in enumerate(table)}
    return np.array([place[x.encode()] for x in names], np.int64), table


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """``(bytes, offsets, language numbers, languages)`` of runs of rows ``(lang, text)`` of about ``size`` bytes, over
    batches, or one longer row."""
    held, n_bytes = [], 0

    def joined():
        data = np.concatenate([h[0] for h in held])
        ends = np.cumsum([0, *[len(h[0]) for h in held]])
        offsets = np.concatenate([[0], *[h[1][1:] + e for h, e in zip(held, ends)]])
        return data, offsets, *_lang_numbers(pa.concat_arrays([h[2] for h in held]))

    for batch in batches:
        for first, end, data, offsets in utf8_slices(batch.column(1), size):
            if held and n_bytes + len(data) > size:
                yield joined()
                held, n_bytes = [], 0
            held.append((data, offsets, batch.column(0).slice(first, end - first).cast(pa.large_utf8())))
            n_bytes += len(data)
    if held:
        yield joined()


def sample_cuts(docs: DataFrame, range_bytes: int) -> list[Path]:
    """Prefixes that cut the paths of a sample of the texts into equal ranges, one per ``range_bytes`` of all text."""
    size = docs.agg(F.sum(F.octet_length("text")), F.count("text")).first()
    n_ranges = (size[0] or 0) // range_bytes + 1
    if n_ranges == 1:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, offsets, langs, table in _shards(batches, SHARD_BYTES):
            words = Words(data, offsets)
            names = words.table.to_pylist()
            at = np.flatnonzero(_mix(np.arange(len(words.word), dtype=np.uint64)) % np.uint64(_SAMPLE_STEP) == 0)
            paths = []
            for i in at.tolist():
                same = words.piece[i : i + 4] == words.piece[i]
                paths.append([table[langs[words.row[i]]], *[names[w][:_CUT_BYTES] for w in words.word[i : i + 4][same]]])
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.list_(pa.binary()))], ["path"])

    step = max(1, size[1] // _SAMPLE_DOCS)
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(step)) == 0).mapInArrow(run, "path array<binary>").limit(_SAMPLE_PATHS)
    paths = sorted(tuple(bytes(x) for x in r["path"]) for r in sample.collect())
    return sorted({paths[len(paths) * i // n_ranges] for i in range(1, n_ranges)}) if paths else []


def count_phrases(
    docs: DataFrame, lengths: Sequence[int], cuts: Sequence[Path], frequent: np.ndarray | None, known: int, min_count: int, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``(lang, words array<string>, f)`` of the n-grams of ``lengths`` words with ``f`` of at least ``min_count`` in ``docs``
    (``lang, text``), and for single words a row with null ``words`` per language and range, with all words counted.
    ``frequent`` are the bits of the n-grams of ``known`` words."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, offsets, langs, table in _shards(batches, shard_bytes):
            words = Words(data, offsets)
            good = _good_starts(words, langs, table, known, frequent)
            for k in lengths:
                whole = shard_transducer(words, langs, table, k, good, known)
                for i, part in cut(whole, cuts) if whole is not None else ():
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([k], pa.int32()), pa.array([part.dump()], pa.binary())], ["range", "k", "part"])

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(parts: list[Transducer]) -> Iterator[pa.RecordBatch]:
            whole = Transducer.union(parts)
            if len(whole.arcs) == 2:
                lang, total = whole.columns()[0], whole.weights
                for i in np.unique(lang):
                    name = whole.symbols[int(i)].as_py().decode()
                    yield batch_of([name], [None], [int(total[lang == i].sum())])
            kept = np.flatnonzero(whole.weights >= min_count)
            for at in range(0, len(kept), 20_000):
                some = kept[at : at + 20_000]
                table = [whole.symbols.take(pa.array(c[some])).cast(pa.large_utf8()).to_pylist() for c in whole.columns()]
                yield batch_of(table[0], [list(w) for w in zip(*table[1:])], whole.weights[some])

        def batch_of(langs, words, counts) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.list_(pa.string())), pa.array(counts, pa.int64())], ["lang", "words", "f"])

        held, n_paths, current = [], 0, None
        for batch in batches:
            for *number, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if number != current:
                    if held:
                        yield from rows(held)
                    held, n_paths, current = [], 0, number
                held.append(Transducer.load(blob))
                n_paths += len(held[-1].weights)
                # Parts are united as they come, so that what is held stays near the size of the result.
                if len(held) > 1 and n_paths > 2 * len(held[0].weights) + 500_000:
                    held = [Transducer.union(held)]
                    n_paths = len(held[0].weights)
        if held:
            yield from rows(held)

    parts = docs.select("lang", "text").mapInArrow(shards, "range int, k int, part binary")
    by_range = parts.repartition(len(cuts) + 1, "range").sortWithinPartitions("range", "k")
    return by_range.mapInArrow(unite, "lang string, words array<string>, f long")


def frequent_bits(counts: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit for the hash of each n-gram of ``counts``, in a table of a fixed number of bits (a power of two).

    It is put together in blocks on the executors; ``bits / 8`` bytes come to the driver, however many n-grams there are.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            out = []
            for lang, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                path = np.array([digest(lang.encode(), 1)], np.uint64)
                for w in words:
                    path = _mix(path + np.uint64(digest(w.encode())))
                out.append(int(path[0]) & (bits - 1))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["place"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(number, flags):
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())], ["block", "bits"])

        current, flags = None, None
        for batch in batches:
            place = batch.column(0).to_numpy()
            for number in np.unique(place // _BLOCK_BITS):
                if number != current:
                    if flags is not None:
                        yield packed(current, flags)
                    current, flags = int(number), np.zeros(_BLOCK_BITS, bool)
                flags[place[place // _BLOCK_BITS == number] % _BLOCK_BITS] = True
        if flags is not None:
            yield packed(current, flags)

    placed = counts.where("words IS NOT NULL").select("lang", "words").mapInArrow(places, "place long").distinct()
    placed = placed.withColumn("block", F.floor(F.col("place") / _BLOCK_BITS))
    blocks = placed.repartition("block").sortWithinPartitions("place").select("place").mapInArrow(block, "block long, bits binary")
    out = np.zeros(bits // 8, np.uint8)
    for row in blocks.toLocalIterator():
        at = row["block"] * (_BLOCK_BITS // 8)
        out[at : at + _BLOCK_BITS // 8] = np.frombuffer(row["bits"], np.uint8)[: len(out) - at]
    return out


def part_counts(counts: DataFrame, candidates: DataFrame, cuts: Sequence[Path]) -> DataFrame:
    """``(lang, part, f)`` of all parts of ``candidates`` (``lang, words``), by composing them with the automata of
    ``counts`` (``lang, words, f``), range by range. ``part`` is space-joined."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [(a.encode(), *[w.encode() for w in b]) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            ranges = pa.array([bisect_right(cuts, p) for p in paths], pa.int32())
            yield pa.RecordBatch.from_arrays([ranges, *batch.columns], ["range", "lang", "words", "f"])

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, current = MinimalAutomaton(), None
        for batch in batches:
            out = []
            for number, lang, words, f in zip(*(c.to_pylist() for c in batch.columns)):
                if number != current:
                    automaton, current = MinimalAutomaton(), number
                path = (lang.encode(), *[w.encode() for w in words])
                if f is not None:
                    automaton.add(path, f)
                else:
                    out.append((lang, " ".join(words), automaton.weight(path)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.int64()))], ["lang", "part", "f"]) if out else (
                pa.RecordBatch.from_arrays([pa.array([], pa.string()), pa.array([], pa.string()), pa.array([], pa.int64())], ["lang", "part", "f"]))

    n = F.size("words")
    sides = F.flatten(F.transform(F.sequence(F.lit(1), n - 1), lambda j: F.array(F.slice("words", 1, j), F.slice("words", j + 1, n - j))))
    parts = candidates.select("lang", F.explode(sides).alias("words")).distinct().withColumn("f", F.lit(None).cast("long"))
    both = counts.select("lang", "words", "f").unionByName(parts).mapInArrow(placed, "range int, lang string, words array<string>, f long")
    by_range = both.repartition(len(cuts) + 1, "range").sortWithinPartitions("range", F.col("f").isNull(), "lang", "words")
    return by_range.mapInArrow(compose, "lang string, part string, f long")


def collocations(
    docs: DataFrame, *, min_count: int = 30, max_words: int = 4, cover_pct: int = 80, top: int = 2000, shard_bytes: int = SHARD_BYTES,
    range_bytes: int = RANGE_BYTES, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` phrases of each language of ``docs`` (``lang, text``).

    Texts are lower-cased (A-Z), split at ``. , ; : ! ?`` and line ends into pieces and at blanks and tabs into words; ``n`` are a
    language's words, ``a`` a phrase's occurrences within pieces. Phrases have 2 to ``max_words`` words and occur ``min_count``
    times. Cut behind its first words, a phrase has the score ``floor(2000000 * a / (l + r))`` with ``l`` and ``r`` the
    occurrences of its sides; the lowest-scoring cut counts, then the earliest. A phrase that lies in a longer one with at least
    ``cover_pct`` per cent of its occurrences is left out. Order: score and ``a`` descending, phrase in byte order.

    Null texts are empty, a null language is ``und``, ids are not looked at, so repeated rows count again. Extra columns are
    ignored; an empty table gives no rows. Numbers are exact beyond 64 bits.
    """
    ship(docs.sparkSession)
    docs = docs.select("lang", "text")
    cuts = sample_cuts(docs, range_bytes)
    levels, frequent = [], None
    for lengths in filter(None, ([1], [2], list(range(3, max_words + 1)))):
        known = lengths[0] - 1
        levels.append(store(count_phrases(docs, lengths, cuts, frequent, known, min_count, shard_bytes)))
        frequent = frequent_bits(levels[-1], filter_bits) if lengths[-1] < max_words else None
    totals = levels[0].where("words IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    counts = levels[0].where("words IS NOT NULL")
    for more in levels[1:]:
        counts = counts.unionByName(more)
    phrase = F.array_join("words", " ").alias("phrase")
    candidates = counts.where(F.size("words") > 1)
    found = store(part_counts(counts.where(F.size("words") < max_words), candidates, cuts))

    big = lambda c: F.col(c).cast("decimal(38,0)")
    side = lambda first, length: F.array_join(F.slice("words", first, length), " ")
    j = F.col("j")
    cuts_of = candidates.select("lang", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("j"))
    cuts_of = cuts_of.select("lang", phrase, "a", "j", side(F.lit(1), j).alias("first"), side(j + 1, F.size("words") - j).alias("rest"))
    cuts_of = cuts_of.join(found.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts_of = cuts_of.join(found.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("(CAST(a AS decimal(28,0)) * 2000000) div (CAST(l AS decimal(28,0)) + CAST(r AS decimal(28,0)))").cast("long")
    scored = cuts_of.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "j", "l", "r")).alias("best"))

    n = F.size("words")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda m: F.transform(F.sequence(F.lit(1), n - m + 1), lambda i: F.array_join(F.slice("words", i, m), " "))))
    longer = candidates.where(n > 2).select("lang", F.explode(inner).alias("phrase"), "f")
    cover = longer.groupBy("lang", "phrase").agg(F.max("f").alias("cover"))
    left = scored.join(cover, ["lang", "phrase"], "left").where(F.col("cover").isNull() | (big("cover") * 100 < big("a") * cover_pct))
    in_order = Window.partitionBy("lang").orderBy(F.col("best.score").desc(), F.col("a").desc(), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(in_order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "best.l", "best.r", "n", "best.score")

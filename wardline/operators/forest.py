"""Forests grown by Spark: drawn or searched splits, any depth, minimum rows to split a node.

A tree grows level by level while its nodes are large: one pass finds the range of each open node's chosen features, one counts the
classes on both sides of the thresholds, combined per partition. A node of at most ``local_rows`` rows is sent to one task with
its rows, and grown there to its end. What is drawn (features, thresholds, bootstrap weights) comes from hashes of the seed, the tree,
the node's path and the row, so that a forest does not depend on partitions, and one with drawn splits not on ``local_rows`` either.
"""

from __future__ import annotations

import dataclasses
import itertools
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store

LOCAL_ROWS = 50_000
WHOLE_BYTES = 320 << 20
LARGE_NODE_CUTS = 255
_MOST_TASKS = 2_000
_BATCH_ROWS = 1 << 17
_COPIED_BYTES = 1 << 30
_MANY_TREES = 50
_MASK = (1 << 64) - 1


@dataclasses.dataclass(frozen=True)
class Growth:
    """How trees grow. ``max_features`` is ``sqrt``, ``log2``, a share or a number; ``max_depth`` None is no limit."""

    trees: int = 100
    max_depth: int | None = None
    min_split: int = 2
    min_leaf: int = 1
    max_features: str | float | int = "sqrt"
    drawn: bool = False
    bootstrap: bool = True
    seed: int = 42

    def n_features(self, total: int) -> int:
        named = {"sqrt": int(total**0.5), "log2": int(np.log2(max(total, 1))), "all": total}
        n = named[self.max_features] if isinstance(self.max_features, str) else (
            int(self.max_features * total) if isinstance(self.max_features, float) else self.max_features)
        return min(max(n, 1), total)


def _kernel():
    """The functions that tasks run; in a closure, so that Spark sends them along with the task."""

    def mix(x: int) -> int:
        x = (x + 0x9E3779B97F4A7C15) & _MASK
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
        return x ^ (x >> 31)

    def unit(key: int, item: int) -> float:
        return (mix(key ^ mix(item)) >> 11) / float(1 << 53)

    def child(key: int, right: bool) -> int:
        return mix(key ^ (0xD1B54A32D192ED03 if right else 0x8CB92BA72F3D8DD7))

    def weights(growth: Growth, tree: int, rows: np.ndarray) -> np.ndarray:
        """How often each row is in the tree's sample: Poisson of mean one."""
        if not growth.bootstrap:
            return np.ones(len(rows), np.int64)
        x = rows.astype(np.uint64) ^ np.uint64(mix(growth.seed ^ mix(tree + (1 << 32))))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        u = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
        total, term, out = np.exp(-1.0), np.exp(-1.0), np.zeros(len(rows), np.int64)
        for k in range(1, 20):
            more = u >= total
            if not more.any():
                break
            out += more
            term /= k
            total += term
        return out

    def root(growth: Growth, tree: int) -> int:
        return mix(growth.seed ^ mix(tree))

    def chosen(growth: Growth, key: int, low: np.ndarray, high: np.ndarray) -> list[int]:
        """The features a node looks at: of those that are not constant, the first by their hashes."""
        open_features = np.flatnonzero(high > low).tolist()
        return sorted(open_features, key=lambda f: unit(key, f))[: growth.n_features(len(low))]

    def impurity(counts: np.ndarray) -> np.ndarray:
        """Gini times weight along the last axis."""
        total = counts.sum(axis=-1)
        return total - (counts.astype(np.float64) ** 2).sum(axis=-1) / np.maximum(total, 1)

    def best_of(left: np.ndarray, left_rows: np.ndarray, counts: np.ndarray, n_rows: int, min_leaf: int) -> tuple[float, int]:
        """``(gain, place)`` of the best cut among class counts on the left ``(cuts, classes)``; place -1 if none is allowed."""
        gain = impurity(counts) - impurity(left) - impurity(counts - left)
        fits = (left_rows >= min_leaf) & (n_rows - left_rows >= min_leaf)
        if not fits.any():
            return 0.0, -1
        gain = np.where(fits, gain, -1.0)
        at = int(np.argmax(gain))
        return float(gain[at]), at

    def cuts_of(growth: Growth, key: int, feature: int, low: float, high: float) -> np.ndarray:
        """Thresholds that a large node tries, or the one that is drawn; a value goes right if it is greater."""
        if growth.drawn:
            at = low + unit(key, feature + (1 << 20)) * (high - low)
            return np.array([min(max(at, low), np.nextafter(high, low))])
        return low + (high - low) * np.arange(1, LARGE_NODE_CUTS + 1) / (LARGE_NODE_CUTS + 1)

    def ends(growth: Growth, counts: np.ndarray, n_rows: int, depth: int) -> bool:
        full = growth.max_depth is not None and depth >= growth.max_depth
        return full or n_rows < max(growth.min_split, 2 * growth.min_leaf) or (counts > 0).sum() < 2

    def mixed(x: np.ndarray) -> np.ndarray:
        """``mix`` of every number."""
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def units(keys: np.ndarray, items: np.ndarray) -> np.ndarray:
        return (mixed(keys ^ mixed(items.astype(np.uint64))) >> np.uint64(11)) / float(1 << 53)

    def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(codes, values)`` of a column: the place of each number among the sorted values, from 1; NaN is 0."""
        known, place = np.unique(x, return_inverse=True)
        gap = len(known) and np.isnan(known[-1])
        known = known[:-1] if gap else known
        return (np.where(place == len(known), 0, place + 1) if gap else place + 1).astype(np.uint32), np.concatenate([[np.nan], known])

    def grow(growth: Growth, key: int, depth: int, codes: np.ndarray, values: list, y: np.ndarray, w: np.ndarray, classes: int, listed: int, local_rows: int) -> tuple:
        """``(feature, threshold, counts)`` of the nodes below and with the first one, level by level; feature -1 is a leaf, see ``children``.
        Rows of weight 0 take no part. A node of more than ``local_rows`` rows tries the cuts of a large node; the first one counts as
        ``listed`` rows. All nodes of a level are split together, in batches of some ``_BATCH_ROWS`` rows."""
        width, n = codes.shape
        flat, take = codes.reshape(-1), growth.n_features(width)
        every, offset = np.concatenate(values), np.cumsum([0, *map(len, values)])[:-1]
        gaps = bool((codes == 0).any())
        # NaN is sorted as minus infinity.
        lowest = np.array([len(v) > 1 and v[1] == -np.inf for v in values], np.uint32)
        code_bits, row_bits = int(max(map(len, values))).bit_length(), max(classes - 1, 1).bit_length() + 5
        plain = not growth.bootstrap

        def value_at(f: np.ndarray, code: np.ndarray) -> np.ndarray:
            return every[offset[f] + code]

        def at_drawn(f, key, low, high, v, rows, size, start, counts):
            """``(gain, allowed, threshold, code, left, left rows)`` of each node's drawn cut; codes up to ``code`` go left."""
            a, b = value_at(f, low), value_at(f, high)
            cut = a + units(key, f + (1 << 20)) * (b - a)
            cut, most = np.where(a > cut, a, cut), np.nextafter(b, a)
            cut, code = np.where(most < cut, most, cut), np.zeros(len(f), np.uint32)
            for g in np.unique(f):
                here = f == g
                code[here] = np.searchsorted(values[g][1:], cut[here], side="right")
            right = v > np.repeat(code, size)
            cell = np.repeat(np.arange(0, 2 * classes * len(f), 2 * classes), size) + 2 * y[rows] + right
            left = np.bincount(cell, None if plain else w[rows], 2 * classes * len(f)).astype(np.int64).reshape(-1, classes, 2)[:, :, 0]
            n_left = left.sum(axis=1) if plain else size - np.add.reduceat(right, start, dtype=np.int64)
            gain = impurity(counts) - impurity(left) - impurity(counts - left)
            return gain, (n_left >= growth.min_leaf) & (size - n_left >= growth.min_leaf), cut, code, left, n_left

        def at_best(f, key, low, high, v, rows, size, start, counts):
            """The same of each node's best cut between two of its values."""
            nodes = len(f)
            if gaps and lowest.any():
                v = np.maximum(v, np.repeat(lowest[f], size))
            if nodes.bit_length() + code_bits + row_bits > 64:
                raise ValueError("too many rows and classes for one batch")
            order = np.repeat(np.arange(nodes, dtype=np.uint64) << np.uint64(code_bits + row_bits), size) | v.astype(np.uint64) << np.uint64(row_bits)
            order |= (y[rows].astype(np.uint64) << np.uint64(5)) | w[rows].astype(np.uint64)
            order.sort()
            group = order >> np.uint64(row_bits)
            edge = np.flatnonzero(group[1:] != group[:-1])
            node = (group[edge] >> np.uint64(code_bits)).astype(np.int64)
            inner = edge + 1 < (start + size)[node]
            edge, node = edge[inner], node[inner]
            gain, allowed = np.full(nodes, -1.0), np.zeros(nodes, bool)
            cut, code, left, n_left = np.zeros(nodes), np.zeros(nodes, np.uint32), np.zeros((nodes, classes), np.int64), np.zeros(nodes, np.int64)
            if not len(edge):
                return gain, allowed, cut, code, left, n_left
            weight, label = order & np.uint64(31), order >> np.uint64(5) & np.uint64((1 << row_bits - 5) - 1)
            # Running counts of several classes in one number.
            bits = int(weight.sum()).bit_length()
            each, sums = 64 // bits, []
            for first in range(0, classes, each):
                mine = label - np.uint64(first)  # others wrap around
                run = np.cumsum(np.where(mine < np.uint64(each), weight << np.minimum(mine, np.uint64(each)) * np.uint64(bits), np.uint64(0)))
                run = run[edge] - np.concatenate([[np.uint64(0)], run])[start][node]
                sums += [(run >> np.uint64(bits * c) & np.uint64((1 << bits) - 1)).astype(np.float64) for c in range(min(each, classes - first))]
            total_l = total_r = square_l = square_r = 0.0
            for c, on_left in enumerate(sums):
                on_right = counts[:, c].astype(np.float64)[node] - on_left
                total_l, total_r = total_l + on_left, total_r + on_right
                square_l, square_r = square_l + on_left * on_left, square_r + on_right * on_right
            rows_l = edge + 1 - start[node]
            fits = (rows_l >= growth.min_leaf) & (size[node] - rows_l >= growth.min_leaf)
            gains = impurity(counts)[node] - (total_l - square_l / np.maximum(total_l, 1)) - (total_r - square_r / np.maximum(total_r, 1))
            gains = np.where(fits, gains, -1.0)
            first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            has, top = node[first], np.maximum.reduceat(gains, first)
            best = np.flatnonzero(gains == np.repeat(top, np.diff(np.append(first, len(node)))))
            best = best[np.concatenate([[True], node[best][1:] != node[best][:-1]])]  # the first of equal ones
            gain[has], allowed[has] = top, np.logical_or.reduceat(fits, first)
            mask = np.uint64((1 << code_bits) - 1)
            lower, upper = (group[edge[best] + i] & mask for i in (0, 1))
            a, b = (np.where(c == 0, -np.inf, value_at(f[has], c.astype(np.int64))) for c in (lower, upper))
            middle = (a + b) / 2
            cut[has] = np.where((middle < b) & np.isfinite(middle), middle, a)
            code[has], n_left[has] = lower, rows_l[best]
            for c, on_left in enumerate(sums):
                left[has, c] = on_left[best]
            return gain, allowed, cut, code, left, n_left

        def at_steps(f, key, low, high, v, rows, size, start, counts):
            """The same of one large node's best cut among equal steps."""
            steps = cuts_of(growth, int(key[0]), int(f[0]), value_at(f, low)[0], value_at(f, high)[0])
            known = values[f[0]]
            place = np.where(np.isnan(known), 0, np.searchsorted(steps, known, side="left"))
            here, size_of = place[v], len(steps) + 1
            table = np.bincount(here * classes + y[rows], w[rows], size_of * classes).astype(np.int64).reshape(-1, classes)
            left, left_rows = np.cumsum(table, axis=0)[:-1], np.cumsum(np.bincount(here, minlength=size_of))[:-1]
            gain, at = best_of(left, left_rows, counts[0], len(rows), growth.min_leaf)
            code = np.searchsorted(place[1:], at, side="right")
            return np.array([gain]), np.array([at >= 0]), steps[[at]], np.array([code], np.uint32), left[[at]], left_rows[[at]]

        def split(look, rows, size, key, counts):
            """``(feature, threshold, code, left, left rows)`` of the nodes whose rows follow each other; feature -1 where there is no split."""
            nodes = len(size)
            wish = np.argsort(units(key[:, None], np.arange(width)[None, :]), axis=1, kind="stable")
            seen, gain, feature = np.zeros(nodes, np.int64), np.full(nodes, -np.inf), np.full(nodes, -1)
            threshold, code, left, n_left = np.zeros(nodes), np.zeros(nodes, np.uint32), np.zeros((nodes, classes), np.int64), np.zeros(nodes, np.int64)
            for turn in range(width):
                on = np.flatnonzero(seen < take)
                if not len(on):
                    break
                mine, sizes = (rows, size) if len(on) == nodes else (rows[np.repeat(seen < take, size)], size[on])
                start, f = np.cumsum(sizes) - sizes, wish[on, turn]
                v = flat[np.repeat(f * n, sizes) + mine]
                high = np.maximum.reduceat(v, start)
                # A gap is no value: less one, its 0 becomes the greatest number.
                low = np.minimum.reduceat(v - np.uint32(1), start) + np.uint32(1) if gaps else np.minimum.reduceat(v, start)
                varies = high > low
                if not varies.any():
                    continue
                found, allowed, cut, upto, counted, rows_in = look(f, key[on], low, high, v, mine, sizes, start, counts[on])
                better = allowed & varies & (found > gain[on])
                to = on[better]
                gain[to], feature[to], threshold[to], code[to], left[to], n_left[to] = found[better], f[better], cut[better], upto[better], counted[better], rows_in[better]
                seen[on] += varies
            return feature, threshold, code, left, n_left

        rows = np.flatnonzero(w > 0)
        small = np.int32 if n < 1 << 31 else np.int64  # as kept between levels
        counts = np.bincount(y[rows], w[rows], classes).astype(np.int64)[None, :]
        keys, size, large, ids = np.array([key], np.uint64), np.array([len(rows)]), np.array([listed > local_rows]), np.array([0])
        rows, total, levels = rows.astype(small), 1, []
        while len(ids):
            feature, threshold, left = np.full(len(ids), -1, np.int32), np.zeros(len(ids)), np.full(len(ids), -1)
            levels.append((ids, feature, threshold, counts))
            if growth.max_depth is not None and depth >= growth.max_depth:
                break
            whole = (size >= max(growth.min_split, 2 * growth.min_leaf)) & ((counts > 0).sum(axis=1) > 1)
            rows, on = rows[np.repeat(whole, size)], np.flatnonzero(whole)
            ends, begin, sides = np.cumsum(size[on]), 0, ([], [])
            while begin < len(on):
                before = ends[begin - 1] if begin else 0
                until, look = max(int(np.searchsorted(ends, before + _BATCH_ROWS, side="right")), begin + 1), at_drawn if growth.drawn else at_best
                if not growth.drawn and large[on[begin : until]].any():
                    until = begin + max(int(np.argmax(large[on[begin : until]])), 1)
                    look = at_steps if large[on[begin]] else at_best
                at, mine = on[begin : until], rows[before : ends[until - 1]].astype(np.int64)
                f, cut, code, counted, n_left = split(look, mine, size[at], keys[at], counts[at])
                feature[at], threshold[at] = f, cut
                done = f >= 0
                if not done.all():
                    mine = mine[np.repeat(done, size[at])]
                at = at[done]
                right = flat[np.repeat(f[done] * n, size[at]) + mine] > np.repeat(code[done], size[at])
                sides[0].append((mine[~right].astype(small), at, counted[done], n_left[done]))
                sides[1].append((mine[right].astype(small), at, counts[at] - counted[done], size[at] - n_left[done]))
                begin = until
            went = feature >= 0
            # Nodes are numbered so that the n-th split node has the children 2n - 1 and 2n.
            left[went] = total + 2 * np.argsort(np.argsort(ids[went]))
            total += 2 * int(went.sum())
            parts = [(*part, side) for side in (0, 1) for part in sides[side] if len(part[1])]
            if not parts:
                break
            rows, counts, size = (np.concatenate([p[i] for p in parts]) for i in (0, 2, 3))
            ids = np.concatenate([left[p[1]] + p[4] for p in parts])
            steps = [np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0xD1B54A32D192ED03)]
            keys, large, depth = np.concatenate([mixed(keys[p[1]] ^ steps[p[4]]) for p in parts]), size > local_rows, depth + 1
        out = np.empty(total, np.int32), np.empty(total), np.empty((total, classes), np.int64)
        for ids, *found in levels:
            for whole, part in zip(out, found):
                whole[ids] = part
        return out

    def children(feature: np.ndarray) -> np.ndarray:
        """The left child of each node of ``grow``, the right one follows it: the n-th split node has 2n - 1 and 2n; -1 for leaves."""
        splits = feature >= 0
        return np.where(splits, 2 * np.cumsum(splits) - 1, -1)

    def route(feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The node that each row ends in."""
        at = np.zeros(len(x), np.int64)
        moving = np.flatnonzero(feature[at] >= 0)
        while len(moving):
            node = at[moving]
            at[moving] = left[node] + (x[moving, feature[node]] > threshold[node])
            moving = moving[feature[at[moving]] >= 0]
        return at

    def leaf_shares(tree: tuple, x: np.ndarray) -> np.ndarray:
        """The class shares of the leaf that each row ends in, of a tree as ``Tree.packed`` has it."""
        feature, cuts, leaves = tree
        splits = feature >= 0
        threshold = np.zeros(len(feature))
        threshold[splits] = cuts
        return (leaves / leaves.sum(axis=1, keepdims=True))[(np.cumsum(~splits) - 1)[route(feature, threshold, children(feature), x)]]

    return dict(locals())


def _rows_of(df: DataFrame, features: str, label: str) -> DataFrame:
    values = vector_to_array(features) if isinstance(df.schema[features].dataType, VectorUDT) else F.col(features).cast("array<double>")
    return df.where(F.col(label).isNotNull()).select(F.monotonically_increasing_id().alias("row"), values.alias("x"), F.col(label).cast("int").alias("y"))


def _pack(feature: np.ndarray, threshold: np.ndarray, counts: np.ndarray) -> tuple:
    """A tree as little as it can be: the features, -1 for leaves, the thresholds of split nodes and the class counts of leaves."""
    splits = feature >= 0
    leaves = counts[~splits]
    return feature.astype(np.min_scalar_type(-1 - max(int(feature.max()), 0))), threshold[splits], leaves.astype(np.min_scalar_type(int(leaves.max())))


class Tree:
    """A grown tree, level by level. An item is a node ``[feature, threshold, left, right, class counts, gain]``; feature -1 is a leaf."""

    def __init__(self, packed: tuple):
        self.packed = packed

    @classmethod
    def linked(cls, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> Tree:
        """A tree of nodes in any order, the first one its root."""
        levels = [np.array([0])]
        while len(levels[-1]):
            split = levels[-1][feature[levels[-1]] >= 0]
            levels.append(np.stack([left[split], right[split]], axis=1).reshape(-1))
        order = np.concatenate(levels).astype(np.int64)
        return cls(_pack(feature[order], threshold[order], counts[order]))

    def __len__(self) -> int:
        return len(self.packed[0])

    def arrays(self) -> tuple:
        """``(feature, threshold, left, counts, gain)`` of all nodes; the right child follows the left."""
        kernel, (feature, cuts, leaves) = _kernel(), self.packed
        feature, splits, left = feature.astype(np.int64), feature >= 0, kernel["children"](feature)
        threshold, counts = np.zeros(len(feature)), np.zeros((len(feature), leaves.shape[1]), np.int64)
        threshold[splits], counts[~splits] = cuts, leaves
        ends = [0, 1]
        while inner := int(splits[ends[-2] : ends[-1]].sum()):
            ends.append(ends[-1] + 2 * inner)
        for a, b in reversed(list(zip(ends, ends[1:]))):
            at = a + np.flatnonzero(splits[a:b])
            counts[at] = counts[left[at]] + counts[left[at] + 1]
        gain, on_left = np.zeros(len(feature)), counts[left[splits]]
        gain[splits] = kernel["impurity"](counts[splits]) - kernel["impurity"](on_left) - kernel["impurity"](counts[splits] - on_left)
        return feature, threshold, left, counts, gain

    def __iter__(self) -> Iterator[list]:
        for f, threshold, left, counts, gain in zip(*self.arrays()):
            yield [int(f), float(threshold), int(left), int(left) + 1 if f >= 0 else -1, counts, float(gain)]

    def __getitem__(self, node: int) -> list:
        return list(self)[node]


_GROWN = "tree int, node int, nodes binary"


def _grown(tree: int, node: int, nodes: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([node], pa.int32()), pa.array([pickle.dumps(nodes)], pa.binary())], ["tree", "node", "nodes"])


def _tools(width: int):
    """Reading of stored rows, in a closure as the kernel."""

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64, copy=False)

    def arrays(batch: pa.RecordBatch):
        return batch.column(0).to_numpy(), matrix(batch.column(1)), batch.column(2).to_numpy().astype(np.int64)

    return matrix, arrays


def grow_forest(
    df: DataFrame, growth: Growth, features: str = "features", label: str = "label", local_rows: int = LOCAL_ROWS, whole_bytes: int = WHOLE_BYTES,
) -> tuple[list[Tree], int, int]:
    """``(trees, classes, features)`` for labels 0, 1, ... Rows without a label are left out; NaN goes left. Rows are stored once, so
    that every pass sees the same row numbers. A table of at most ``whole_bytes`` goes to some tasks as a whole, each of which grows trees
    of its own; the trees of a larger one are grown by all tasks together. The trees are the same."""
    rows = store(_rows_of(df, features, label))
    about = rows.agg(F.max("y").alias("y"), F.max(F.size("x")).alias("width"), F.count(F.lit(1)).alias("n")).first()
    if not about["n"]:
        raise ValueError("no labelled rows to grow from")
    classes, width = about["y"] + 1, about["width"]
    table_bytes = about["n"] * width * 8
    if table_bytes <= whole_bytes:
        tops = [[[-1, 0.0, -1, -1, None]] for _ in range(growth.trees)]
        grown = _whole_trees(rows, growth, about["n"], width, classes, local_rows, table_bytes)
    else:
        tops, grown = _level_by_level(rows, growth, about["n"], width, classes, local_rows)
    below: list[dict] = [{} for _ in tops]
    # Stored, as an iteration over tasks would run them one by one.
    for r in store(grown).toLocalIterator() if grown is not None else ():
        below[r["tree"]][r["node"]] = pickle.loads(r["nodes"])
    return [_joined(top, parts, classes) for top, parts in zip(tops, below)], classes, width


def _joined(top: list, below: dict, classes: int) -> Tree:
    """A tree of the nodes grown together and what was grown below some of them."""
    if list(below) == [0]:
        return Tree(below[0])
    for node in top:
        if node[4] is None:  # no row of the tree's sample got here
            node[4] = np.ones(classes, np.int64)
    feature, threshold, left, right, counts = ([np.array([n[i] for n in top])] for i in range(5))
    total = len(top)
    for node, packed in below.items():
        f, cuts, to_left, counted, _ = Tree(packed).arrays()
        to_left = np.where(f >= 0, to_left + total - 1, -1)
        to_right = np.where(f >= 0, to_left + 1, -1)
        for whole, part in zip((feature, threshold, left, right, counts), (f, cuts, to_left, to_right, counted)):
            whole[0][node] = part[0]
            whole.append(part[1:])
        total += len(f) - 1
    return Tree.linked(*map(np.concatenate, (feature, threshold, left, right, counts)))


def _whole_trees(rows: DataFrame, growth: Growth, n: int, width: int, classes: int, local_rows: int, table_bytes: int) -> DataFrame:
    """``(tree, 0, nodes)`` of every tree, each grown in one task that holds the table by columns, its values as whole numbers."""
    kernel, (_, arrays), pack = _kernel(), _tools(width), _pack
    spark, slots = rows.sparkSession, rows.sparkSession.sparkContext.defaultParallelism
    groups = min(growth.trees, max(slots, min(3 * slots, _COPIED_BYTES // max(table_bytes, 1))))
    # One number for each group, which the shuffle deals to a task of its own.
    dealt = spark.range(64 * groups).select("id", F.pmod(F.hash("id"), F.lit(groups)).alias("task")).collect()
    numbers = list({r["task"]: r["id"] for r in dealt}.values())
    groups = len(numbers)

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                row, x, y = arrays(batch)
                parts = [pickle.dumps((row, y.astype(np.int32))), *[x[:, f].tobytes() for f in range(width)]]
                named = [pa.array(range(-1, width), pa.int32()), pa.array([int(row[0])] * (width + 1), pa.int64()), pa.array(parts, pa.binary())]
                yield pa.RecordBatch.from_arrays(named, ["feature", "block", "part"])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Parts stay in their batch, which may be large.
        parts = ((*key, part.as_buffer()) for batch in batches for *key, part in zip(*[c.to_pylist() for c in batch.columns[:3]], batch.column(3)))
        mine, codes, values = [], [], []
        for (number, feature), some in itertools.groupby(parts, lambda r: r[:2]):
            if number not in mine:
                mine.append(number)
            if number != mine[0]:
                continue  # the same table again
            if feature < 0:
                row, y = (np.concatenate(x) for x in zip(*[pickle.loads(r[3]) for r in some]))
            else:
                code, known = kernel["encode"](np.concatenate([np.frombuffer(r[3]) for r in some]))
                codes.append(code)
                values.append(known)
        if not mine:
            return
        codes = np.stack(codes) if width else np.empty((0, n), np.uint32)
        for t in (t for number in mine for t in range(numbers.index(number), growth.trees, groups)):
            w = np.concatenate([kernel["weights"](growth, t, row[i : i + (1 << 20)]).astype(np.int8) for i in range(0, n, 1 << 20)])
            feature, threshold, counts = kernel["grow"](growth, kernel["root"](growth, t), 0, codes, values, y, w, classes, n, local_rows)
            yield _grown(t, 0, pack(feature, threshold, counts if counts.any() else counts + 1))  # counts + 1: an empty sample

    by_column = rows.mapInArrow(columns, "feature int, block long, part binary")
    copies = by_column.select(F.explode(F.array(*[F.lit(x).cast("long") for x in numbers])).alias("copy"), "feature", "block", "part")
    return copies.repartition(groups, "copy").sortWithinPartitions("copy", "feature", "block").mapInArrow(grow, _GROWN)


def _level_by_level(rows: DataFrame, growth: Growth, n: int, width: int, classes: int, local_rows: int) -> tuple[list, DataFrame | None]:
    """The top of each tree, of nodes of more than ``local_rows`` rows, and ``(tree, node, nodes)`` of what is below."""
    kernel, (matrix, arrays), pack = _kernel(), _tools(width), _pack
    # The grown part of each tree, and its open nodes: (tree, node) -> (key, depth, rows).
    trees = [[[-1, 0.0, -1, -1, None]] for _ in range(growth.trees)]
    open_nodes = {(t, 0): (kernel["root"](growth, t), 0, n) for t in range(growth.trees)}

    def routes() -> list:
        """What ``route`` needs of each tree as grown so far."""
        return [tuple(np.array([n[i] for n in tree]) for i in range(3)) for tree in trees]

    def members(batch, wanted, grown):
        """``(tree, node, rows, x, y, w)`` of the wanted nodes that have rows in a batch."""
        row, x, y = arrays(batch)
        for t in sorted({t for t, _ in wanted}):
            w = kernel["weights"](growth, t, row)
            node = kernel["route"](*grown[t], x)
            for n in sorted(n for tree, n in wanted if tree == t):
                at = np.flatnonzero((node == n) & (w > 0))
                if len(at):
                    yield t, n, at, x[at], y[at], w[at]

    def summed(each, size: int) -> dict:
        """Per-partition sums of ``each(batch)``, added up by key and place."""
        out = rows.mapInArrow(each, "tree int, node int, feature int, cut int, class int, w long, n long").groupBy("tree", "node", "feature", "cut", "class")
        return out.agg(F.sum("w").alias("w"), F.sum("n").alias("n"))

    while large := {k: v for k, v in open_nodes.items() if v[2] > local_rows}:
        grown = routes()

        def extents(batches: Iterator[pa.RecordBatch], large=large, grown=grown) -> Iterator[pa.RecordBatch]:
            low, high = {}, {}
            for batch in batches:
                for t, n, _, x, _, _ in members(batch, large, grown):
                    old = np.full(width, np.inf), np.full(width, -np.inf)
                    low[t, n] = np.fmin(low.get((t, n), old[0]), np.nanmin(x, axis=0))
                    high[t, n] = np.fmax(high.get((t, n), old[1]), np.nanmax(x, axis=0))
            keys = [(t, n, f) for t, n in low for f in range(width)]
            tree, node, feature = (pa.array([k[i] for k in keys], pa.int32()) for i in range(3))
            ends = [pa.array([m[t, n][f] for t, n, f in keys], pa.float64()) for m in (low, high)]
            yield pa.RecordBatch.from_arrays([tree, node, feature, *ends], ["tree", "node", "feature", "low", "high"])

        found = rows.mapInArrow(extents, "tree int, node int, feature int, low double, high double").groupBy("tree", "node", "feature")
        bounds = {k: (np.full(width, np.inf), np.full(width, -np.inf)) for k in large}
        for r in found.agg(F.min("low").alias("low"), F.max("high").alias("high")).toLocalIterator():
            bounds[r["tree"], r["node"]][0][r["feature"]] = r["low"]
            bounds[r["tree"], r["node"]][1][r["feature"]] = r["high"]
        cuts = {
            (t, n): {f: kernel["cuts_of"](growth, key, f, bounds[t, n][0][f], bounds[t, n][1][f]) for f in kernel["chosen"](growth, key, *bounds[t, n])}
            for (t, n), (key, _, _) in large.items()
        }

        def count(batches: Iterator[pa.RecordBatch], cuts=cuts, grown=grown) -> Iterator[pa.RecordBatch]:
            sums: dict = {}
            for batch in batches:
                for t, n, _, x, y, w in members(batch, cuts, grown):
                    for f, edges in [(-1, np.empty(0)), *cuts[t, n].items()]:
                        # A value belongs to the first threshold that it does not exceed; NaN to the first of all.
                        place = np.zeros(len(y), np.int64) if f < 0 else np.where(np.isnan(x[:, f]), 0, np.searchsorted(edges, x[:, f], side="left"))
                        cell = place * classes + y
                        size = (len(edges) + 1) * classes
                        old = sums.setdefault((t, n, f), (np.zeros(size, np.int64), np.zeros(size, np.int64)))
                        old[0][:] += np.bincount(cell, w, size).astype(np.int64)
                        old[1][:] += np.bincount(cell, minlength=size)
            for (t, n, f), (w, rows_in) in sums.items():
                at = np.flatnonzero(rows_in)
                same = [pa.array(np.full(len(at), v), pa.int32()) for v in (t, n, f)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(at // classes, pa.int32()), pa.array(at % classes, pa.int32()), pa.array(w[at]), pa.array(rows_in[at])],
                                                 ["tree", "node", "feature", "cut", "class", "w", "n"])

        tables: dict = {}
        for r in summed(count, classes).toLocalIterator():
            key = (r["tree"], r["node"], r["feature"])
            if key not in tables:
                n_cuts = len(cuts[key[:2]][key[2]]) + 1 if key[2] >= 0 else 1
                tables[key] = np.zeros((n_cuts, classes), np.int64), np.zeros(n_cuts, np.int64)
            tables[key][0][r["cut"], r["class"]] += r["w"]
            tables[key][1][r["cut"]] += r["n"]
        for (t, n), (key, depth, _) in large.items():
            del open_nodes[t, n]
            counts, n_rows = tables[t, n, -1][0][0], int(tables[t, n, -1][1][0])
            trees[t][n][4] = counts
            best = None
            for f, edges in () if kernel["ends"](growth, counts, n_rows, depth) else cuts[t, n].items():
                left, left_rows = (np.cumsum(m, axis=0)[:-1] for m in tables[t, n, f])
                gain, at = kernel["best_of"](left, left_rows, counts, n_rows, growth.min_leaf)
                if at >= 0 and (best is None or gain > best[0]):
                    best = (gain, f, float(edges[at]), int(left_rows[at]))
            if best is not None:
                gain, f, threshold, n_left = best
                sides = [len(trees[t]), len(trees[t]) + 1]
                trees[t][n] = [f, threshold, *sides, counts]
                for side, size in zip(sides, (n_left, n_rows - n_left)):
                    trees[t].append([-1, 0.0, -1, -1, None])
                    open_nodes[t, side] = (kernel["child"](key, side == sides[1]), depth + 1, size)

    small, grown = open_nodes, routes()
    if not small:
        return trees, None

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, n, at, _, _, w in members(batch, small, grown):
                same = [pa.array(np.full(len(at), v), pa.int32()) for v in (t, n)]
                yield pa.RecordBatch.from_arrays([*same, batch.column(1).take(pa.array(at)), batch.column(2).take(pa.array(at)), pa.array(w)], ["tree", "node", "x", "y", "w"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(node, parts) -> pa.RecordBatch:
            key, depth, _ = small[node]
            x, y, w = (np.concatenate([p[i] for p in parts]) for i in range(3))
            codes, values = zip(*[kernel["encode"](column) for column in x.T]) if width else ((), ())
            codes = np.stack(codes) if width else np.empty((0, len(y)), np.uint32)
            # A small node, however many rows were counted.
            return _grown(*node, pack(*kernel["grow"](growth, key, depth, codes, list(values), y, w, classes, 0, len(y))))

        current, parts = None, []
        for batch in batches:
            tree, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = [0, *(np.flatnonzero((tree[1:] != tree[:-1]) | (node[1:] != node[:-1])) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if b > a:
                    if current not in (None, (tree[a], node[a])):
                        yield done(current, parts)
                        parts = []
                    current, piece = (int(tree[a]), int(node[a])), batch.slice(a, b - a)
                    parts.append((matrix(piece.column(2)), piece.column(3).to_numpy().astype(np.int64), piece.column(4).to_numpy()))
        if parts:
            yield done(current, parts)

    dealt = rows.mapInArrow(deal, "tree int, node int, x array<double>, y int, w long")
    by_node = dealt.repartition(min(len(small), _MOST_TASKS), "tree", "node").sortWithinPartitions("tree", "node")
    return trees, by_node.mapInArrow(finish, _GROWN)


class Forest(Estimator):
    """A forest of ``growth`` on an array or vector column; labels are 0, 1, ..."""

    def __init__(self, growth: Growth, features: str = "features", label: str = "label", local_rows: int = LOCAL_ROWS):
        super().__init__()
        self.growth, self.features, self.label, self.local_rows = growth, features, label, local_rows

    def _fit(self, dataset: DataFrame) -> ForestModel:
        return ForestModel(*grow_forest(dataset, self.growth, self.features, self.label, self.local_rows), self.features)


_NODE = "tree int, node int, feature int, threshold double, left int, right int, counts array<long>, gain double"


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        model, spark = self.model, self.sparkSession
        about = {"classes": int(model.classes), "width": int(model.width), "features": model.features}
        DefaultParamsWriter.saveMetadata(model, path, spark, extraMetadata={"forest": about})
        nodes = [(t, i, int(f), float(at), int(left), int(right), counts.tolist(), float(gain))
                 for t, tree in enumerate(model.trees) for i, (f, at, left, right, counts, gain) in enumerate(tree)]
        spark.createDataFrame(nodes, _NODE).write.parquet(f"{path}/nodes")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        about = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        trees: list = []
        for r in self.sparkSession.read.schema(_NODE).parquet(f"{path}/nodes").orderBy("tree", "node").toLocalIterator():
            trees += [[]] if r["node"] == 0 else []
            trees[-1].append([r["feature"], r["threshold"], r["left"], r["right"], np.array(r["counts"], np.int64), r["gain"]])
        linked = [Tree.linked(*(np.array([n[i] for n in tree]) for i in range(5))) for tree in trees]
        model = ForestModel(linked, *(about["forest"][k] for k in ("classes", "width", "features")))
        model._resetUid(about["uid"])
        return model


class ForestModel(Model, MLWritable, MLReadable):
    """Grown trees; ``transform`` adds ``probability`` (a vector, the mean of the leaves' class shares) and ``prediction``."""

    def __init__(self, trees: list, classes: int, width: int, features: str):
        super().__init__()
        self.trees, self.classes, self.width, self.features = trees, classes, width, features

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()

    @property
    def featureImportances(self) -> np.ndarray:
        """Gini decrease by feature, every tree weighing the same."""
        total = np.zeros(self.width)
        for tree in self.trees:
            feature, _, _, _, gain = tree.arrays()
            own = np.bincount(feature[feature >= 0], gain[feature >= 0], self.width)
            total += own / own.sum() if own.sum() > 0 else own
        return total / total.sum() if total.sum() > 0 else total

    def _transform(self, dataset: DataFrame) -> DataFrame:
        leaf_shares, width, classes = _kernel()["leaf_shares"], self.width, self.classes
        shared = dataset.sparkSession.sparkContext.broadcast([tree.packed for tree in self.trees])

        @F.pandas_udf("array<double>")
        def shares(x):
            import pandas as pd

            matrix = np.array(x.tolist(), np.float64).reshape(len(x), width)
            out = np.zeros((len(x), classes))
            for tree in shared.value:
                out += leaf_shares(tree, matrix)
            return pd.Series(list(out / len(shared.value)))

        values = vector_to_array(self.features) if isinstance(dataset.schema[self.features].dataType, VectorUDT) else F.col(self.features).cast("array<double>")
        # A row takes far longer to score by many trees than to move, and few files make few tasks.
        dealt = dataset.repartition(4 * dataset.sparkSession.sparkContext.defaultParallelism) if len(self.trees) >= _MANY_TREES else dataset
        out = dealt.withColumn("__shares", shares(values))
        first = F.array_position("__shares", F.array_max("__shares")) - 1
        return out.withColumns({"probability": array_to_vector("__shares"), "prediction": first.cast("double")}).drop("__shares")



"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes. Each passage is encoded by the shares of neighbouring
byte classes (letters by case and kind, digits, blanks, single punctuation marks), projected and squashed.
Gated attention gives each passage a weight, ``softmax(w . (tanh(V h) * sigmoid(U h)))`` over its bag, and the
weighted mean of the passages is scored by a logistic unit. Only document labels are needed: the gate learns
which passages decide.

Training uses a bounded sample of labelled documents, those with the least hash of their id: at most ``max_documents``
of them and no more than ``max_bytes`` of text together, with every passage of each. Its passages reach the driver as
the few features that are not zero. Scoring uses every passage of every text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store
from .buffers import utf8_slices
from .shipping import ship

PASSAGE = 400
MAX_DOCUMENTS = 4_000
MAX_BYTES = 64 << 20
HIDDEN, GATE = 24, 12
_SLICE = 2 << 20

# Byte classes: blank, line end, digit, capital, vowel, other letter, non-ASCII, and each common mark.
_MARKS = b"!?.,;:|*#$%&@=/\\-_<>()[]{}\"'"
_CLASSES = 7 + len(_MARKS) + 1
_CLASS = np.full(256, _CLASSES - 1, np.uint8)
_CLASS[[9, 32]] = 0
_CLASS[[10, 13]] = 1
_CLASS[48:58] = 2
_CLASS[65:91] = 3
_CLASS[97:123] = 5
_CLASS[list(b"aeiou")] = 4
_CLASS[128:] = 6
_CLASS[list(_MARKS)] = 7 + np.arange(len(_MARKS))
N_FEATURES = _CLASSES * _CLASSES


def passages(data: np.ndarray, offsets: np.ndarray, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Features of each passage and its text's number; a text has at least one passage, the empty text one of
    zeros. A rest shorter than half a passage belongs to the passage before."""
    n = np.diff(offsets)
    counts = np.maximum(1, (n + size // 2) // size)
    doc = np.repeat(np.arange(len(n)), counts)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    features = np.zeros((len(doc), N_FEATURES), np.float32)
    if len(data):
        kinds = _CLASS[data].astype(np.int64)
        own = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(data)) - np.repeat(offsets[:-1], n)
        number = first[own] + np.minimum(at // size, counts[own] - 1)
        pair = kinds[:-1] * _CLASSES + kinds[1:]
        inside = number[:-1] == number[1:]
        flat = np.bincount(number[:-1][inside] * N_FEATURES + pair[inside], minlength=features.size)
        features = flat.reshape(features.shape).astype(np.float32)
    total = features.sum(axis=1, keepdims=True)
    return np.sqrt(features / np.maximum(total, 1)), doc


class SparseRows:
    """Passages kept as the places and values (0 to 255) of the features that are not zero; rows are filled on demand."""

    def __init__(self, places: np.ndarray, values: np.ndarray, counts: np.ndarray):
        self.places, self.values = places, values
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        counts = self.ends[rows] - self.starts[rows]
        at = np.repeat(self.starts[rows] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        dense = np.zeros((len(rows), N_FEATURES), np.float32)
        dense[np.repeat(np.arange(len(rows)), counts), self.places[at]] = self.values[at].astype(np.float32) / 255
        return dense


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class AttentionModel:
    """Weights of encoder, gate and scoring unit."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def start(seed: int = 7) -> AttentionModel:
        draw = np.random.default_rng(seed)
        shape = {"E": (N_FEATURES, HIDDEN), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,)}
        weights = {k: draw.normal(0, 1 / np.sqrt(s[0]) if k != "E" else 0.3, s) for k, s in shape.items()}
        return AttentionModel({**weights, "e": np.zeros(HIDDEN), "b": np.zeros(1)})

    def forward(self, x: np.ndarray, doc: np.ndarray, n_docs: int) -> dict[str, np.ndarray]:
        """``doc`` ascending, every document with at least one passage."""
        p = self.weights
        h = np.tanh(x @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        a = (t * g) @ p["w"]
        first = np.searchsorted(doc, np.arange(n_docs))
        a = np.exp(a - np.maximum.reduceat(a, first)[doc])
        a = a / np.add.reduceat(a, first)[doc]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "first": first, "score": _sigmoid(z @ p["c"] + p["b"])}

    def gradients(self, x, doc, labels, sample_weight) -> dict[str, np.ndarray]:
        p, f = self.weights, self.forward(x, doc, len(labels))
        d_out = (f["score"] - labels) * sample_weight / sample_weight.sum()
        d_z = d_out[:, None] * p["c"]
        d_a = (d_z[doc] * f["h"]).sum(axis=1)
        d_s = f["a"] * (d_a - np.add.reduceat(f["a"] * d_a, f["first"])[doc])
        d_tg = d_s[:, None] * p["w"]
        d_t, d_g = d_tg * f["g"] * (1 - f["t"] ** 2), d_tg * f["t"] * f["g"] * (1 - f["g"])
        d_h = f["a"][:, None] * d_z[doc] + d_t @ p["V"].T + d_g @ p["U"].T
        d_pre = d_h * (1 - f["h"] ** 2)
        return {
            "E": x.T @ d_pre, "e": d_pre.sum(axis=0), "V": f["h"].T @ d_t, "U": f["h"].T @ d_g,
            "w": (f["t"] * f["g"]).T @ d_s, "c": f["z"].T @ d_out, "b": np.array([d_out.sum()]),
        }

    def fit(self, x, doc, labels, *, epochs: int = 60, batch: int = 128, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> AttentionModel:
        """Adam over mini-batches of documents. Classes keep their natural weights, so scores are probabilities."""
        draw = np.random.default_rng(seed)
        moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.weights.items()}
        first = np.searchsorted(doc, np.arange(len(labels) + 1))
        step = 0
        for epoch in range(epochs):
            order = draw.permutation(len(labels))
            for i in range(0, len(order), batch):
                chosen = np.sort(order[i : i + batch])
                sizes = first[chosen + 1] - first[chosen]
                rows = np.repeat(first[chosen] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
                own = np.repeat(np.arange(len(chosen)), sizes)
                step += 1
                pace = rate * (1 - epoch / epochs)
                for k, d in self.gradients(x[rows], own, labels[chosen], np.ones(len(chosen))).items():
                    m, v = moment[k]
                    d = d + decay * self.weights[k]
                    m *= 0.9
                    m += 0.1 * d
                    v *= 0.999
                    v += 0.001 * d * d
                    self.weights[k] -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x, doc = passages(data, offsets)
        return self.forward(x, doc, len(offsets) - 1)["score"]


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that no label is learned from: the CRC-32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _training_texts(docs: DataFrame, labels: DataFrame, label: str, max_documents: int, max_bytes: int) -> DataFrame:
    """``(doc_id, text, __label)`` of the sample: whole texts in the order of their id's hash, up to both bounds. Texts of
    more than a sixteenth of ``max_bytes`` come last, so that none fills the sample alone."""
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    chosen = usable.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("__label"))
    chosen = store(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents))
    texts = docs.select("doc_id", "text")
    # Sums over the sample's ids, at most max_documents rows.
    sizes = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "__label").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("n"))
    order = Window.orderBy(F.col("n") > max_bytes // 16, F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    within = sizes.withColumn("__all", F.sum("n").over(order)).where(F.col("__all") <= max_bytes).select("doc_id", "__label")
    return texts.join(F.broadcast(within), "doc_id")


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", *, max_documents: int = MAX_DOCUMENTS, max_bytes: int = MAX_BYTES) -> AttentionModel:
    """Model fitted on at most ``max_documents`` labelled documents that are not held out, with at most ``max_bytes`` of text.

    Null labels and ids are left out; a document labelled more than once counts as 1 if any label is 1. With no
    labelled text the untrained prior of an even score is returned.
    """
    ship(docs.sparkSession)
    sample = _training_texts(docs, labels, label, max_documents, max_bytes)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in utf8_slices(batch.column(1), _SLICE):
                x, doc = passages(data, offsets)
                start = np.searchsorted(doc, np.arange(len(offsets) - 1))
                x = np.rint(255 * x).astype(np.uint8)
                places = [np.flatnonzero(r).astype(np.uint16) for r in x]
                own = batch.slice(first, len(offsets) - 1).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([
                    own.column(0), own.column(2), pa.array(np.arange(len(doc)) - start[doc]),
                    pa.array([p.tobytes() for p in places], pa.binary()), pa.array([r[p].tobytes() for r, p in zip(x, places)], pa.binary()),
                ], ["doc_id", "label", "rank", "places", "shares"])

    encoded = sample.select("doc_id", "text", "__label").mapInArrow(encode, f"doc_id {kind}, label int, rank long, places binary, shares binary")
    table = encoded.toArrow().sort_by([("doc_id", "ascending"), ("rank", "ascending")])
    model = AttentionModel.start()
    if not table.num_rows:
        model.weights["c"][:] = 0
        return model
    ids = table.column("doc_id").combine_chunks().dictionary_encode().indices.to_numpy()
    shares = table.column("shares").to_pylist()
    x = SparseRows(
        np.frombuffer(b"".join(table.column("places").to_pylist()), np.uint16), np.frombuffer(b"".join(shares), np.uint8),
        np.array([len(r) for r in shares], np.int64),
    )
    first = np.searchsorted(ids, np.arange(ids[-1] + 1))
    return model.fit(x, ids, table.column("label").to_numpy()[first].astype(np.float64))


def _scorer(sent):
    def run(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = pickle.loads(sent.value)
        for texts in column:
            parts = [model.scores(data, offsets) for _, _, data, offsets in utf8_slices(texts, _SLICE)]
            yield pa.array(np.concatenate(parts) if parts else np.empty(0), pa.float64())

    return run


def score_quality(docs: DataFrame, model: AttentionModel, text: str = "text") -> Column:
    """Column with the score (0 to 1) of every whole text of ``docs``; null is the empty text."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    return F.arrow_udf(_typed(_scorer(sent)), "double")(F.col(text))


def _typed(run):
    def scores(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from run(column)

    return scores


def drop_low_quality(docs: DataFrame, model: AttentionModel, *, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``."""
    return docs.where(score_quality(docs, model) >= threshold)

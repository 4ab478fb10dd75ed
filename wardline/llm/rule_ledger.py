"""Quality rules as a ledger of bit masks.

Every rule is evaluated once per document. The ledger keeps what was measured and one bit per failed rule;
a policy is a version and the mask of the rules that it applies, so another policy, or the same without one of
its rules, is judged from the stored bits, without reading a text again. Bits are fixed: a changed rule is a new rule
with a new bit, and old ledgers stay readable.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .buffers import utf8_slices
from .shipping import ship

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper",
    "n_letter_words", "n_bullet_lines", "n_ellipsis_lines",
)
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``fails`` is a condition on the measurements, in whole numbers."""

    bit: int
    name: str
    fails: Callable[[], Column]


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]


_c = F.col
# Limits as published for large web corpora; the first two are the base rules.
RULES = (
    Rule(0, "few_words", lambda: _c("n_words") < 10),
    Rule(1, "repeated_windows", lambda: 100 * _c("n_repeat_words") > 20 * _c("n_words")),
    Rule(2, "many_words", lambda: _c("n_words") > 1_000_000),
    Rule(3, "short_words", lambda: 10 * _c("word_chars") < 25 * _c("n_words")),
    Rule(4, "long_words", lambda: _c("word_chars") > 12 * _c("n_words")),
    Rule(5, "symbols", lambda: 10 * _c("n_symbols") > _c("n_words")),
    Rule(6, "repeated_lines", lambda: 100 * _c("n_dup_lines") > 30 * _c("n_lines")),
    Rule(7, "few_letter_words", lambda: 100 * _c("n_letter_words") < 80 * _c("n_words")),
    Rule(8, "upper_case", lambda: 100 * _c("n_upper") > 60 * _c("n_letters")),
    Rule(9, "bullets", lambda: 100 * _c("n_bullet_lines") > 90 * _c("n_lines")),
    Rule(10, "ellipses", lambda: 100 * _c("n_ellipsis_lines") > 30 * _c("n_lines")),
)
BASE = Policy("base", ("few_words", "repeated_windows"))
POLICIES = (
    BASE,
    Policy("v1", (*BASE.rules, "many_words", "short_words", "long_words", "symbols", "few_letter_words")),
    Policy("v2", tuple(r.name for r in RULES)),
)

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
# The first byte of a character beyond ASCII counts as a letter.
_LETTER[0xC2:0xF5] = True
_BULLETS = ("-", "*", "•")
_ELLIPSES = ("...", "…")


def _strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _codes(values: pa.Array) -> tuple[np.ndarray, int]:
    """A number for each distinct string, by comparison of the strings themselves."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(1, len(coded.dictionary))


def _pairs(left: np.ndarray, right: np.ndarray, n_right: int) -> tuple[np.ndarray, int]:
    codes, distinct = pd.factorize(left * n_right + right)
    return codes.astype(np.int64), max(1, len(distinct))


def measure_texts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measurements of texts that lie one behind the other in ``data``."""
    n, size = len(offsets) - 1, len(data)

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(size + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]

    def counted(rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows, minlength=n).astype(np.int64)

    def row_of(places: np.ndarray) -> np.ndarray:
        return np.searchsorted(offsets, places, side="right") - 1

    inside = ~_SPACE[data]
    first_byte = (data & 0xC0) != 0x80
    letters, uppers = _LETTER[data], _UPPER[data]
    out = {
        "word_chars": per_row(inside & first_byte), "n_symbols": per_row(_SYMBOL[data]), "n_letters": per_row(letters),
        "n_upper": per_row(uppers),
    }

    row_start = np.zeros(size + 1, bool)
    row_start[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if size else inside
    starts = np.flatnonzero(inside & (~before | row_start[:-1]))
    after = np.concatenate((inside[1:], [False])) if size else inside
    ends = np.flatnonzero(inside & (~after | row_start[1:])) + 1
    rows = row_of(starts)
    out["n_words"] = counted(rows)
    seen = np.zeros(size + 1, np.int64)
    np.cumsum(letters, out=seen[1:])
    out["n_letter_words"] = counted(rows[seen[ends] > seen[starts]])

    # A word belongs to a repeated window if a window that covers it stands in the text more than once.
    covered = np.zeros(len(starts) + 1, np.int64)
    if len(starts) >= WINDOW:
        words, n_words = _codes(_strings(data[inside], ends - starts))
        twos, n_twos = _pairs(words[:-1], words[1:], n_words)
        fours, _ = _pairs(twos[:-2], twos[2:], n_twos)
        fives, n_fives = _pairs(fours[:-1], words[4:], n_words)
        whole = np.flatnonzero(rows[:-4] == rows[4:])
        keys, _ = pd.factorize(rows[whole] * n_fives + fives[whole])
        again = whole[np.bincount(keys)[keys] > 1] if len(whole) else whole
        np.add.at(covered, again, 1)
        np.add.at(covered, again + WINDOW, -1)
    out["n_repeat_words"] = counted(rows[np.cumsum(covered[:-1]) > 0])

    newline = data == 10
    at = np.unique(np.concatenate((offsets[:-1], np.flatnonzero(newline) + 1)))
    at = at[at < size]
    until = np.concatenate((at[1:], [size])) if len(at) else at
    total = np.zeros(size + 1, np.int64)
    np.cumsum(inside, out=total[1:])
    filled = total[until] > total[at]
    lines = _strings(data[~newline], until - at - newline[until - 1]).filter(pa.array(filled))
    line_rows = row_of(at[filled])
    out["n_lines"] = counted(line_rows)
    codes, n_codes = _codes(lines)
    out["n_dup_lines"] = out["n_lines"] - counted(np.unique(line_rows * n_codes + codes) // n_codes)
    trimmed = [line.strip(b" \t\r\x0b\x0c") for line in lines.dictionary_encode().dictionary.to_pylist()]
    begins = tuple(b.encode() for b in _BULLETS)
    closes = tuple(e.encode() for e in _ELLIPSES)
    bullet = np.array([t.startswith(begins) for t in trimmed], bool)
    ellipsis = np.array([t.endswith(closes) for t in trimmed], bool)
    out["n_bullet_lines"] = counted(line_rows[bullet[codes]]) if len(codes) else counted(line_rows)
    out["n_ellipsis_lines"] = counted(line_rows[ellipsis[codes]]) if len(codes) else counted(line_rows)
    return out


def measure(docs: DataFrame) -> DataFrame:
    """``(doc_id, *MEASURES)``, one row per input row, over whole texts; see ``rule_ledger`` for odd rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in utf8_slices(batch.column(1)):
                found = measure_texts(data, offsets)
                columns = [batch.column(0).slice(first, end - first), *[pa.array(found[m], pa.int64()) for m in MEASURES]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *MEASURES])

    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, ", ".join([f"doc_id {kind}", *[f"{m} long" for m in MEASURES]]))


def failed_bits(rules: Sequence[Rule] = RULES) -> Column:
    """The bits of the failed rules as one long."""
    if len({r.bit for r in rules}) < len(rules) or any(not 0 <= r.bit < 63 for r in rules):
        raise ValueError("every rule needs a bit of its own from 0 to 62")
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << rule.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def rule_ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``(doc_id, *MEASURES, failed)``, one row per row of ``docs``, the same order of columns at any version.

    Words are runs without ASCII white space, lines are split at line feeds and count if they have a word; a line is
    repeated if an earlier line is equal. Null is the empty text, which fails the rules that its zeros fail (too few
    words). Null and repeated ids are rows like any other, extra columns are left out, an empty table has no rows.
    """
    return measure(docs).withColumn("failed", failed_bits(rules))


def mask_of(policy: Policy, rules: Sequence[Rule] = RULES) -> int:
    bits = {r.name: 1 << r.bit for r in rules}
    return sum(bits[name] for name in policy.rules)


def passes(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """Whether a row of the ledger fails none of the policy's rules."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(policy, rules)).cast("long")) == 0


def ablation(ledger: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES, by: Sequence[str] = ()) -> DataFrame:
    """What each rule does in each policy: ``(by..., policy, rule, n_docs, n_failed, n_only, n_kept, n_kept_without)``.

    ``n_only`` documents fail this rule of the policy and no other, so ``n_kept_without`` is ``n_kept`` and those.
    Rows with equal bits are counted together first: at most as many groups as sets of rules that occur.
    """
    bits = {r.name: 1 << r.bit for r in rules}
    cases = [(p.version, name, bits[name], mask_of(p, rules)) for p in policies for name in p.rules]
    schema = F.array(*[
        F.struct(F.lit(v).alias("policy"), F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit"), F.lit(m).cast("long").alias("mask"))
        for v, n, b, m in cases
    ])
    sets = ledger.groupBy(*by, "failed").agg(F.count(F.lit(1)).alias("n"))
    each = sets.select(*by, "failed", "n", F.inline(schema))
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")
    return each.groupBy(*by, "policy", "rule").agg(
        F.sum("n").alias("n_docs"), total(hit.bitwiseAND(F.col("bit")) != 0).alias("n_failed"), total(hit == F.col("bit")).alias("n_only"),
        total(hit == 0).alias("n_kept"), total((hit == 0) | (hit == F.col("bit"))).alias("n_kept_without"),
    )


def always_and_ever(ledger: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(by..., n_docs, ever, always)``: the rules that some, and that all, documents of a group fail, as bits."""
    return ledger.groupBy(*by).agg(F.count(F.lit(1)).alias("n_docs"), F.bit_or("failed").alias("ever"), F.bit_and("failed").alias("always"))


def drop_failed(docs: DataFrame, ledger: DataFrame, policy: Policy = POLICIES[-1], rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` without the ids that fail the policy in the ledger; of rows that repeat an id all stay or none, and
    rows with a null id stay."""
    losers = ledger.where(~passes(policy, rules)).select(F.col("doc_id").alias("__loser")).distinct()
    return docs.join(losers, docs["doc_id"] == F.col("__loser"), "left_anti")

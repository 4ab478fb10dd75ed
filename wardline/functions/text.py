"""Text expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Marker words of placeholder text, and how many must occur.
LOREM_MARKERS = (
    "lorem", "ipsum", "dolor", "sit amet", "consectetur",
    "adipiscing", "elit", "sed do", "eiusmod", "tempor",
    "incididunt", "labore", "dolore", "magna", "aliqua",
)
LOREM_MIN_MARKERS = 3


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_city_state(col: Column | str) -> tuple[Column, Column]:
    """``"City, State"`` into two columns, cut at the first comma; state is null without one."""
    parts = F.split(_col(col), ", ", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def split_city_state_strict(col: Column | str) -> tuple[Column, Column]:
    """The scoring-time form: both null unless the text has exactly two parts."""
    parts = F.split(_col(col), ", ")
    two = F.size(parts) == 2
    return F.when(two, F.get(parts, F.lit(0))), F.when(two, F.get(parts, F.lit(1)))


def signature_prefix(col: Column | str) -> Column:
    """First space-separated token, ``Unknown`` when missing."""
    return F.coalesce(F.substring_index(_col(col), " ", 1), F.lit("Unknown"))


def lorem_ipsum_flag(text: Column | str) -> Column:
    """True when at least three of the marker words occur anywhere in the text."""
    lowered = F.lower(_col(text))
    hits = F.lit(0)
    for marker in LOREM_MARKERS:
        hits = hits + lowered.contains(marker).cast("int")
    return hits >= LOREM_MIN_MARKERS


def _entropies(texts: list[str]) -> np.ndarray:
    """Entropy of each text, all characters of the texts counted together."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    present = np.zeros(0x110000, bool)
    present[points] = True
    number, kinds = np.cumsum(present) - 1, int(present.sum())
    cell = np.repeat(np.arange(len(texts)), sizes) * kinds + number[points]
    share = np.bincount(cell, minlength=len(texts) * kinds).reshape(len(texts), kinds) / np.maximum(sizes, 1)[:, None]
    return -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1) + 0.0


def text_entropy(text: Column | str) -> Column:
    """Shannon entropy (bits) of the characters of a text, 0 for the empty text.

    Row-local, so no shuffle and no exploded copy of the corpus is needed. The built-in string
    functions need one pass per distinct character; here runs of at most 256 texts of an Arrow batch
    (and about a million characters) are counted at once.
    """

    @F.pandas_udf("double")
    def entropy(texts: pd.Series) -> pd.Series:
        known = texts[texts.notna()]
        out = pd.Series(np.nan, index=texts.index, dtype="float64")
        upto = known.str.len().cumsum().to_numpy()
        first = 0
        while first < len(known):
            before = upto[first - 1] if first else 0
            end = min(first + 256, max(first + 1, int(np.searchsorted(upto, before + (1 << 20)))))
            part = known.iloc[first:end]
            out[part.index] = _entropies(part.tolist())
            first = end
        return out.astype(object).where(texts.notna(), None).astype("Float64")

    return entropy(_col(text))


def script_flag(text: Column | str) -> Column:
    """``latin`` when at least half of the letters are Latin, else ``not_latin``."""
    t = _col(text)
    letters = F.length(F.regexp_replace(t, r"\P{L}+", ""))
    latin = F.length(F.regexp_replace(t, r"\P{IsLatin}+", ""))
    is_latin = (letters > 0) & (latin * 2 >= letters)
    return F.when(t.isNotNull(), F.when(is_latin, "latin").otherwise("not_latin"))

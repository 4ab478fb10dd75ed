"""Chat formatting by schema fingerprints, in DataFrame functions only.

Records of different layouts (prompt and response, instruction and output, lists of messages) usually
arrive as one table whose columns are the union of all fields. The nested paths that a row fills are
hashed to its fingerprint; a map from fingerprint to layout selects the declarative mapping that turns
the record into canonical turns, which a template then formats.

Template: every turn is ``<|turn|>role<|text|>text<|end|>``. In roles and texts a backslash is doubled and
``<|`` becomes ``<\\|``, so no marker can occur inside them and the original is read back exactly.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"


@dataclass(frozen=True)
class Layout:
    """A record layout: paths that must be filled, paths that may be, and the turns made of them.

    ``turns`` gets a function from a top-level field name to its column and returns an array of
    ``struct(role, text)``.
    """

    name: str
    required: tuple[str, ...]
    turns: Callable[[Callable[[str], Column]], Column]
    optional: tuple[str, ...] = ()

    def path_sets(self) -> list[tuple[str, ...]]:
        extra = [c for n in range(len(self.optional) + 1) for c in itertools.combinations(self.optional, n)]
        return [tuple(sorted({*self.required, *c})) for c in extra]


def _turn(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _messages(array: str, role: str, text: str, roles: dict[str, str] | None = None):
    def turns(field):
        def one(m):
            name = F.coalesce(m[role], F.lit(""))
            if roles:
                known = F.create_map(*[F.lit(x) for pair in roles.items() for x in pair])
                name = F.coalesce(known[name], name)
            return F.struct(name.alias("role"), F.coalesce(m[text], F.lit("")).alias("text"))

        return F.transform(field(array), one)

    return turns


def _system_first(field, *rest: Column) -> Column:
    turns = F.array(_turn("system", field("system")), *rest)
    return F.filter(turns, lambda t: ~((t["role"] == "system") & (t["text"] == "")))


LAYOUTS = (
    Layout("messages", ("messages",), _messages("messages", "role", "content"), ("messages[].role", "messages[].content")),
    Layout(
        "conversations", ("conversations",),
        _messages("conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
        ("conversations[].from", "conversations[].value"),
    ),
    Layout(
        "instruction", ("instruction", "output"),
        lambda f: _system_first(
            f, _turn("user", F.concat_ws("\n\n", f("instruction"), F.nullif(f("input"), F.lit("")))), _turn("assistant", f("output"))
        ),
        ("input", "system"),
    ),
    Layout(
        "prompt", ("prompt", "response"),
        lambda f: _system_first(f, _turn("user", f("prompt")), _turn("assistant", f("response"))), ("system",),
    ),
    Layout(
        "question", ("question", "answer"),
        lambda f: F.array(_turn("user", f("question")), _turn("assistant", f("answer"))),
    ),
)


def filled_paths(record: DataFrame, fields: Sequence[str]) -> Column:
    """Sorted array of the nested paths that a row fills, e.g. ``messages[].role``."""

    def walk(kind: T.DataType, path: str, filled: Callable[[Callable[[Column], Column]], Column]) -> list[Column]:
        # ``filled(get)`` says whether ``get`` of the value, or of any element on the way, is not null.
        found = [F.when(filled(lambda c: c), F.lit(path))]
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                found += walk(f.dataType, f"{path}.{f.name}", lambda get, f=f: filled(lambda c: get(c[f.name])))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            for f in kind.elementType.fields:
                def inside(get, f=f):
                    return filled(lambda c: F.when(F.exists(c, lambda e: get_present(get(e[f.name]))), F.lit(True)))

                found += walk(f.dataType, f"{path}[].{f.name}", inside)
        return found

    def get_present(c: Column) -> Column:
        return c.isNotNull()

    columns = []
    for name in fields:
        top = F.col(f"`{name}`")
        columns += walk(record.schema[name].dataType, name, lambda get, top=top: get(top).isNotNull())
    return F.array_sort(F.array_compact(F.array(*columns)))


def fingerprint(paths: Column) -> Column:
    """Hash of a sorted array of paths."""
    return F.xxhash64(F.concat_ws("\n", paths))


def canonical_turns(records: DataFrame, fields: Sequence[str], layouts: Sequence[Layout] = LAYOUTS, *, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., fingerprint, layout, turns)``, ``turns`` an array of ``struct(role, text)``.

    Only ``fields`` are looked at. A row whose filled paths are those of no layout has null ``layout``
    and null ``turns``; it is not dropped. Fields that a layout needs and the table lacks count as null.
    Null roles and texts become empty.
    """
    known = {}
    for layout in layouts:
        for paths in layout.path_sets():
            known.setdefault(paths, layout.name)
    by_print = F.create_map(
        *[c for paths, name in known.items() for c in (fingerprint(F.array(*[F.lit(p) for p in paths])), F.lit(name))]
    )
    out = records.select(*keep, *[F.col(f"`{f}`").alias(f"__{f}") for f in fields], fingerprint(filled_paths(records, fields)).alias("fingerprint"))
    out = out.withColumn("layout", by_print[F.col("fingerprint")])
    field = lambda n: F.col(f"`__{n}`") if n in fields else F.lit(None).cast("string")
    turns = None
    for layout in layouts:
        if {p.split("[")[0].split(".")[0] for p in layout.required} <= set(fields):
            mapped = layout.turns(field)
            turns = F.when(F.col("layout") == layout.name, mapped) if turns is None else turns.when(F.col("layout") == layout.name, mapped)
    if turns is None:
        turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    return out.select(*keep, "fingerprint", "layout", turns.alias("turns"))


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def format_turns(turns_table: DataFrame, *, keep: Sequence[str] = (), loss_roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """``(keep..., formatted, loss_runs)`` from ``turns``.

    ``loss_runs`` is the loss mask as run lengths in code points, one entry per turn:
    ``off`` characters without loss, ``on`` with loss (the escaped text of a turn of ``loss_roles``), then
    ``rest`` without. The lengths add up to that of ``formatted``. Null or empty ``turns`` give the empty
    text and no runs.
    """
    turns = F.coalesce("turns", F.array().cast("array<struct<role:string,text:string>>"))

    def piece(t):
        return F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT), escape(t["text"]), F.lit(END))

    def run(t):
        head = F.length(escape(t["role"])) + len(TURN) + len(TEXT)
        text = F.length(escape(t["text"]))
        on = F.when(t["role"].isin(*loss_roles), text).otherwise(0)
        return F.struct(head.alias("off"), on.alias("on"), (text - on + len(END)).alias("rest"))

    return turns_table.select(
        *keep, F.concat_ws("", F.transform(turns, piece)).alias("formatted"), F.transform(turns, run).alias("loss_runs")
    )


def read_back(formatted: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., turns, loss_texts)`` from ``formatted`` and ``loss_runs`` alone: the turns, and the unescaped
    text under the mask, one entry per run with any."""
    pieces = F.filter(F.split("formatted", r"<\|end\|>", -1), lambda p: p != "")

    def turn(p):
        parts = F.split(p, r"<\|text\|>", 2)
        return F.struct(
            unescape(F.substring(parts[0], len(TURN) + 1, 2**31 - 1)).alias("role"), unescape(parts[1]).alias("text")
        )

    # Runs and pieces are aligned, so the mask is applied piece by piece in one pass over the text.
    masked = F.zip_with(
        pieces, F.col("loss_runs"), lambda p, r: F.when(r["on"] > 0, F.substr(p, r["off"] + 1, r["on"]))
    )
    return formatted.select(
        *keep, F.transform(pieces, turn).alias("turns"), F.transform(F.array_compact(masked), unescape).alias("loss_texts")
    )

"""Lookups in ranges that may nest, touch and overlap: the narrowest range that holds a value wins."""

from __future__ import annotations

import datetime
import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import materialize, store
from .joins import attach
from .ordered import floor_lookup

_OPEN, _CARRY, _CLOSE = 0, -1, 1


def _point(value: Column | str, behind: int) -> Column:
    """A place between values: at ``value`` itself, or right behind it."""
    return F.struct((F.col(value) if isinstance(value, str) else value).alias("at"), F.lit(behind).alias("behind"))


def flatten_ranges(ranges: DataFrame, lo: str, hi: str, payload: Sequence[str]) -> DataFrame:
    """Closed ranges ``[lo, hi]`` as disjoint leaves: ``(start, lo, hi, payload...)``.

    A leaf reaches from its ``start`` (a place: ``at`` a value, or right ``behind`` it) to the next one and belongs to the narrowest
    range over it, of equally narrow ones to that with the greatest ``lo``; nulls where no range is. Of equal ranges the one with
    the smallest payload counts; ranges with a null bound or ``lo`` above ``hi`` hold nothing. Bounds are numbers, dates or
    binary keys of one length.

    The bounds are range partitioned and swept in order, each partition on its own, with a heap of the ranges that are open. Ranges
    that reach beyond their partition are handed to the later ones as open: nested ranges cost one row per level and partition.
    """
    packed = F.struct(*payload) if payload else F.lit(0)
    distinct = ranges.where(F.col(lo) <= F.col(hi)).groupBy(F.col(lo).alias("lo"), F.col(hi).alias("hi")).agg(F.min(packed).alias("payload"))
    named = store(distinct.withColumn("id", F.monotonically_increasing_id()))
    bounds = named.select("id", "lo", "hi", F.inline(F.array(
        F.struct(_point("lo", 0).alias("place"), F.lit(_OPEN).alias("what")), F.struct(_point("hi", 1).alias("place"), F.lit(_CLOSE).alias("what")),
    )))
    # Stored once, as the numbers of the partitions must be the same for the bounds and for what is carried over.
    bounds = materialize(bounds.repartitionByRange("place.at", "place.behind").withColumn("part", F.spark_partition_id()))
    ends = bounds.groupBy("id", "lo", "hi").agg(F.min("part").alias("first"), F.max("part").alias("last")).where("first < last")
    carried = ends.select("id", "lo", "hi", F.lit(None).cast(bounds.schema["place"].dataType).alias("place"), F.lit(_CARRY).alias("what"), F.explode(F.sequence(F.col("first") + 1, "last")).alias("part"))
    events = bounds.select("part", "place.at", "place.behind", "what", "id", "lo", "hi").unionByName(carried.select("part", "place.at", "place.behind", "what", "id", "lo", "hi"))

    kind = ranges.schema[lo].dataType
    arrow_kind = to_arrow_type(kind)

    def number(value):
        """A bound as a number, so that widths can be compared; binary keys are big-endian."""
        if isinstance(value, bytes):
            return int.from_bytes(value, "big")
        if isinstance(value, datetime.datetime):
            return (value.replace(tzinfo=None) - datetime.datetime.min) // datetime.timedelta(microseconds=1)
        return value.toordinal() if isinstance(value, datetime.date) else value

    def rows_of(found: list) -> pa.RecordBatch:
        at, behind, ids = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(at, arrow_kind), pa.array(behind, pa.int32()), pa.array(ids, pa.int64())], ["at", "behind", "id"])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, heap, closed, shown, out = None, None, [], set(), None, []

        def leaf() -> None:
            nonlocal shown
            while heap and heap[0][2] in closed:
                closed.discard(heapq.heappop(heap)[2])
            winner = heap[0][2] if heap else None
            # A part's first leaf is told even if it goes on from the part before.
            if place is not None and winner != shown:
                out.append((*place, winner))
                shown = winner

        for batch in batches:
            for own, at, behind, what, range_id, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                if own != part:
                    leaf()
                    part, place, heap, closed, shown = own, None, [], set(), -1
                if what != _CARRY and (at, behind) != place:
                    leaf()
                    place = (at, behind)
                if what == _CLOSE:
                    closed.add(range_id)
                else:
                    heapq.heappush(heap, (number(high) - number(low), -number(low), range_id))
            if out:
                yield rows_of(out)
                out.clear()
        leaf()
        if out:
            yield rows_of(out)

    in_order = events.repartition("part").sortWithinPartitions("part", F.col("what") != _CARRY, "at", "behind", "what")
    leaves = in_order.mapInArrow(sweep, f"at {kind.simpleString()}, behind int, id long")
    fields = [F.col(f"payload.`{c}`").alias(c) for c in payload]
    joined = leaves.join(named, "id", "left")
    return joined.select(_point("at", 0).withField("behind", F.col("behind")).alias("start"), F.col("lo").alias(lo), F.col("hi").alias(hi), *fields)


def nested_range_lookup(values: DataFrame, col: str, ranges: DataFrame, lo: str, hi: str, payload: Sequence[str]) -> DataFrame:
    """For each distinct value the narrowest range ``[lo, hi]`` that holds it: ``(col, lo, hi, payload...)``, nulls for a miss.

    Values and the leaves of the ranges are merged in order, then an equality join fetches the range.
    """
    kind = ranges.schema[lo].dataType
    leaves = store(flatten_ranges(ranges, lo, hi, payload))
    keys = values.where(F.col(col).isNotNull()).select(F.col(col), _point(F.col(col).cast(kind), 0).alias("__place")).distinct()
    found = floor_lookup(keys, "__place", leaves, "start")
    located = attach(found, leaves, ["start"], spread_by=["__place"])
    return keys.join(located, "__place").select(col, lo, hi, *payload)

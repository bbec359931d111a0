"""The best range of each point, without pairs of points and ranges.

The line is cut into cells with about equally many points; a point is in one cell, a range in every cell that it
reaches. A task reads its cells in order, each cell's ranges before its points, best range first. The ranges of a
cell are the nodes of a segment tree over their ends, so a point looks at one node per level however many ranges
hold it. Memory follows the ranges of a cell: points are answered as they come.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that are answered at once, at least.
CHUNK = 100_000

C = F.col


def _places(ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Odd numbers for values that are ends, even ones for the gaps between."""
    at = np.searchsorted(ends, values)
    return 2 * at + (ends[np.minimum(at, len(ends) - 1)] == values)


def _spread_nodes(first: np.ndarray, last: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, range) of a segment tree with ``size`` leaves for ranges of leaves, ``last`` excluded."""
    left, right, ids = first + size, last + size, np.arange(len(first))
    nodes, owners = [], []
    while len(ids):
        odd = left & 1 == 1
        nodes.append(left[odd])
        owners.append(ids[odd])
        left = left + odd
        odd = right & 1 == 1
        right = right - odd
        nodes.append(right[odd])
        owners.append(ids[odd])
        left, right = left >> 1, right >> 1
        more = left < right
        left, right, ids = left[more], right[more], ids[more]
    return np.concatenate(nodes), np.concatenate(owners)


def _over_all(nodes: np.ndarray, owners: np.ndarray, size: int, leaf: np.ndarray) -> np.ndarray:
    """The least owner on the way from each leaf to the root."""
    best = np.full(2 * size, len(owners) + 1)
    np.minimum.at(best, nodes, owners)
    start = 2
    while start < 2 * size:
        level = np.arange(start, min(2 * start, 2 * size))
        best[level] = np.minimum(best[level], best[level >> 1])
        start *= 2
    return best[leaf + size]


def _over_days(nodes: np.ndarray, owners: np.ndarray, since: np.ndarray, size: int, leaf: np.ndarray, days: np.ndarray) -> np.ndarray:
    """The least owner on the way from each leaf to the root among those that hold since the leaf's day or earlier."""
    begun, none = np.unique(since), len(owners) + 1
    step = len(begun) + 1
    key = nodes * step + np.searchsorted(begun, since)[owners]
    order = np.argsort(key, kind="stable")
    key, node = key[order], nodes[order]
    # A later node's numbers are all lower, so the running minimum begins anew with each node.
    least = np.minimum.accumulate(owners[order] - node * none) + node * none
    day = np.searchsorted(begun, days, side="right")
    found, order = np.full(len(leaf), none), np.lexsort((day, leaf))
    at, day = leaf[order] + size, day[order]
    while at.any():
        before = np.searchsorted(key, at * step + day) - 1
        held = (before >= 0) & (node[before] == at)
        found = np.where(held, np.minimum(found, least[before]), found)
        at = at >> 1
    out = np.empty_like(found)
    out[order] = found
    return out


def _beginning_within(begins: np.ndarray, after: np.ndarray, until: np.ndarray, none: int) -> np.ndarray:
    """The least owner among those that begin after ``after`` and until ``until``."""
    order = np.argsort(begins, kind="stable")
    size, begins = len(order), begins[order]
    best = np.concatenate([np.full(size, none), order])
    last = size
    while last > 1:
        first = (last + 1) // 2
        level = np.arange(first, last)
        best[level] = np.minimum(best[2 * level], best[2 * level + 1])
        last = first
    left, right = np.searchsorted(begins, after, side="right") + size, np.searchsorted(begins, until, side="right") + size
    found = np.full(len(after), none)
    while (left < right).any():
        open_ = left < right
        odd = open_ & (left & 1 == 1)
        found = np.where(odd, np.minimum(found, best[np.where(odd, left, 0)]), found)
        left = left + odd
        odd = open_ & (right & 1 == 1)
        right = right - odd
        found = np.where(odd, np.minimum(found, best[np.where(odd, right, 0)]), found)
        left, right = left >> 1, right >> 1
    return found


def _numpy(column: pa.ChunkedArray, at: np.ndarray) -> np.ndarray:
    return column.take(pa.array(at)).to_numpy()


def answers(rows: pa.Table, group: list[str], half_open: bool, intervals: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the points that have a range, and of the best range of each.

    ``rows`` are sorted by ``group``; ranges come before points and in their order. ``__x`` is a point or the low end,
    ``__y`` the high end or, of ``intervals``, where a point's ends, ``__since`` the first day or the point's day.
    """
    is_point = rows["__is_point"].to_numpy()
    held, asked = np.flatnonzero(~is_point), np.flatnonzero(is_point)
    if not len(held) or not len(asked):
        return asked[:0], held[:0]
    changes = np.zeros(len(rows), dtype=bool)
    for name in group:
        column = rows[name].combine_chunks()
        changes[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(rows) - 1)).to_numpy(zero_copy_only=False)
    number = np.cumsum(changes)
    low, high, point = _numpy(rows["__x"], held), _numpy(rows["__y"], held), _numpy(rows["__x"], asked)
    ends = np.unique(np.concatenate([low, high]))
    wide = 2 * len(ends) + 2
    begins = number[held] * wide + _places(ends, low)
    stops = number[held] * wide + _places(ends, high) + (0 if half_open else 1)
    place = number[asked] * wide + _places(ends, point)
    bounds = np.unique(np.concatenate([begins, stops]))
    nodes, owners = _spread_nodes(np.searchsorted(bounds, begins), np.searchsorted(bounds, stops), len(bounds))
    leaf, none = np.searchsorted(bounds, place, side="right") - 1, len(owners) + 1
    inside = leaf >= 0
    if "__since" in rows.column_names:
        since, days = _numpy(rows["__since"], held), _numpy(rows["__since"], asked)
        best = _over_days(nodes, owners, since, len(bounds), np.maximum(leaf, 0), days)
    else:
        best = _over_all(nodes, owners, len(bounds), np.maximum(leaf, 0))
    best = np.where(inside, best, none)
    if intervals:
        until = number[asked] * wide + _places(ends, _numpy(rows["__y"], asked))
        best = np.minimum(best, _beginning_within(begins, place, until, none))
    won = best < none
    return asked[won], held[best[won]]


def _cells(values: Column, cuts: list) -> Column:
    """How many of the sorted cuts a value has reached: of blocks of them, then within the last such block."""
    if not cuts:
        return F.lit(0)
    size = isqrt(len(cuts)) + 1
    blocks = [cuts[k : k + size] for k in range(0, len(cuts), size)]
    heads, all_blocks = F.array(*[F.lit(b[0]) for b in blocks]), F.array(*[F.array(*[F.lit(c) for c in b]) for b in blocks])
    begun = F.size(F.filter(heads, lambda b: b <= values))
    within = F.transform(F.array(begun), lambda n: F.when(n > 0, (n - 1) * size + F.size(F.filter(F.get(all_blocks, n - 1), lambda b: b <= values))).otherwise(0))
    return F.get(within, F.lit(0))


def best_of_each(
    points: DataFrame, ranges: DataFrame, keys: list[str], point: str, low: str, high: str, best_first: list[Column],
    take: list[str], *, point_end: str | None = None, equal: dict[str, str] | None = None, since: tuple[str, str] | None = None,
    half_open: bool = False,
) -> DataFrame:
    """``keys`` of each point with the ``take`` columns of the first range in ``best_first`` that holds the point.

    With ``point_end`` a range is held that overlaps point..point_end. ``equal`` (point column -> range column) must
    agree; ``since`` (range column, point column) is the day from which a range holds, and the day of the point.
    ``best_first`` must be a total order of ranges. Points without a range are left out.
    """
    assert not (point_end and (since or half_open)), "intervals are matched by their ends only"
    spark, equal = points.sparkSession, equal or {}
    known = lambda names: reduce(lambda a, b: a & b, [C(c).isNotNull() for c in names])
    points = points.where(known([point, *([point_end] if point_end else []), *equal, *(since[1:] if since else [])]))
    ranges = ranges.where(known([low, high, *equal.values(), *(since[:1] if since else [])])).where(C(high) > C(low) if half_open else C(high) >= C(low))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    reach = (C(point_end) - C(point)) if point_end else F.lit(0)
    values = points.select(C(point).alias("x"), reach.alias("reach")).union(ranges.select(C(low), F.lit(0)))
    found = values.agg(F.percentile_approx("x", [k / tasks for k in range(1, tasks)], 100 * tasks).alias("cuts"), F.max("reach").alias("reach")).first()
    cuts = sorted(set(found["cuts"] or []))
    extra = F.lit(found["reach"] if point_end and found["reach"] is not None else 0)

    group, chunk = [f"__e{i}" for i in range(len(equal))] + ["__cell"], CHUNK
    asked = points.select(
        *[C(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[C(c).alias(f"__e{i}") for i, c in enumerate(equal)], C(point).alias("__x"),
        *([C(point_end).alias("__y")] if point_end else []), *([C(since[1]).alias("__since")] if since else []),
        _cells(C(point), cuts).alias("__cell"), F.lit(True).alias("__is_point"),
    )
    reached = F.sequence(_cells(C(low) - extra if point_end else C(low), cuts), _cells(C(high), cuts))
    held = ranges.select(
        "*", *[C(c).alias(f"__e{i}") for i, c in enumerate(equal.values())], C(low).alias("__x"), C(high).alias("__y"),
        *([C(since[0]).alias("__since")] if since else []), F.explode(reached).alias("__cell"), F.lit(False).alias("__is_point"),
    )
    rows = held.unionByName(asked, allowMissingColumns=True).repartition(tasks, *group).sortWithinPartitions(*group, "__is_point", *best_first)
    given = [f"__k{i}" for i in range(len(keys))]
    rows = rows.select(*group, "__is_point", "__x", "__y", *(["__since"] if since else []), *given, *[C(c).alias(f"__t{i}") for i, c in enumerate(take)])
    taken = [f"__t{i}" for i in range(len(take))]

    def won(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        asked, best = answers(rows, group, half_open, point_end is not None)
        if len(asked):
            columns = [rows[c].take(pa.array(asked)) for c in given] + [rows[c].take(pa.array(best)) for c in taken]
            yield from pa.table(columns, names=[*given, *taken]).to_batches()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, more = None, []
        for batch in batches:
            more.append(batch)
            if sum(map(len, more)) >= max(chunk, 2 * len(kept) if kept is not None else 0):
                rows = pa.concat_tables([*([kept] if kept is not None else []), pa.Table.from_batches(more)])
                yield from won(rows)
                # The ranges of the last group wait for the points that may follow.
                last = rows.slice(len(rows) - 1, 1)
                same = reduce(pc.and_, [pc.equal(rows[c], last[c][0]) for c in group])
                kept, more = rows.filter(pc.and_(same, pc.invert(rows["__is_point"]))), []
        if more:
            yield from won(pa.concat_tables([*([kept] if kept is not None else []), pa.Table.from_batches(more)]))

    schema = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in [*given, *taken]])
    out = rows.mapInArrow(read, schema)
    return out.select(*[C(f"__k{i}").alias(k) for i, k in enumerate(keys)], *[C(f"__t{i}").alias(c) for i, c in enumerate(take)])

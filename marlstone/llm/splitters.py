"""Exact splitters of a keyed table by iterated histograms, and ordered buckets made with them.

A key is a pair of longs (k1, k2), compared in that order. The driver holds candidate boundaries with the
exact bytes and rows below each; every round one aggregation counts what lies between the candidates that
are still open. What reaches the driver is a row for each candidate, never rows of the table.
"""

from __future__ import annotations

import bisect
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import LONG_MIN, array_literal, fresh, save

Key = tuple[int, int]
_SPAN = 2**64
#: Boundaries looked up by one step of the search within a row.
_FAN = 48


def _as_int(key: Key) -> int:
    return (key[0] - LONG_MIN) * _SPAN + (key[1] - LONG_MIN)


def _as_key(n: int) -> Key:
    return n // _SPAN + LONG_MIN, n % _SPAN + LONG_MIN


def cell_of(k1: Column, k2: Column, boundaries: list[Key]) -> Column:
    """How many of the sorted boundaries are not above the key: found in two steps of about sqrt(n)
    comparisons, JVM-side."""
    if not boundaries:
        return F.lit(0)
    key = F.struct(k1.alias("a"), k2.alias("b"))
    step = max(_FAN, round(len(boundaries) ** 0.5))
    parts = [boundaries[i : i + step] for i in range(0, len(boundaries), step)]
    rows = lambda keys: json.dumps([{"a": a, "b": b} for a, b in keys])
    count = lambda keys: F.size(F.filter(keys, lambda x: x <= key))
    of = "array<struct<a:bigint,b:bigint>>"
    if len(parts) == 1:
        return count(F.from_json(F.lit(rows(boundaries)), of))
    heads = count(F.from_json(F.lit(rows([p[0] for p in parts])), of))
    inner = F.from_json(F.lit("[" + ",".join(rows(p) for p in parts) + "]"), f"array<{of}>")
    found = F.get(inner, heads - 1)
    return F.when(heads == 0, F.lit(0)).otherwise((heads - 1) * step + count(found))


@dataclass
class Cells:
    """Cells between boundaries: cell i holds the keys from boundaries[i - 1] to below boundaries[i]."""

    boundaries: list[Key]
    bytes_below: list[int]
    rows_below: list[int]
    total_bytes: int
    total_rows: int

    @property
    def sizes(self) -> list[int]:
        edges = [0, *self.bytes_below, self.total_bytes]
        return [b - a for a, b in zip(edges, edges[1:])]

    @property
    def counts(self) -> list[int]:
        edges = [0, *self.rows_below, self.total_rows]
        return [b - a for a, b in zip(edges, edges[1:])]


#: Boundaries counted in one round, but for one for each open target.
_MOST_PROBES = 8192


def find_splitters(keyed: DataFrame, targets: list[tuple[float, float]], probes: int = 31) -> Cells:
    """Boundaries at which the bytes below meet the targets.

    keyed: columns k1, k2, size (longs, not null). targets: (share of all bytes, tolerated error as a share
    of all bytes), ascending. A target is met by the first boundary within its tolerance; if a single key
    holds so many bytes that none is, by the nearest. Edges of k1 are probed before k2 divides a k1. Every round
    narrows what holds an open target, down to two neighbouring keys, so the rounds end by themselves.
    """
    top = keyed.agg(
        F.coalesce(F.sum("size"), F.lit(0)), F.count("*"), F.min(F.struct("k1", "k2")), F.max(F.struct("k1", "k2"))
    ).first()
    total, rows = int(top[0]), int(top[1])
    if not rows or not targets:
        return Cells([], [], [], total, rows)
    low, high = _as_int(tuple(top[2])), _as_int(tuple(top[3])) + 1
    at, below = [low, high], {low: (0, 0), high: (total, rows)}
    goals = [(share * total, max(0.0, slack * total)) for share, slack in targets]
    chosen: dict[int, int] = {}
    while True:
        asked: set[int] = set()
        each = max(1, min(probes, _MOST_PROBES // max(1, len(goals) - len(chosen))))
        for j, (goal, slack) in enumerate(goals):
            if j in chosen:
                continue
            i = bisect.bisect_left(at, goal, key=lambda x: below[x][0])
            near = [x for x in at[max(0, i - 1) : i + 1]]
            best = min(near, key=lambda x: abs(below[x][0] - goal))
            lo, hi = at[max(0, i - 1)], at[min(i, len(at) - 1)]
            if abs(below[best][0] - goal) <= slack or hi - lo <= 1:
                chosen[j] = best
                continue
            found = {lo + (hi - lo) * p // (each + 1) for p in range(1, each + 1)}
            share = (goal - below[lo][0]) / max(1, below[hi][0] - below[lo][0])
            found.add(lo + int((hi - lo) * share))
            if hi - lo > 2 * _SPAN:  # between k1 values
                found = {x // _SPAN * _SPAN for x in found}
            elif lo // _SPAN != hi // _SPAN:
                found.add(hi // _SPAN * _SPAN)
            asked |= {x for x in found if lo < x < hi} or {(lo + hi) // 2}
        if not asked:
            break
        probe = sorted(asked)
        cell = cell_of(F.col("k1"), F.col("k2"), [_as_key(x) for x in probe])
        got = {r[0]: (int(r[1]), int(r[2])) for r in keyed.groupBy(cell.alias("cell")).agg(F.sum("size"), F.count("*")).collect()}
        mass, n = 0, 0
        for i, x in enumerate(probe):
            mass, n = mass + got.get(i, (0, 0))[0], n + got.get(i, (0, 0))[1]
            below[x] = (mass, n)
        at = sorted(below)
    keep = sorted({x for x in chosen.values() if low < x < high})
    return Cells([_as_key(x) for x in keep], [below[x][0] for x in keep], [below[x][1] for x in keep], total, rows)


@dataclass
class Ordered:
    """rows: the input's columns with k1, k2 and bucket; buckets ascend with the key."""

    rows: DataFrame
    keys: DataFrame
    n: int
    names: tuple[str, str, str]


def ordered_buckets(df: DataFrame, id_col: str, text_col: str, n: int) -> Ordered:
    """Deal rows to n buckets of near equal bytes that ascend with the id (null first), without a sort.

    Equal ids are ordered by the text's hash. The keys alone are saved; texts are read again by the step
    that needs them."""
    k1, k2, bucket = fresh(df, "mt_k1", "mt_k2", "mt_bucket")
    keyed = df.withColumns({
        k1: F.coalesce(F.col(id_col).cast("long"), F.lit(LONG_MIN)),
        k2: F.xxhash64(F.col(text_col)),
    })
    narrow = save(
        keyed.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), (F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 16).alias("size")),
        "keys",
    )
    cells = find_splitters(narrow, [(j / n, 0.2 / n) for j in range(1, n)])
    of = cell_of(F.col("k1"), F.col("k2"), cells.boundaries)
    out = keyed.withColumn(bucket, cell_of(F.col(k1), F.col(k2), cells.boundaries).cast("int"))
    return Ordered(out, narrow.withColumn("bucket", of.cast("int")), len(cells.boundaries) + 1, (k1, k2, bucket))


__all__ = ["Cells", "Ordered", "array_literal", "cell_of", "find_splitters", "ordered_buckets"]

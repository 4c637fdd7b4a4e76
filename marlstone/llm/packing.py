"""Packing into sequences of several permitted lengths by best fit.

Lengths are whole numbers up to the largest permitted sequence, so a histogram of them, a bounded table, says all
that packing needs. The plan is made from it: lengths in descending order, each into the open bins with the
least room that holds it; where none does, bins of the size with the least cost per token are opened, given what
is left to fill them. Plans that never open less than a given size are made besides, and the cheapest of all is
taken once every bin is cut down to the least permitted length that holds its contents. A plan names ranges of
(length, rank) for ranges of bins, so one join places every piece, however many there are.

Ranks within a length are counted in slices of the hash of the id, so that a length that a third of all rows
share goes to as many tasks as it needs.

Defined results: a text longer than the largest sequence is cut into full pieces and a rest; one without words
(null, empty, blank) has one row of length 0 and no bin; repeated rows are packed each for itself; an empty table
gives no rows. Only the id and the text are read.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import array_literal, save
from .mixing import word_count

LENGTHS = (512, 1024, 2048, 4096, 8192)
#: Rows of a length that one task ranks: so many, or fewer as long as there are at most SLICES more slices than
#: lengths.
SLICE_ROWS, LEAST_SLICE_ROWS, SLICES = 200_000, 1_000, 1024


def sequence_cost(length: int) -> float:
    """A sequence's cost: its tokens, a share for attention that grows with the square, and a fixed part."""
    return length + length * length / 32768 + 16


@dataclass
class Placement:
    """Items first to first + n of a length: per_bin to each bin from bin on, from offset on in the first."""

    length: int
    first: int
    n: int
    bin: int
    per_bin: int
    offset: int
    capacity: int = 0
    used: int = 0


@dataclass
class Plan:
    placements: list[Placement]
    bins: int
    cost: float


def _pack(histogram: dict[int, int], sizes: list[int], cost: Callable[[int], float], least: int) -> Plan:
    rooms: list[int] = []  # of open bins, ascending
    open_: dict[int, list[tuple[int, int, int]]] = {}  # room: [(first bin, bins, capacity)]
    placements: list[Placement] = []
    bins = 0
    left = sum(length * n for length, n in histogram.items())

    def put(room: int, item: tuple[int, int, int]) -> None:
        if room not in open_:
            bisect.insort(rooms, room)
            open_[room] = []
        open_[room].append(item)

    for length in sorted(histogram, reverse=True):
        count, rank = histogram[length], 0
        left -= length * count
        while count:
            i = bisect.bisect_left(rooms, length)
            if i == len(rooms):
                fit = [s for s in sizes if s >= length and s >= least] or [sizes[-1]]
                # What may still fill the bin: items of this length and all shorter ones.
                size = min(fit, key=lambda s: (cost(s) / min(s, s // length * length + left), s))
                n = -(-count // (size // length))
                put(size, (bins, n, size))
                bins += n
                continue
            room = rooms[i]
            first, n, capacity = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[i]
            each = room // length
            full = min(n, count // each)
            if full:
                placements.append(Placement(length, rank, full * each, first, each, capacity - room))
                put(room - each * length, (first, full, capacity))
                rank, count = rank + full * each, count - full * each
            if full < n and count:  # the last bin takes what is left
                placements.append(Placement(length, rank, count, first + full, count, capacity - room))
                put(room - count * length, (first + full, 1, capacity))
                full, rank, count = full + 1, rank + count, 0
            if full < n:
                put(room, (first + full, n - full, capacity))
    # Cut every bin down to its contents, and placements at the edges of bins that ended alike.
    final = sorted((first, n, capacity - room) for room, items in open_.items() for first, n, capacity in items)
    total, fitted = 0.0, []
    for first, n, used in final:
        size = sizes[bisect.bisect_left(sizes, used)]
        total += n * cost(size)
        fitted.append((first, n, size, used))
    starts = [f[0] for f in fitted]
    out = []
    for p in placements:
        at, end = p.bin, p.bin + -(-p.n // p.per_bin)
        while at < end:
            first, n, size, used = fitted[bisect.bisect_right(starts, at) - 1]
            stop = min(end, first + n)
            skipped = (at - p.bin) * p.per_bin
            out.append(Placement(p.length, p.first + skipped, min(p.n - skipped, (stop - at) * p.per_bin), at, p.per_bin, p.offset, size, used))
            at = stop
    return Plan(out, bins, total)


def plan_bins(histogram: dict[int, int], sizes: tuple[int, ...] = LENGTHS, cost: Callable[[int], float] = sequence_cost) -> Plan:
    """The cheapest plan for so many items of each length, which the largest size must hold."""
    order = sorted(sizes)
    return min((_pack(histogram, order, cost, least) for least in order), key=lambda p: p.cost)


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sizes: tuple[int, ...] = LENGTHS, cost: Callable[[int], float] = sequence_cost) -> DataFrame:
    """One row per piece: doc_id, piece, first_word, length, bin, capacity, used (words in the bin), start
    (the piece's place in it)."""
    most = max(sizes)
    words = save(
        df.select(F.col(id_col).alias("doc_id"), word_count(F.col(text_col)).alias("words"), F.xxhash64(id_col, text_col).alias("hash")),
        "pack-words",
    )
    pieces = words.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.ceil(F.col("words") / most) - 1).cast("long"))))
    pieces = pieces.withColumns({
        "first_word": F.col("piece") * most,
        "length": F.least(F.lit(most).cast("long"), F.col("words") - F.col("piece") * most),
    })
    filled = pieces.where("length > 0")
    counts = {int(r[0]): int(r[1]) for r in filled.groupBy("length").count().collect()}  # most rows, at most
    plan = plan_bins(counts, sizes, cost)
    rows = min(SLICE_ROWS, max(LEAST_SLICE_ROWS, sum(counts.values()) // SLICES))
    slices = [max(1, -(-counts.get(n, 0) // rows)) for n in range(most + 1)]
    sliced = filled.withColumn("slice", F.pmod(F.col("hash") + F.col("piece"), F.element_at(array_literal(slices, "bigint"), (F.col("length") + 1).cast("int"))))
    before = sliced.groupBy("length", "slice").count()
    earlier = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("length", "slice", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("length", "slice").orderBy("hash", "doc_id", "piece"))
    # One row per length, and per SLICE_ROWS rows of frequent ones.
    ranked = sliced.withColumn("place", place).join(F.broadcast(before), ["length", "slice"]).withColumn("rank", F.col("place") - 1 + F.col("before"))
    spark = df.sparkSession
    table = spark.createDataFrame(
        [(p.length, p.first, p.first + p.n, p.bin, p.per_bin, p.offset, p.capacity, p.used) for p in plan.placements],
        "length long, lo long, hi long, bin0 long, per_bin long, offset long, capacity int, used int",
    )
    # The plan's size depends on the permitted lengths, not on the number of documents.
    r, p = ranked.alias("r"), F.broadcast(table).alias("p")
    at = F.col("rank") - F.col("lo")
    placed = r.join(p, (F.col("r.length") == F.col("p.length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))).select(
        "doc_id", "piece", "first_word", F.col("r.length").alias("length"),
        (F.col("bin0") + F.floor(at / F.col("per_bin"))).alias("bin"), "capacity", "used",
        (F.col("offset") + at % F.col("per_bin") * F.col("r.length")).alias("start"),
    )
    null = lambda kind: F.lit(None).cast(kind)
    empty = pieces.where("length = 0").select("doc_id", "piece", "first_word", "length", null("long").alias("bin"), null("int").alias("capacity"), null("int").alias("used"), null("long").alias("start"))
    return placed.unionByName(empty)

"""Sharding by histogram sort.

Rows are ordered by (hash of the text, hash of the id) and cut at 15 splitters. Splitters are found by
counting the exact bytes below candidate boundaries, round by round, until every shard's edge is within the
tolerance; then the rows move once. Between the splitters lie finer cells of bounded bytes, so that no task
sorts a whole shard, and a row's slot is its rank in its cell plus the rows of the shard's cells before it.

Defined results: a null text has no bytes (size 1) and orders as such; empty texts have size 1; rows with
equal text lie together unless their group exceeds the tolerance, in which case the id divides it; rows equal
in text and id are not told apart and stay in one cell; an empty table gives no rows; columns named like the
results are replaced by them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import array_literal, fresh, save
from .splitters import cell_of, find_splitters


def histogram_sort_shards(
    df: DataFrame,
    n_shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = 0.002,
    cell_bytes: int = 16 << 20,
    max_cells: int = 1024,
) -> DataFrame:
    """df with size, shard and slot. tolerance: of a shard's ideal bytes, at each of its edges.
    max_cells: cells in a shard at most; they grow beyond cell_bytes instead."""
    k1, k2, cell = fresh(df, "mt_k1", "mt_k2", "mt_cell")
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1
    keyed = df.withColumns({k1: F.xxhash64(text_col), k2: F.xxhash64(id_col), "size": size})
    narrow = save(keyed.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), "size"), "shard-keys")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    inner = min(max_cells, max(1, math.ceil(total / n_shards / cell_bytes)))
    n = n_shards * inner
    cells = find_splitters(
        narrow, [(j / n, tolerance / n_shards if j % inner == 0 else 0.25 / n) for j in range(1, n)]
    )
    # A cell belongs to the shard in which its middle byte falls; edges of shards are edges of cells.
    edges = [0, *cells.bytes_below, cells.total_bytes]
    shard_of = [min(n_shards - 1, int((a + b) / 2 * n_shards / max(1, cells.total_bytes))) for a, b in zip(edges, edges[1:])]
    before, seen = [], {}
    for s, rows in zip(shard_of, cells.counts):
        before.append(seen.get(s, 0))
        seen[s] = seen.get(s, 0) + rows
    # Each cell is a partition of its own, so that none meets another by its hash.
    placed = keyed.withColumn(cell, cell_of(F.col(k1), F.col(k2), cells.boundaries).cast("int")).repartitionById(len(shard_of), F.col(cell))
    rank = F.row_number().over(Window.partitionBy(cell).orderBy(k1, F.col(id_col), k2))
    return placed.withColumns({
        "shard": F.element_at(array_literal(shard_of, "int"), F.col(cell) + 1),
        "slot": F.element_at(array_literal(before, "bigint"), F.col(cell) + 1) + rank.cast("long") - 1,
    }).drop(k1, k2, cell)

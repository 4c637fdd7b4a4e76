"""Approximate nearest neighbours with balanced posting lists.

Vectors are clustered into lists of near equal length: a bounded sample is halved again and again at the median
along the line between two means, and the means of the leaves are the centroids. A vector goes to the list of its
nearest centroid and, at a boundary, to another nearly as near: the one for which what the first centroid leaves of
the vector counts twice, so that a query that misses one list for that rest finds the other. Centroids are found by
best-first search of a neighbour graph that every executor holds in memory.

A query reads the lists whose centroids are at most so many times as far as its NEAREST nearest ones on average.
This ratio is not fixed but measured: the exact neighbours of PROBES vectors are found in one pass over the table, and
the least ratio that reaches the target recall on them is taken. A query reads more only where these lists hold too
few vectors.

Nearness is the inner product: vectors get one more coordinate that makes all norms the largest one, so that the
nearest in distance is the largest in product. Found neighbours are scored on the original vectors, in double
precision.

Lists and their queries meet in cells of bounded size: neighbouring lists make up a group of some CELL vectors, to
which a query goes once, with the lists that it reads there. A group of more than CELL vectors is divided, as are the
queries of a group with more than CELL of them, and each part meets each part of the other. Within a cell a query is
compared with its lists alone. A cell gives at most k pairs a query. Of equal vectors only the k + 1 least ids are candidates, as no query can return more: a vector that a
third of all rows share costs no more than others.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part; vectors of
different lengths are not candidates of each other, and those of lengths of RARE rows or less, but for the most
frequent length, are compared without an index; rows that share an id are one candidate with its best score, however many they are, and as queries
one query with the best of its rows; equal rows are one; a query never finds its own id; a product that overflows to
no number counts as the least; with fewer candidates than k all are found; an empty table gives no rows. Only the id
and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from ._shared import save, shuffle_partitions

#: Vectors of a list, of the sample that the centroids are fitted on, and lists, at most.
LIST_ROWS, SAMPLE_ROWS, MOST_LISTS = 8, 65_536, 16_384
#: How much farther than the nearest centroid another one may be for a vector to get a copy in its list.
BOUNDARY = 1.3
#: Vectors whose exact neighbours are found to set what queries read, and the share of these that must be reached.
PROBES, TARGET = 512, 0.93
#: Centroids whose mean distance other centroids' distances are compared with.
NEAREST = 32
#: Vectors and queries that one cell compares, less if they take more than CELL_BYTES; lengths of so few rows are rare.
CELL, CELL_BYTES, RARE = 16_384, 8 << 20, 4096
_DEGREE, _OPEN = 24, 8


@dataclass
class Index:
    centroids: np.ndarray  # float32, with the added coordinate
    neighbours: np.ndarray  # of each centroid, its own number where it has fewer
    scale: float  # the largest absolute component
    norm: float  # the largest, of vectors divided by the scale
    sizes: np.ndarray | None = None  # candidates of each list, once all are placed
    ratio: float = 1.0  # of the distance of lists that a query reads to that of its nearest ones
    beam: int = 64  # centroids that are looked at for that


def balanced_centroids(x: np.ndarray, size: int) -> np.ndarray:
    """Means of leaves of at most size rows, halved at the median along the line between two means."""
    leaves, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            leaves.append(x[rows].mean(axis=0))
            continue
        part = x[rows]
        a = part[((part - part.mean(axis=0)) ** 2).sum(axis=1).argmax()]
        b = part[((part - a) ** 2).sum(axis=1).argmax()]
        for _ in range(6):
            along = part @ (b - a)
            far = along > np.median(along)
            if far.all() or not far.any():
                break
            a, b = part[~far].mean(axis=0), part[far].mean(axis=0)
        order = np.argsort(part @ (b - a), kind="stable")
        half = len(rows) // 2
        todo += [rows[order[:half]], rows[order[half:]]]
    c = np.stack(leaves)
    for _ in range(4 if len(c) > 1 else 0):
        own = np.concatenate([_nearest(x[i : i + 512], c) for i in range(0, len(x), 512)])
        n = np.bincount(own, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        # Means move only half way where a list is much longer than its share, so that lists stay balanced.
        c = np.where((n > 0)[:, None], np.where((n > 2 * size)[:, None], 0.5, 1.0) * (sums / np.maximum(n, 1)[:, None] - c) + c, c)
    return c.astype(np.float32)


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(axis=1) - 2 * (x @ c.T)).argmin(axis=1)


def neighbour_graph(c: np.ndarray, degree: int = _DEGREE) -> np.ndarray:
    """Near neighbours of each centroid, without those that lie nearer to one already taken, filled up with the
    nearest left out; and one link to the next number, so that all can be reached."""
    n = len(c)
    out = np.tile(np.arange(n)[:, None], (1, degree + 1))
    norms = (c * c).sum(axis=1)
    for i in range(n):
        d = norms - 2 * (c @ c[i])
        near = np.argpartition(d, min(n - 1, 3 * degree))[: 3 * degree + 1]
        near = near[np.argsort(d[near], kind="stable")]
        near = near[near != i]
        apart = norms[near][:, None] + norms[near] - 2 * (c[near] @ c[near].T)
        own = d[near] + norms[i]
        taken: list[int] = []
        least = np.full(len(near), np.inf)  # distance to those taken
        for k in range(len(near)):
            if len(taken) < degree and least[k] > own[k]:
                taken.append(k)
                least = np.minimum(least, apart[k])
        chosen = set(taken)
        rest = [k for k in range(len(near)) if k not in chosen][: degree - len(taken)]
        links = near[taken + rest]
        out[i, : len(links)] = links
        out[i, degree] = (i + 1) % n
    return out


def search_graph(index: Index, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each query, up to beam centroids (numbers, squared distances; infinite where there are fewer), nearest
    first. All queries walk the graph at once, each opening its nearest unopened centroids in a step."""
    c, m, n = index.centroids, len(q), len(index.centroids)
    norms = (c * c).sum(axis=1)
    beam = min(beam, n)
    seen = np.zeros((m, n), dtype=bool)
    starts = np.unique(np.linspace(0, n - 1, min(n, 16)).astype(int))
    width = max(beam, len(starts))
    ids = np.zeros((m, width), dtype=np.int64)
    dist = np.full((m, width), np.inf, dtype=np.float32)
    opened = np.ones((m, width), dtype=bool)
    ids[:, : len(starts)] = starts
    dist[:, : len(starts)] = norms[starts] - 2 * (q @ c[starts].T)
    opened[:, : len(starts)] = False
    seen[:, starts] = True
    live, steps = np.arange(m), min(_OPEN, width)
    while True:
        ahead = np.where(opened[live], np.inf, dist[live])
        pick = np.argpartition(ahead, steps - 1, axis=1)[:, :steps]
        good = np.isfinite(np.take_along_axis(ahead, pick, axis=1))
        more = good.any(axis=1)
        live, pick, good = live[more], pick[more], good[more]
        if not len(live):
            break
        now = opened[live]
        np.put_along_axis(now, pick, True, axis=1)
        links = index.neighbours[np.take_along_axis(ids[live], pick, axis=1)].reshape(len(live), -1)
        fresh = np.repeat(good, index.neighbours.shape[1], axis=1) & ~seen[live[:, None], links]
        # A link that occurs twice in a step counts once.
        order = np.argsort(np.where(fresh, links, -1), axis=1, kind="stable")
        ordered = np.take_along_axis(links, order, axis=1)
        again = np.zeros_like(fresh)
        np.put_along_axis(again, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], axis=1)
        fresh &= ~again
        row, col = np.nonzero(fresh)
        at = links[row, col]
        seen[live[row], at] = True
        d = np.full(links.shape, np.inf, dtype=np.float32)
        d[row, col] = norms[at] - 2 * np.einsum("ij,ij->i", q[live[row]], c[at])
        all_d, all_i = np.concatenate([dist[live], d], axis=1), np.concatenate([ids[live], links], axis=1)
        all_o = np.concatenate([now, ~fresh], axis=1)
        keep = np.argpartition(all_d, width - 1, axis=1)[:, :width]
        dist[live], ids[live], opened[live] = (np.take_along_axis(v, keep, axis=1) for v in (all_d, all_i, all_o))
    order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
    dist, ids = np.take_along_axis(dist, order, axis=1), np.take_along_axis(ids, order, axis=1)
    return ids, np.maximum(dist + (q * q).sum(axis=1)[:, None], 0)


def _extended(index: Index, x: np.ndarray, query: bool) -> np.ndarray:
    """Scaled, with the added coordinate; queries brought to the largest norm, which changes no order."""
    x = x / index.scale
    length = np.linalg.norm(x, axis=1)
    if query:
        tiny = np.maximum(np.abs(x).max(axis=1), np.finfo(float).tiny)[:, None]
        x = x / tiny
        x = x * (index.norm / np.linalg.norm(x, axis=1))[:, None]
        return np.concatenate([x, np.zeros((len(x), 1))], axis=1).astype(np.float32)
    return np.concatenate([x, np.sqrt(np.maximum(0, index.norm**2 - length * length))[:, None]], axis=1).astype(np.float32)


def lists_of(index: Index, x: np.ndarray) -> list[np.ndarray]:
    """The lists of each vector: the nearest centroid's and, at a boundary, another's."""
    ids, dist = search_graph(index, x, 24)
    c = index.centroids
    rest = x - c[ids[:, 0]]
    length = np.sqrt((rest * rest).sum(axis=1))
    along = rest / np.where(length > 0, length, 1)[:, None]
    # What the other centroid leaves of the vector, and once more what of that lies along the first rest.
    shared = (x * along).sum(axis=1)[:, None] - np.einsum("ij,ikj->ik", along, c[ids])
    cost = np.where((dist <= dist[:, :1] * BOUNDARY**2) & (length > 0)[:, None], dist + shared * shared, np.inf)
    cost[:, 0] = np.inf
    best = cost.argmin(axis=1)
    return [row[[0, b]] if np.isfinite(k[b]) else row[:1] for row, b, k in zip(ids, best, cost)]


def _reference(far: np.ndarray) -> np.ndarray:
    """The mean of the least distances of each row, which come first; infinite ones are not there."""
    near = far[:, :NEAREST]
    there = np.isfinite(near)
    return (np.where(there, near, 0).sum(axis=1) / np.maximum(1, there.sum(axis=1)))[:, None]


def lists_for(index: Index, q: np.ndarray, k: int) -> list[np.ndarray]:
    """The lists each query reads, nearest first: those that the index says and on until they hold several times k
    candidates, for which the beam doubles."""
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(q)
    todo, beam, need = np.arange(len(q)), index.beam, 8 * k
    while len(todo):
        ids, dist = search_graph(index, q[todo], beam)
        sizes = np.where(np.isfinite(dist), index.sizes[ids], 0)
        far = np.sqrt(dist)
        wanted = (far <= index.ratio * _reference(far)) | (np.cumsum(sizes, axis=1) - sizes < need)
        more = (sizes.sum(axis=1) < need) & (ids.shape[1] < len(index.centroids))
        for i in np.flatnonzero(~more):
            out[todo[i]] = ids[i][wanted[i] & np.isfinite(dist[i])]
        todo, beam = todo[more], beam * 2
    return out


def fit(vectors: DataFrame, dims: int, rows: int, scale: float, norm: float) -> Index:
    """The index of a table of id, vec (doubles) from a sample of SAMPLE_ROWS rows at most, those whose ids hash
    lowest."""
    sample = vectors.select("id", "vec").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS) if rows > SAMPLE_ROWS else vectors
    got = sample.select("vec").toArrow()["vec"].combine_chunks()
    lists = min(MOST_LISTS, max(1, -(-rows // LIST_ROWS)))
    index = Index(np.zeros((0, dims + 1)), np.zeros((0, 0)), scale, norm)
    x = _extended(index, np.asarray(got.values).reshape(-1, dims), False)
    index.centroids = balanced_centroids(x, max(1, -(-len(x) // lists)))
    index.neighbours = neighbour_graph(index.centroids)
    return index


def calibrate(index: Index, vectors: DataFrame, placed: DataFrame, k: int, target: float) -> None:
    """Set the ratio of distances, and how many centroids are looked at, from the exact neighbours of PROBES
    vectors."""
    share = vectors.sparkSession.sparkContext.broadcast
    order = F.xxhash64("id", F.lit(2))
    probes = vectors.select("id", "vec").orderBy(order, "id", "vec").limit(PROBES).toArrow()
    x, ids = _matrix(probes["vec"].combine_chunks()), np.asarray(probes["id"])
    found = vectors.select("id", "vec").mapInArrow(_nearest_to(share((ids, x)), k), "probe int, id long, vec array<double>, score double")
    best = found.withColumn("r", F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("score"), "id"))).where(F.col("r") <= k)
    # At most k rows a probe; a neighbour is reached by the first of its lists.
    got = placed.select("id", "vec", "list").join(F.broadcast(best.select("probe", "id", "vec")), ["id", "vec"]).select("probe", "id", "list").toArrow()
    if not len(got):
        return
    q, c = _extended(index, x, True), index.centroids
    d = np.sqrt(np.maximum(0, (q * q).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * (q @ c.T)))
    far = d / np.maximum(_reference(np.sort(d, axis=1)), np.finfo(np.float32).tiny)
    p, v, at = (np.asarray(got[name].combine_chunks()) for name in ("probe", "id", "list"))
    one = np.unique(np.stack([p.astype(np.int64), v], axis=1), axis=0, return_inverse=True)[1].ravel()
    ratio = np.full(one.max() + 1, np.inf)
    np.minimum.at(ratio, one, far[p, at])
    index.ratio = float(np.quantile(ratio, target, method="higher")) * (1 + 1e-6)
    # Few queries have more lists within the ratio than are looked at.
    index.beam = max(NEAREST, int(np.quantile((far <= index.ratio).sum(axis=1), 0.98, method="higher")))


def _nearest_to(shared, k: int):
    """The k nearest to each probe of what a task holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def least() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            v, x, s = (np.concatenate(c) for c in zip(*held))
            top = np.argpartition(-s, min(k, len(v)) - 1, axis=0)[: min(k, len(v))]
            keep = np.unique(top)
            return v[keep], x[keep], s[keep]

        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                v, x = np.asarray(part["id"]), _matrix(part["vec"])
                s = np.nan_to_num(x @ q.T, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
                s[v[:, None] == ids[None, :]] = -np.inf
                held.append((v, x, s))
                held = [least()]
        if held:
            v, x, s = held[0]
            m = min(k, len(v))
            top = np.argpartition(-s, m - 1, axis=0)[:m]
            for j in range(len(ids)):
                rows = top[:, j][np.isfinite(s[top[:, j], j])]
                yield pa.record_batch([pa.array(np.full(len(rows), j, dtype=np.int32)), pa.array(v[rows]), pa.array(list(x[rows]), pa.list_(pa.float64())), pa.array(s[rows, j])], names=["probe", "id", "vec", "score"])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1)


def _grouped(lists: list[np.ndarray], per: int) -> tuple[list[int], list[int], list[np.ndarray]]:
    """Of each row's lists the groups of so many: (row, group, the lists in it)."""
    rows, groups, parts = [], [], []
    for i, mine in enumerate(lists):
        mine = np.sort(mine)
        for part in np.split(mine, np.flatnonzero(np.diff(mine // per)) + 1):
            rows.append(i)
            groups.append(int(part[0] // per))
            parts.append(part)
    return rows, groups, parts


def _assign(shared, per: int = 1, k: int | None = None):
    """The lists of vectors, or those that queries read for k neighbours, by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                x = _extended(index, _matrix(part["vec"]), k is not None)
                rows, groups, lists = _grouped(lists_of(index, x) if k is None else lists_for(index, x, k), per)
                rows = pa.array(rows, pa.int64())
                yield pa.record_batch([part["id"].take(rows), part["vec"].take(rows), pa.array(groups, pa.int64()), pa.array(lists, pa.list_(pa.int64()))], names=["id", "vec", "cell", "lists"])

    return run


def _compare(k: int):
    kinds = [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None

        def close() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            is_query = np.asarray(rows["query"])
            ids = np.asarray(rows["id"])
            x = _matrix(rows["vec"].combine_chunks())
            q, v, qi, vi = x[is_query], x[~is_query], ids[is_query], ids[~is_query]
            if not len(q) or not len(v):
                return
            lists = rows["lists"].combine_chunks()
            read, mine = lists.filter(pa.array(is_query)), np.asarray(lists.filter(pa.array(~is_query)).flatten())
            order = np.argsort(vi, kind="stable")
            v, vi, mine = v[order], vi[order], mine[order]
            by_list = np.argsort(mine, kind="stable")
            there, starts = np.unique(mine[by_list], return_index=True)
            columns = dict(zip(there.tolist(), np.split(by_list, starts[1:])))
            firsts = np.flatnonzero(np.r_[True, vi[1:] != vi[:-1]])
            counts = np.diff(np.r_[firsts, len(vi)])
            for at in range(0, len(q), 128):
                some = q[at : at + 128]
                every, met = np.full((len(some), len(v)), -np.inf), np.zeros((len(some), len(v)), dtype=bool)
                asked = read.slice(at, 128)
                wants = np.repeat(np.arange(len(some)), np.asarray(asked.value_lengths()))
                which_list = np.asarray(asked.flatten())
                by = np.argsort(which_list, kind="stable")
                wanted, starts = np.unique(which_list[by], return_index=True)
                for name, who in zip(wanted.tolist(), np.split(wants[by], starts[1:])):
                    if name in columns:
                        at_both = np.ix_(who, columns[name])
                        every[at_both] = np.nan_to_num(some[who] @ v[columns[name]].T, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
                        met[at_both] = True
                # The best of each id, so that rows that share one take one of the k places.
                s, met = (every, met) if len(firsts) == len(v) else (np.maximum.reduceat(every, firsts, axis=1), np.logical_or.reduceat(met, firsts, axis=1))
                own = (qi[at : at + 128][:, None] == vi[firsts][None, :]) | ~met
                s = np.where(own, -np.inf, s)
                m = min(len(firsts), k)
                worst = -np.partition(-s, m - 1, axis=1)[:, m - 1]
                # Those of the k-th score but for rounding are scored again, and the least ids among equals go on.
                slack = np.where(np.isfinite(worst), np.abs(worst), 0) * 1e-12
                who, found = np.nonzero((s >= (worst - slack)[:, None]) & ~own)
                which = firsts[found]
                for g in np.unique(found[counts[found] > 1]):
                    mine = np.flatnonzero(found == g)
                    which[mine] += every[who[mine], firsts[g] : firsts[g] + counts[g]].argmax(axis=1)
                exact = np.nan_to_num(np.einsum("ij,ij->i", q[at + who], v[which]), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
                order = np.lexsort((vi[which], -exact, who))
                who, which, exact = who[order], which[order], exact[order]
                place = np.arange(len(who)) - np.searchsorted(who, who)
                who, which, exact = (a[place < k] for a in (who, which, exact))
                yield pa.record_batch([pa.array(qi[at + who]), pa.array(vi[which]), pa.array(exact)], schema=pa.schema(kinds))

        for batch in batches:
            cells = np.stack([np.asarray(batch[c]) for c in ("cell", "vpart", "qpart")], axis=1)
            edges = [0, *(np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                now = tuple(cells[a])
                if held and now != key:
                    yield from close()
                    held = []
                key = now
                held.append(batch.slice(a, b - a))
        if held:
            yield from close()

    return run


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec (doubles) of the vectors that take part, of any length."""
    vec = F.col(vec_col).cast("array<double>")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    return df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where(F.col("id").isNotNull() & F.col("vec").isNotNull() & fine)


def search(df: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest of each row that is_query, a function of the id, takes.
    target: the recall that the lists are chosen for."""
    spark = df.sparkSession
    ship(spark)
    every = usable(df, id_col, vec_col).withColumn("dims", F.size("vec")).dropDuplicates(["id", "vec"])
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    rows = every.withColumn("place", place).where((F.col("place") <= k + 1) | is_query(F.col("id")))
    rows = save(rows.select("id", "vec", "dims", (F.col("place") <= k + 1).alias("candidate"), is_query(F.col("id")).alias("asks")), "vectors")
    counts = rows.where("candidate").groupBy("dims").agg(F.count("*").alias("n"))
    lengths = counts.orderBy(F.desc("n"), F.desc("dims")).limit(1).unionByName(counts.where(F.col("n") > RARE)).distinct().collect()  # fewer than rows / RARE
    rare = rows.where(~F.col("dims").isin([r["dims"] for r in lengths])) if lengths else rows
    # Rare lengths are one list each, with a number that no index uses.
    by = (-F.col("dims")).cast("long")
    by = (by.alias("cell"), F.array(by).alias("lists"))
    pairs = [(rare.where("candidate").select("id", "vec", *by), rare.where("asks").select("id", "vec", *by), min(CELL, RARE))]
    for r in lengths:
        most = min(CELL, max(RARE // 8, CELL_BYTES // (8 * r["dims"])))
        pairs.append((*_indexed(rows.where(F.col("dims") == r["dims"]), r["dims"], r["n"], k, target, most), most))
    near = reduce(DataFrame.unionByName, [_met(spark, placed, asked, k, most) for placed, asked, most in pairs])
    best = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _indexed(rows: DataFrame, dims: int, n: int, k: int, target: float, most: int) -> tuple[DataFrame, DataFrame]:
    """Candidates and queries of one length with the lists that they are in and read."""
    share = rows.sparkSession.sparkContext.broadcast
    vectors = rows.where("candidate")
    scale = float(rows.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x))))).first()[0])
    square = float(rows.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + (x / scale) * (x / scale)))).first()[0])
    index = fit(vectors, dims, n, scale, square**0.5)
    schema = "id long, vec array<double>, cell long, lists array<bigint>"
    per = max(1, most * len(index.centroids) // (2 * n))  # lists that hold about so many vectors
    split = lambda t, run: t.select("id", "vec").mapInArrow(run, schema)
    # A row for each list of a vector.
    by_list = split(vectors, _assign(share(index))).withColumn("list", F.explode("lists"))
    placed = save(by_list.select("id", "vec", "list", F.floor(F.col("list") / per).alias("cell"), F.array("list").alias("lists")), "posting-lists")
    index.sizes = np.zeros(len(index.centroids), dtype=np.int64)
    # Ids, not rows: a query reads on until its lists hold enough candidates.
    for r in placed.groupBy("list").agg(F.countDistinct("id").alias("count")).collect():  # MOST_LISTS rows at most
        index.sizes[r["list"]] = r["count"]
    calibrate(index, vectors, placed, k, target)
    return placed.drop("list"), save(split(rows.where("asks"), _assign(share(index), per, k)), "query-lists")


def _met(spark, placed: DataFrame, asked: DataFrame, k: int, most: int) -> DataFrame:
    """The best k of each cell for each of its queries."""
    # Parts of groups and of queries, from counts: a row for each group, MOST_LISTS or one for each rare length.
    parts = lambda t, name: t.groupBy("cell").agg(F.ceil(F.count("*") / most).cast("int").alias(name))
    sizes = parts(placed, "vparts").join(parts(asked, "qparts"), "cell")
    part = lambda of, salt: F.pmod(F.xxhash64("id", "vec", F.lit(salt)), F.col(of)).cast("int")
    spread = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    v = placed.join(sizes, "cell").withColumn("vpart", part("vparts", 1)).withColumn("qpart", spread("qparts"))
    q = asked.join(sizes, "cell").withColumn("qpart", part("qparts", 2)).withColumn("vpart", spread("vparts"))
    columns = ("cell", "vpart", "qpart", "id", "vec", "lists")
    cells = v.select(*columns, F.lit(False).alias("query")).unionByName(q.select(*columns, F.lit(True).alias("query")))
    cells = cells.repartition(shuffle_partitions(spark), "cell", "vpart", "qpart").sortWithinPartitions("cell", "vpart", "qpart")
    return cells.mapInArrow(_compare(k), "query_id long, vec_id long, score double")

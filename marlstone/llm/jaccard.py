"""Similarity join of documents on word shingles by chosen paths.

A document is the set of its SHINGLE-word shingles (lower case; 32-bit hashes). Documents with equal sets are one
node. In each of several runs a set chooses tokens: those whose hash, seeded by the run and the path so far, is
under 1 / (threshold * size); so two sets over the threshold are expected to choose at least one token
together. Nodes that chose the same token form a bucket, and a bucket of up to SMALL nodes is compared node by node
on min-hash sketches.

A larger bucket is dealt out to slices, each with the same PIVOTS nodes of the bucket, and its nodes are compared
with these alone: work in proportion to the bucket. A node nearly equal to a pivot is settled, because whatever is
over the threshold with it is linked to that pivot too. If every node is like some pivot, the bucket is done; if up
to SMALL are like none, these are compared with all that are not settled, and it is done too; else those that are
not settled choose again, and so are split until their buckets are small. Texts that share a passage and no more are
like no pivot and drop out of each other's buckets after a few choices. What would still be together after LAST
choices is linked until verified. Runs are repeated so often that a pair at the threshold is
found with the target recall even if its bucket is split to the third choice.

Sets are wide and most of them meet nothing, so they stay where they are written: the rows of a few nodes are found by
bitmaps of their numbers, and only sets that go on to a bucket's later choices or to a group are moved.

What the sketches link forms groups, and within a group every pair is verified on the exact sets, in blocks of
bounded size: so the links of a group's members are all found and counted, whichever run met them. Links are
never emitted as rows: a block gives each node's number of links and the edges of a spanning forest.

Where only the classes are asked for, pairs that are known to be connected need not be compared. Each block of a large
group is verified within itself and against PIVOTS nodes of the group that are in every block; then what is not in
the group's largest class so far is verified against the whole group. Classes are the same as by all pairs; the work
is in proportion to the group where it is one class, and that of all pairs only where most of it is not.

Defined results: a text without words (null, empty) is alone in its class; one of fewer than SHINGLE words is one
shingle; a text without word characters is split at white space; the class id is the least id of the class
(null if all are), class_key tells classes apart that share an id; repeated rows are copies of each other; an
empty table gives no rows. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import bounded_batches, discard, drop_shuffles, fresh, last_saved, save, scratch, shuffle_partitions
from .components import components

SHINGLE = 5
#: Nodes of a bucket that are compared one by one; of a larger one, those that all others are compared with and the
#: nodes of a slice.
SMALL, PIVOTS, SLICE = 384, 32, 512
#: Nodes of a block when sets are compared: in large groups up to MOST_BLOCK, so that a set is in some 16 blocks.
BLOCK, MOST_BLOCK, BLOCK_TOKENS = 192, 512, 1 << 20
#: Choices that the number of runs allows for, made at a time after the first, and at most.
DEPTH, STEP, LAST = 3, 2, 17
#: Minima kept of a set; the share of equal ones from which a pair is verified, five deviations under 0.8, and from
#: which a node is settled by a pivot.
SKETCH, LIKELY, SETTLED = 128, 0.62, 0.85
#: Bitmaps that are broadcast at most, of 4 KB for each 32,768 numbers. With more of them nodes are found by a join.
MOST_MAPS = 8192
#: Buckets that go on to a further choice whose numbers, 8 bytes each, are sent to all tasks at most. Of more of them, nodes
#: go on from all their paths, and what is not wanted is dropped after.
MOST_SPLIT = 65_536
_WORD = re.compile(r"\w+")
_KNOWN_WORDS = 200_000
_U = np.uint64
#: Odd multipliers for the words of a shingle, and those of a mixing step.
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _M1
        x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def runs_for(recall: float, threshold: float = 0.8, depth: int = DEPTH) -> int:
    """How many runs find a pair at the threshold with this recall even if its bucket is split to the depth.
    Both choose a token under the larger set's chance, 1 / (t size). Sets of equal size share 2 t / (1 + t) of their
    tokens; the least, t, is shared where one set is part of the other, and one shared choice is expected."""
    shared, lost = 1.0, 0.0
    for _ in range(depth):
        lost = math.exp(-shared * (1 - lost))
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost)))


class Shingler:
    def __init__(self):
        self.seen: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        """The sorted distinct shingles, u4."""
        low, seen = text.lower(), self.seen
        words = _WORD.findall(low) or low.split()
        if len(seen) > _KNOWN_WORDS:
            seen.clear()
        for w in words:
            if w not in seen:
                seen[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) + 1
        h = np.array([seen[w] for w in words], dtype=np.uint64)
        if not len(h):
            return np.zeros(0, dtype=np.uint32)
        n = max(1, len(h) - SHINGLE + 1)
        total = np.zeros(n, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(min(SHINGLE, len(h))):
                total += h[k : k + n] * _PLACES[k]
        return np.unique((_mix(total) >> _U(32)).astype(np.uint32))


def digest_of(shingles: np.ndarray) -> int:
    """A set's identity: 64 bits of its digest."""
    return int.from_bytes(hashlib.blake2b(shingles.astype("<u4").tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch_of(shingles: np.ndarray) -> np.ndarray:
    """The least hash in each of SKETCH parts of the hash space; 65535 where a part is empty."""
    h = _mix(shingles.astype(np.uint64) + _U(0x1234567))
    out = np.full(SKETCH, 65535, dtype=np.uint16)
    np.minimum.at(out, (h >> _U(57)).astype(np.int64), ((h >> _U(20)) & _U(0x7FFF)).astype(np.uint16))
    return out


def sketches_alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal minima among the parts that either set has, over the last axis."""
    some = (a != 65535) | (b != 65535)
    return ((a == b) & some).sum(axis=-1) / np.maximum(1, some.sum(axis=-1))


def first_ends(runs: int) -> np.ndarray:
    """Where the paths of the runs begin."""
    return _mix(np.arange(1, runs + 1, dtype=np.uint64) * _M1)


def choices(shingles: np.ndarray, ends: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The paths, named by a hash, by which a set goes on from the given ones, and the places of those."""
    tokens, out, at_end = shingles.astype(np.uint64), [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    limit = _U(min(2**64 - 1, int(min(1.0, 1 / (threshold * len(tokens))) * 2.0**64)))
    with np.errstate(over="ignore"):
        for at in range(0, len(ends), 16):
            part = ends[at : at + 16]
            h = tokens[None, :] * (_mix(part) | _U(1))[:, None]
            who, which = np.nonzero(h <= limit)
            out.append(_mix(h[who, which] ^ part[who]))
            at_end.append(who + at)
    return np.concatenate(out), np.concatenate(at_end)


def chosen(shingles: np.ndarray, ends: np.ndarray, threshold: float) -> np.ndarray:
    return choices(shingles, ends, threshold)[0]


_ON = "node long, b long, path long"
_SETS = "doc_id long, text_hash long, digest long, n int, tokens binary, sketch binary, paths array<bigint>"


def _sets(runs: int, threshold: float):
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("digest", pa.int64()), ("n", pa.int32()), ("tokens", pa.binary()), ("sketch", pa.binary()), ("paths", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, ends = Shingler(), first_ends(runs)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, rows = batch.slice(at, 500), []
                for doc_id, h, text in zip(*[part[c].to_pylist() for c in ("doc_id", "text_hash", "text")]):
                    s = shingler(text or "")
                    if len(s):
                        rows.append((doc_id, h, digest_of(s), len(s), s.astype("<u4").tobytes(), sketch_of(s).astype("<u2").tobytes(), chosen(s, ends, threshold).view(np.int64)))
                    else:
                        rows.append((doc_id, h, None, 0, None, None, []))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _deeper(threshold: float, wanted: np.ndarray | None = None):
    """Each path b of a node with the paths by which it goes on from there, STEP choices on; of those wanted alone, if they
    are given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, starts, on = [], [], []
            for node, tokens, paths in zip(*[batch[c].to_pylist() for c in ("node", "tokens", "paths")]):
                paths = np.array(paths, dtype=np.int64)
                start = ends = (paths if wanted is None else paths[np.isin(paths, wanted)]).view(np.uint64)
                for _ in range(STEP):
                    ends, of = choices(np.frombuffer(tokens, dtype="<u4"), ends, threshold)
                    start = start[of]
                nodes.append(np.full(len(ends), node, dtype=np.int64))
                starts.append(start.view(np.int64))
                on.append(ends.view(np.int64))
            if nodes:
                yield pa.record_batch([pa.array(np.concatenate(c), pa.int64()) for c in (nodes, starts, on)], names=["node", "b", "path"])

    return run


def _picker(ids: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """What gives the rows of a table whose node is one of ids, exactly. The table is not moved: nodes are numbered
    without gaps within each task that wrote them, so that bitmaps of the numbers are small and go to all."""
    number, bit = F.bitmap_bucket_number("node").alias("map"), F.bitmap_bit_position("node").alias("bit")
    maps = save(ids.select(number, bit).repartition("map").groupBy("map").agg(F.bitmap_construct_agg("bit").alias("bits")), "maps")
    if maps.count() > MOST_MAPS:
        return lambda wide: wide.join(ids, "node", "left_semi")
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1
    return lambda wide: wide.select("*", number, bit).join(F.broadcast(maps), "map").where(held).select(*wide.columns)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Runs of rows with equal keys; the rows come sorted by them. A group has bounded rows."""
    held: list[dict] = []
    now = None
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for row in batch.slice(at, 256).to_pylist():
                key = tuple(row[k] for k in keys)
                if key != now and held:
                    yield held
                    held = []
                now = key
                held.append(row)
    if held:
        yield held


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges (child, root) that connect what a symmetric matrix of links connects."""
    n = len(linked)
    root = np.arange(n)
    reach = linked | np.eye(n, dtype=bool)
    while True:
        least = np.where(reach, root[None, :], n).min(axis=1)
        if (least == root).all():
            break
        root = least
    return [(i, int(r)) for i, r in enumerate(root) if i != r]


#: Rows that _compare gives: an edge, a node of a path that is not settled, the same of one that is like no pivot.
_EDGE, _OPEN, _STRANGER = 0, 1, 2
#: How a bucket's nodes are compared: each with each, with its pivots, or with its strangers for the last time.
_ALL, _PIVOTS, _STRANGERS = 0, 1, 2


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a small bucket the spanning edges of nodes with like sketches; of a slice of a large one the edges to its
    pivots or strangers and, as (path, node), the nodes that no pivot settles."""
    names = ["kind", "u", "v"]
    out: list[tuple[int, int, int]] = []
    for rows in _groups(batches, ["b", "slice"]):
        rows = sorted({r["node"]: r for r in rows}.values(), key=lambda r: (not r["pivot"], r["node"]))
        nodes, b = [r["node"] for r in rows], rows[0]["b"]
        s = np.frombuffer(b"".join(r["sketch"] for r in rows), dtype="<u2").reshape(len(rows), SKETCH)
        if rows[0]["how"] == _ALL:
            if len(rows) > 1:
                alike = np.stack([sketches_alike(x, s) for x in s]) >= LIKELY
                out += [(_EDGE, nodes[i], nodes[r]) for i, r in forest(alike)]
        else:
            p = sum(r["pivot"] for r in rows)
            alike = np.stack([sketches_alike(x, s) for x in s[:p]], axis=1) if p else np.zeros((len(rows), 1))
            joined = set()
            for i, near in enumerate(alike):
                like = np.flatnonzero(near >= LIKELY)
                if i < p:
                    like = like[like < i]  # pivots among themselves
                elif rows[0]["how"] == _PIVOTS and near.max() < SETTLED:
                    out.append((_OPEN if len(like) else _STRANGER, b, nodes[i]))
                if len(like):
                    joined |= {(int(like[0]), int(k)) for k in like[1:]}
                    out.append((_EDGE, nodes[i], nodes[like[0]]))
            out += [(_EDGE, nodes[k], nodes[j]) for j, k in sorted(joined)]
        if len(out) > 5000:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], names=names)
            out = []
    if out:
        yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], names=names)


def common_tokens(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections. Tokens of a few sets are counted pair by pair, the others by products of
    slices of the incidence matrix."""
    n = len(sets)
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.lexsort((row, column))
    row, often = row[order], np.repeat(times, times)
    out = np.zeros((n, n), dtype=np.float32)
    for f in range(2, 9):
        who, (i, j) = row[often == f].reshape(-1, f), np.tril_indices(f, -1)
        for at in range(0, len(who), 100_000):
            part = who[at : at + 100_000]
            out += np.bincount((part[:, i] * n + part[:, j]).ravel(), minlength=n * n).reshape(n, n)
    out += out.T
    row, width = row[often > 8], 2048
    column = np.repeat(np.arange((times > 8).sum()), times[times > 8])
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        part = np.zeros((n, min(width, int(column[-1]) + 1 - at)), dtype=np.float32)
        part[row[lo:hi], column[lo:hi] - at] = 1
        out += part @ part.T
    out[np.arange(n), np.arange(n)] = [len(s) for s in sets]
    return out


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["node", "links", "parent", "whole"], [pa.int64()] * 3 + [pa.bool_()]
        out: list[tuple[int, int, int, bool]] = []
        for rows in _groups(batches, ["component", "a", "b"]):
            rows = list({r["node"]: r for r in rows}.values())
            sets = [np.frombuffer(r["tokens"], dtype="<u4") for r in rows]
            size, block = np.array([len(s) for s in sets]), np.array([r["block"] for r in rows])
            both = common_tokens(sets).astype(np.int64)
            # both / (x + y - both) >= t, in whole numbers where t is a short decimal
            union = size[:, None] + size[None, :] - both
            linked = both * 1000 >= union * round(threshold * 1000)
            if rows[0]["a"] != rows[0]["b"]:
                linked &= block[:, None] != block[None, :]
            np.fill_diagonal(linked, False)
            copies = np.array([r["copies"] for r in rows])
            parent = dict(forest(linked))
            for i in np.flatnonzero(linked.any(axis=1)):
                out.append((rows[i]["node"], int(copies[linked[i]].sum()), rows[parent.get(int(i), int(i))]["node"], rows[i]["blocks"] == 1))
            if len(out) > 5000:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out = []
        if out:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return run


def _candidate_edges(sets: DataFrame, nodes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Edges (u, v) between nodes that may be alike, and the sets of all nodes that can have one, so that what comes
    after the first choices moves these alone. sets: node, tokens, sketch, paths of every row; nodes: those that
    stand for their copies."""
    spark, opened = sets.sparkSession, None
    parts = shuffle_partitions(spark)
    here, active, rows = sets, None, _picker(nodes.select("node"))(sets.select("node", "paths")).select("node", F.explode("paths").alias("b"))
    edges = last = None
    for depth in count(1, STEP):
        sizes = save(rows.groupBy("b").agg(F.count("*").alias("size"), F.min("node").alias("least")).where("size > 1"), "buckets")
        met, large = rows.join(sizes, "b"), F.col("size") > SMALL
        if depth >= LAST:
            stars = met.where(large).select(F.col("node").alias("u"), F.col("least").alias("v"))
            edges, met = edges.unionByName(stars), met.where(~large)
        # The same nodes are pivots wherever they can be, so that edges of one group repeat each other.
        pivot = large & (F.pmod(F.xxhash64("node", F.lit(2)), F.lit(1 << 30)) * F.col("size") < PIVOTS << 30)
        met = met.select("b", "node", F.when(large, _PIVOTS).otherwise(_ALL).alias("how"), pivot.alias("pivot"), F.when(large, F.ceil(F.col("size") / SLICE)).otherwise(1).cast("int").alias("slices"))
        met = met if last is None else met.unionByName(last)
        own = F.array(F.pmod(F.xxhash64("node", "b", F.lit(1)), F.col("slices")).cast("int"))
        met = met.withColumn("slice", F.explode(F.when(F.col("pivot"), F.sequence(F.lit(0), F.col("slices") - 1)).otherwise(own)))
        met = met.join(here.select("node", "sketch"), "node").select("b", "slice", "node", "how", "pivot", "sketch")
        met = met.repartition(parts, "b", "slice").sortWithinPartitions("b", "slice")
        found = save(met.mapInArrow(_compare, "kind long, u long, v long"), "compared")
        now = found.where(F.col("kind") == _EDGE).select("u", "v")
        edges = now if edges is None else edges.unionByName(now)
        if active is None:
            met_any = save(found.select(F.explode(F.when(F.col("kind") == _EDGE, F.array("u", "v")).otherwise(F.array("v"))).alias("node")).distinct(), "met")
            active = sets.select("node", "tokens", "sketch", "paths")
            if 2 * met_any.count() <= nodes.count():  # else they are not worth a second copy
                active = save(_picker(met_any)(active), "active")
        drop_shuffles(spark)
        if found.where(F.col("kind") == _STRANGER).isEmpty():
            return edges, active
        # What is not settled, of buckets with strangers: by how many these are the bucket ends here or is split.
        rest = found.where(F.col("kind") != _EDGE).select(F.col("u").alias("b"), F.col("v").alias("node"), (F.col("kind") == _STRANGER).alias("pivot"))
        of = save(rest.groupBy("b").agg(F.count_if("pivot").alias("strangers"), F.ceil(F.count("*") / SLICE).cast("int").alias("slices")).where("strangers > 0"), "strangers")
        rest = save(rest.join(of, "b"), "rest")
        ends = F.col("strangers") <= SMALL
        last = rest.where(ends).select("b", "node", F.lit(_STRANGERS).alias("how"), "pivot", "slices")
        here, on = _picker(rest.select("node"))(active), rest.where(~ends).select("node", "b")
        # After the first choice a node goes on from all its paths where its set is, and those that end here are dropped;
        # later, of many possible paths, those that go on are brought to it.
        if depth == 1:
            split = [r["b"] for r in of.where(~ends).select("b").limit(MOST_SPLIT + 1).collect()]
            wanted = np.array(split, dtype=np.int64) if len(split) <= MOST_SPLIT else None
            on = here.select("node", "tokens", "paths").mapInArrow(_deeper(threshold, wanted), _ON).join(on, ["node", "b"], "left_semi")
        else:
            on = here.select("node", "tokens").join(on.groupBy("node").agg(F.collect_set("b").alias("paths")), "node").mapInArrow(_deeper(threshold), _ON)
        rows = save(on.select("node", F.col("path").alias("b")), "open")
        discard(opened)
        opened = last_saved()


def _verified(wide: DataFrame, threshold: float) -> DataFrame:
    """wide: component, a, b (blocks that are compared), node, block, blocks, copies, tokens."""
    wide = wide.select("component", "a", "b", "node", "block", "blocks", "copies", "tokens")
    wide = wide.repartition(shuffle_partitions(wide.sparkSession), "component", "a", "b").sortWithinPartitions("component", "a", "b")
    return save(wide.mapInArrow(_verify(threshold), "node long, links long, parent long, whole boolean"), "links")


def _blocks(nodes: str, tokens: str, block: Column) -> Column:
    return F.greatest(F.ceil(F.col(nodes) / block), F.ceil(F.col(tokens) / BLOCK_TOKENS)).cast("int")


def _spanning(members: DataFrame, threshold: float) -> DataFrame:
    """What _verified gives, without pairs that are connected anyhow: the classes follow from it, not the links.
    members: component, node, n, block, blocks, size, copies, tokens."""
    pivot = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 30)) * F.col("size") < PIVOTS << 30
    a = F.when(pivot, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    found = _verified(members.withColumn("a", F.explode(a)).withColumn("b", F.col("a")), threshold)
    parts = found.where("not whole").select(F.col("node").alias("u"), F.col("parent").alias("v"))
    if members.where("blocks > 1").isEmpty():
        return found
    # Of each large group the class that is largest so far, and the rest, those without a link among them.
    known = save(components(parts).withColumnRenamed("component", "class"), "known")
    large = members.where("blocks > 1").select("component", "node", "n").join(known, "node", "left")
    counts = large.groupBy("component", "class").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
    sizes = counts.groupBy("component").agg(
        F.max(F.when(F.col("class").isNotNull(), F.struct("c", "class", "n"))).alias("main"), F.sum("c").alias("c"), F.sum("n").alias("n")
    )
    of_main = lambda f: F.coalesce(F.col("main")[f], F.lit(0))
    sizes = sizes.select("component", F.col("main.class").alias("main"), of_main("c").alias("c"), of_main("n").alias("n"), (F.col("c") - of_main("c")).alias("others"), (F.col("n") - of_main("n")).alias("other_n"))
    most = F.lit(MOST_BLOCK)
    sizes = save(sizes.where("others > 0").select("component", "main", _blocks("others", "other_n", most).alias("first"), _blocks("c", "n", most).alias("second")), "rest-sizes")
    if sizes.isEmpty():
        return found
    # Blocks of the rest come first and meet all, those of the largest class meet the rest.
    place = large.join(sizes, "component").withColumn("other", ~F.col("class").eqNullSafe(F.col("main")) | F.col("class").isNull())
    own = lambda n: F.pmod(F.xxhash64("node"), F.greatest(n, F.lit(1))).cast("int")
    place = place.select("node", F.when(F.col("other"), own(F.col("first"))).otherwise(F.col("first") + own(F.col("second"))).alias("block"), F.when(F.col("other"), F.col("first") + F.col("second")).otherwise(F.col("first")).alias("meets"))
    again = members.select("component", "node", "blocks", "copies", "tokens").join(place, "node").withColumn("with", F.explode(F.sequence(F.lit(0), F.col("meets") - 1)))
    again = again.withColumns({"a": F.least("block", "with"), "b": F.greatest("block", "with")})
    return found.unionByName(_verified(again, threshold))


def similarity_classes(df: DataFrame, threshold: float = 0.8, recall: float = 0.99, id_col: str = "doc_id", text_col: str = "text", links: bool = True) -> DataFrame:
    """One row per row of df: doc_id, class_id, class_key, class_size (rows), n_links (rows linked to it,
    copies among them) and text_hash (of the text, to tell rows with equal ids apart). Without links, which take all
    pairs of a group, there is no n_links."""
    spark = df.sparkSession
    bounded_batches(spark)
    plain = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    sets = plain.mapInArrow(_sets(runs_for(recall, threshold), threshold), _SETS)
    # Rows are numbered as they are written; the least number of equal sets names their node.
    sets = save(sets.withColumn("node", F.monotonically_increasing_id()), "sets")
    nodes = sets.where("digest is not null").groupBy("digest").agg(F.min("node").alias("node"), F.min("doc_id").alias("least_id"), F.count("*").alias("copies"), F.max("n").alias("n"))
    nodes = save(nodes, "nodes")
    edges, active = _candidate_edges(sets, nodes, threshold)
    groups = save(components(edges), "groups")
    drop_shuffles(spark)
    wide = groups.join(nodes.select("node", "copies", "n"), "node")
    sizes = save(wide.groupBy("component").agg(F.count("*").alias("size"), F.sum("n").alias("tokens")), "group-sizes")
    # Blocks of bounded nodes and tokens.
    block = F.greatest(F.lit(BLOCK), F.least(F.lit(MOST_BLOCK), F.col("size") / 16))
    wide = wide.join(sizes.select("component", "size", _blocks("size", "tokens", block).alias("blocks")), "component")
    wide = wide.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    wide = _picker(groups)(active.select("node", "tokens")).join(wide, "node")
    if links:
        wide = wide.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        found = _verified(wide.withColumns({"a": F.least("block", "other"), "b": F.greatest("block", "other")}), threshold)
    else:
        found = _spanning(save(wide, "members"), threshold)
    # A group of one block has its classes at once; those of larger groups follow from the edges of all blocks.
    classes = found.where("whole").select("node", F.col("parent").alias("component"))
    parts = found.where("not whole").select(F.col("node").alias("u"), F.col("parent").alias("v"))
    if not parts.isEmpty():
        classes = classes.unionByName(components(parts))
    linked = classes.join(nodes, "node")
    totals = save(linked.groupBy("component").agg(F.min("digest").alias("class_key"), F.min("least_id").alias("class_id"), F.sum("copies").alias("class_size")), "classes")
    together = linked.join(totals, "component").select("node", "class_key", "class_id", "class_size")
    if links:
        together = together.join(found.groupBy("node").agg(F.sum("links").alias("links")), "node")
    n_links = [(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")] if links else []
    per_node = nodes.join(together, "node", "left").select(
        "digest", F.coalesce("class_key", "digest").alias("class_key"), F.when(F.col("class_key").isNull(), F.col("least_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", "copies").alias("class_size"), *n_links,
    )
    mine = sets.select("doc_id", "text_hash", "digest")
    alone = mine.where("digest is null").select(
        "doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(None).cast("long").alias("class_key"), F.lit(1).cast("long").alias("class_size"), *[F.lit(0).cast("long").alias("n_links")][: len(n_links)]
    )
    return mine.where("digest is not null").join(per_node, "digest").select(*alone.columns).unionByName(alone)


def representatives(df: DataFrame, threshold: float = 0.8, recall: float = 0.99, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df, with its columns, of which each class keeps one: that of the least id, then of the least
    hash of the text. Rows without words stay."""
    with scratch() as keep:
        rows = similarity_classes(df, threshold, recall, id_col, text_col, links=False)
        each = rows.groupBy("class_key", "doc_id", "text_hash").agg(F.count("*").alias("n"))
        least = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_hash", "n")).alias("k")
        chosen = each.where("class_key is not null").groupBy("class_key").agg(least).select("k.doc_id", "k.text_hash", "k.n")
        wordless = each.where("class_key is null").select("doc_id", "text_hash", F.lit(0).cast("long").alias("n"))
        kept = keep(chosen.unionByName(wordless), "representatives")
    i, h, n = fresh(df, "mt_id", "mt_hash", "mt_n")
    kept = kept.select(F.col("doc_id").alias(i), F.col("text_hash").alias(h), F.col("n").alias(n))
    found = df.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col(i)) & (F.xxhash64(text_col) == F.col(h)))
    if not kept.where(F.col(n) > 1).isEmpty():  # rows equal in id and text
        found = found.where(F.col(n) <= 1).unionByName(found.where(F.col(n) > 1).dropDuplicates([i, h]))
    return found.select(*df.columns)

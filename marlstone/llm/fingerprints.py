"""Document fingerprints by prefix polynomial hashes.

A text's prefix arrays hold, for two primes, the hash of every prefix: H[i] = sum of (c[j] + 1) * B**j for
j < i. The hash of any span follows from two entries, so that spans are compared without reading them, and
the longest common extension of two positions is found by binary search over its length. A fingerprint keeps
the length, the whole hash, the hashes of prefixes and of suffixes at lengths that grow by the fourth root of
two, and the hash and length of every span between two cuts. Cuts depend on the few code points before them
alone, so that the spans between two edits are the same in both texts. Two fingerprints are as alike as the parts
of the longer text that the other has too are long beside it: the shared prefix and suffix (each found by binary
search) and between them the spans that both keep, each as often as both do.

The hash of an edited text is put together from spans of the texts that it is made of; it is never rebuilt.

Defined results: a null text counts as empty; an empty text's fingerprint has no spans; texts alone in the
table are their own next; equal ids are ordered by the text's hash, descending like the ids, null ids last; an
empty table gives no rows. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import array_literal, bounded_batches, shuffle_partitions
from .splitters import ordered_buckets

#: The primes and the base of the polynomial.
PRIMES = (2147483647, 2147483629)
BASE = 1000003
_BLOCK = 1 << 16


def _powers(base: int, prime: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    while len(out) < _BLOCK:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out


_POWERS = [_powers(BASE, p) for p in PRIMES]
_INVERSE = [pow(BASE, -1, p) for p in PRIMES]
_INVERSE_POWERS = [_powers(i, p) for i, p in zip(_INVERSE, PRIMES)]

#: Code points that a mark depends on; one position in 2**_RARE is marked; a mark is a cut if the mark before it
#: is more than _QUIET away, so that no cut depends on where the text begins and runs of one code point have one
#: cut. A span is at most _MOST_SPAN long.
_WINDOW, _RARE, _QUIET, _MOST_SPAN = 8, 4, 8, 65535


def marks(codes: np.ndarray) -> np.ndarray:
    """Ends of the windows whose code points mark them, ascending."""
    if len(codes) < _WINDOW:
        return np.zeros(0, dtype=np.int64)
    x, step = codes * np.uint32(0x9E3779B1), 1
    for odd in (0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F):  # windows of 2, 4 and 8
        x = (x[:-step] ^ x[:-step] >> np.uint32(15)) * np.uint32(odd) + x[step:]
        step *= 2
    x = (x ^ x >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
    return np.flatnonzero(x >> np.uint32(32 - _RARE) == 0) + _WINDOW


class Prefixes:
    """The prefix arrays of one text: 16 bytes for each code point."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self.n, self.codes, self.marks = len(codes), codes, marks(codes)
        self.h = []
        for prime, power in zip(PRIMES, _POWERS):
            p, h, last = np.uint64(prime), np.zeros(self.n + 1, dtype=np.uint64), np.uint64(0)
            for at in range(0, self.n, _BLOCK):
                part = codes[at : at + _BLOCK].astype(np.uint64) + np.uint64(1)
                part *= power[: len(part)]
                part %= p
                if at:
                    part *= np.uint64(pow(BASE, at, prime))
                    part %= p
                np.cumsum(part, out=part)
                part += last
                part %= p
                h[at + 1 : at + 1 + len(part)] = part
                last = part[-1]
            self.h.append(h)

    def prefix(self, k: int, i: int) -> int:
        return int(self.h[k][i])

    def prefixes(self, k: int, at: np.ndarray) -> np.ndarray:
        return self.h[k][at]

    def span(self, i: int, j: int) -> tuple[int, ...]:
        """The hash of code points i to j, as if they stood at the start."""
        return tuple((int(h[j]) - int(h[i])) * pow(inv, i, p) % p for h, inv, p in zip(self.h, _INVERSE, PRIMES))


class Spliced:
    """The first keep code points of one text and then the first take of another, from their prefix arrays."""

    def __init__(self, a: Prefixes, keep: int, b: Prefixes, take: int):
        self.a, self.keep, self.b, self.n = a, keep, b, keep + take
        self.shift = [pow(BASE, keep, p) for p in PRIMES]
        # Windows across the seam are read; those on either side are known.
        left = max(0, keep - _WINDOW + 1)
        seam = marks(np.concatenate([a.codes[left:keep], b.codes[: min(take, _WINDOW - 1)]]))
        self.marks = np.concatenate([a.marks[: a.marks.searchsorted(keep, "right")], seam + left, b.marks[: b.marks.searchsorted(take, "right")] + keep])

    def prefix(self, k: int, i: int) -> int:
        if i <= self.keep:
            return int(self.a.h[k][i])
        return (int(self.a.h[k][self.keep]) + self.shift[k] * int(self.b.h[k][i - self.keep])) % PRIMES[k]

    def prefixes(self, k: int, at: np.ndarray) -> np.ndarray:
        m = at.searchsorted(self.keep, "right")
        after = self.b.h[k][at[m:] - self.keep] * np.uint64(self.shift[k]) + self.a.h[k][self.keep]
        return np.concatenate([self.a.h[k][at[:m]], after % np.uint64(PRIMES[k])])


def spans_equal(a: Prefixes, i: int, b: Prefixes, j: int, length: int) -> bool:
    return i + length <= a.n and j + length <= b.n and a.span(i, i + length) == b.span(j, j + length)


def longest_common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """How far the texts agree from position i of a and j of b on."""
    lo, hi = 0, min(a.n - i, b.n - j)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a.span(i, i + mid) == b.span(j, j + mid):
            lo = mid
        else:
            hi = mid - 1
    return lo


def grid(n: int) -> list[int]:
    """Lengths at which spans are kept: the same for all texts that are long enough."""
    out, k = [], 0
    while (m := int(2 ** (k / 4))) <= n:
        if not out or m != out[-1]:
            out.append(m)
        k += 1
    return out


_GRID = grid(1 << 40)


def _short(h1: int, h2: int) -> int:
    """24 bits of two hashes."""
    return ((h1 * 0x9E3779B1 ^ h2 * 0x85EBCA77) >> 20) & 0xFFFFFF


Parsed = tuple[int, int, list[int], list[int], bytes]


def spans(x: Prefixes | Spliced) -> bytes:
    """Of the spans between cuts, in order, 24 bits of the hash and 16 of the length."""
    far = np.diff(x.marks, prepend=-_QUIET - 1) > _QUIET
    ends = x.marks[far & (x.marks < x.n)]
    if x.n:
        ends = np.append(ends, x.n)
    starts = np.concatenate([np.zeros(1, dtype=np.int64), ends[:-1]])[: len(ends)]
    if len(ends) and (ends - starts).max() > _MOST_SPAN:
        starts = np.concatenate([np.arange(a, b, _MOST_SPAN) for a, b in zip(starts, ends)])
        ends = np.append(starts[1:], x.n)
    hashes = []
    for k, (prime, inverse) in enumerate(zip(PRIMES, _INVERSE)):
        p = np.uint64(prime)
        h = (x.prefixes(k, ends) + p - x.prefixes(k, starts)) % p * _INVERSE_POWERS[k][starts % _BLOCK] % p
        if x.n > _BLOCK:
            blocks = np.array([pow(inverse, at, prime) for at in range(0, x.n, _BLOCK)], dtype=np.uint64)
            h = h * blocks[starts // _BLOCK] % p
        hashes.append(h)
    short = (hashes[0] * np.uint64(0x9E3779B1) ^ hashes[1] * np.uint64(0x85EBCA77)) >> np.uint64(20) & np.uint64(0xFFFFFF)
    packed = (short << np.uint64(16) | (ends - starts).astype(np.uint64)).astype(">u8")
    return packed.view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()


def _unpacked(kept: bytes) -> np.ndarray:
    """One integer for each span; its lowest 16 bits are the length."""
    out = np.zeros((len(kept) // 5, 8), dtype=np.uint8)
    out[:, 3:] = np.frombuffer(kept, dtype=np.uint8).reshape(-1, 5)
    return out.view(">u8")[:, 0].astype(np.uint64)


def _numbered(v: np.ndarray) -> np.ndarray:
    """Equal spans told apart by their number among each other."""
    order = np.argsort(v, kind="stable")
    ordered = v[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))[: len(v)]
    at = np.arange(len(v)) - np.repeat(first, np.diff(np.append(first, len(v))))
    out = np.empty_like(v)
    out[order] = ordered << np.uint64(24) | at.astype(np.uint64)
    return out


def parts(x: Prefixes | Spliced) -> Parsed:
    """(length, whole hash, short hashes of prefixes, of suffixes, spans between cuts)."""
    (p1, p2), (i1, i2), n = PRIMES, _INVERSE, x.n
    w1, w2 = x.prefix(0, n), x.prefix(1, n)
    heads, tails = [], []
    for m in _GRID:
        if m > n:
            break
        heads.append(_short(x.prefix(0, m), x.prefix(1, m)))
        at = n - m
        tails.append(_short((w1 - x.prefix(0, at)) * pow(i1, at, p1) % p1, (w2 - x.prefix(1, at)) * pow(i2, at, p2) % p2))
    return n, w1 << 31 | w2, heads, tails, spans(x)


def encoded(x: Parsed) -> str:
    pack = lambda v: base64.urlsafe_b64encode(b"".join(s.to_bytes(3, "big") for s in v)).decode()
    return f"{x[0]}:{x[1]:016x}:{pack(x[2])}:{pack(x[3])}:{base64.urlsafe_b64encode(x[4]).decode()}"


def decoded(fingerprint: str) -> Parsed:
    n, whole, heads, tails, kept = fingerprint.split(":")
    unpack = lambda s: [int.from_bytes(b[i : i + 3], "big") for b in [base64.urlsafe_b64decode(s)] for i in range(0, len(b), 3)]
    return int(n), int(whole, 16), unpack(heads), unpack(tails), base64.urlsafe_b64decode(kept)


def _shared(a: list[int], b: list[int]) -> int:
    """The longest kept span that both have: if one agrees, all shorter ones do."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[mid - 1] == b[mid - 1]:
            lo = mid
        else:
            hi = mid - 1
    return _GRID[lo - 1] if lo else 0


def alike(a: Parsed, b: Parsed) -> float:
    """1 for equal texts, else the shared prefix and suffix and the equal spans between them as a share of the
    longer text, under 1 and at most the share that the shorter text is of it."""
    if a[:2] == b[:2]:
        return 1.0
    a, b = sorted((a, b), key=lambda x: x[:2])
    most, head = b[0], _shared(a[2], b[2])
    tail = max(most - _shared(a[3], b[3]), head)
    kept = _unpacked(b[4])
    length = (kept & np.uint64(0xFFFF)).astype(np.int64)
    ends = np.cumsum(length)
    inside = np.maximum(np.minimum(ends, tail) - np.maximum(ends - length, head), 0)
    both = int(inside[np.isin(_numbered(kept), _numbered(_unpacked(a[4])))].sum()) if len(a[4]) else 0
    return min(head + most - tail + both, a[0], most - 1) / most


def likeness(a: str, b: str) -> float:
    """alike() of two fingerprints as they are stored."""
    return alike(decoded(a), decoded(b))


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, shared_with_next long"
)


def _arrow_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in SCHEMA.split(", "))])


def _row(doc_id: int | None, text: str, own: Prefixes, own_parts: Parsed, after: str, nxt: Prefixes, nxt_parts: Parsed) -> tuple:
    change = own.n // 2
    keep, take = own.n - change, min(change, nxt.n)
    spliced = parts(Spliced(own, keep, nxt, take))
    edited = (text[:keep] + after[:take]).encode("utf-8", "surrogatepass")
    return (
        doc_id, own.n, hashlib.sha256(edited).hexdigest(), encoded(own_parts), encoded(spliced),
        alike(own_parts, spliced), alike(own_parts, nxt_parts), longest_common_extension(own, 0, nxt, 0),
    )


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in descending order of their keys; the last, a guest, is the first of the next bucket."""
    schema, held, ended, out = _arrow_schema(), None, False, []

    def flush() -> pa.RecordBatch:
        batch = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        out.clear()
        return batch

    for batch in batches:
        for doc_id, text, guest in zip(batch["doc_id"], batch["text"], batch["guest"]):
            if ended:
                continue
            doc_id, text = doc_id.as_py(), text.as_py() or ""
            own = Prefixes(text)
            own_parts = parts(own)
            if held is not None:
                out.append(_row(*held, text, own, own_parts))
            held, ended = (doc_id, text, own, own_parts), guest.as_py()
            if len(out) >= 2000:
                yield flush()
    if out:
        yield flush()


def fingerprint_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose second half is the start of the next text."""
    spark = df.sparkSession
    bounded_batches(spark)
    plain = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    dealt = ordered_buckets(plain, "doc_id", "text", buckets or shuffle_partitions(spark))
    k1, k2, bucket = dealt.names
    tops = {r[0]: tuple(r[1]) for r in dealt.keys.groupBy("bucket").agg(F.max(F.struct("k1", "k2"))).collect()}
    full = sorted(tops)
    # The largest key of a bucket also goes, as a guest, to the bucket above it; that of the top one to the lowest.
    to = {b: full[(i + 1) % len(full)] for i, b in enumerate(full)}
    at = lambda v, kind: F.element_at(array_literal([v.get(b) for b in range(dealt.n)], kind), F.col(bucket) + 1)
    is_top = (F.col(k1) == at({b: t[0] for b, t in tops.items()}, "bigint")) & (F.col(k2) == at({b: t[1] for b, t in tops.items()}, "bigint"))
    place = lambda b, guest: F.struct(b.cast("int").alias("bucket"), F.lit(guest).alias("guest"))
    here = place(F.col(bucket), False)
    rows = dealt.rows.withColumn("place", F.explode(F.when(is_top, F.array(here, place(at(to, "int"), True))).otherwise(F.array(here))))
    rows = rows.select("doc_id", "text", k1, k2, "place.bucket", "place.guest")
    rows = rows.repartitionById(dealt.n, F.col("bucket")).sortWithinPartitions(F.col("guest"), F.col(k1).desc(), F.col(k2).desc())
    return rows.select("doc_id", "text", "guest").mapInArrow(_pairs, SCHEMA)

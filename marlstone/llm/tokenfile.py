"""Token-id files with fixed-width bit packing.

Every id takes the fewest bits that hold any id of the tokenizer's vocabulary; one that needs more is an error. A file is one bounded run of documents in
ascending id order: a header, the documents' ids and lengths, the byte offsets of the blocks, and the blocks,
each of BLOCK ids packed low bit first and filled up to whole bytes. With the offsets a reader unpacks any block
by itself, in numpy, without touching the rest. Files are written by Spark's own writer, so that they go
wherever Spark can write and a lost task leaves nothing behind.

Layout, little-endian: magic "MTOK0001"; u32 bits, u32 BLOCK, u32 bucket, u32 file number in the bucket; u64
documents, u64 ids, u64 ids of the bucket before this file; documents' ids i64 each; 1 byte each whether the id
is not null; ids of each document u64; (blocks + 1) offsets u64, from the first block; the blocks; one newline.
A document longer than a file goes to a file of its own.

Defined results: a null text is empty and has the end id alone; null ids come first; equal ids are ordered by
the text's hash; an empty table writes no file and gives no rows. Only id and text are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import array_literal, bounded_batches, fresh_path, save, shuffle_partitions
from .splitters import ordered_buckets

MAGIC = b"MTOK0001"
BLOCK = 8192
#: Ids after which a file ends.
FILE_IDS = 1 << 21
_HEAD = struct.Struct("<8sIIIIQQQ")


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def vocabulary_of(path: str) -> int:
    """One more than the greatest id of a tokenizer's file."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab().values(), default=0) + 1


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids, low bit first, bits each, filled up to a whole byte."""
    if bits < 32 and len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {int(ids.max())} needs more than {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    as_bits = (ids.astype("<u4")[:, None] >> np.arange(bits, dtype="<u4")) & 1
    return np.packbits(as_bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=n).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, dtype=np.uint8), bitorder="little", count=n * bits).reshape(n, bits)
    return (flat.astype("<u4") << np.arange(bits, dtype="<u4")).sum(axis=1, dtype="<u4")


def build_file(docs: list[tuple[int | None, np.ndarray]], bits: int, bucket: int, number: int, before: int) -> bytes:
    """A file without its closing newline."""
    ids = np.concatenate([x for _, x in docs]) if docs else np.zeros(0, dtype="<u4")
    blocks = [pack(ids[i : i + BLOCK], bits) for i in range(0, len(ids), BLOCK)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    return b"".join([
        _HEAD.pack(MAGIC, bits, BLOCK, bucket, number, len(docs), len(ids), before),
        np.array([d or 0 for d, _ in docs], dtype="<i8").tobytes(),
        np.array([d is not None for d, _ in docs], dtype=np.uint8).tobytes(),
        np.array([len(x) for _, x in docs], dtype="<u8").tobytes(),
        offsets.tobytes(),
        *blocks,
    ])


class TokenFile:
    """A file's content: documents by number, and any span of ids, with only the blocks that it needs."""

    def __init__(self, data: bytes):
        magic, self.bits, self.block, self.bucket, self.number, n, self.n_ids, self.before = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = _HEAD.size
        self.data = memoryview(data)
        ids, known = np.frombuffer(data, "<i8", n, at), np.frombuffer(data, np.uint8, n, at + 8 * n)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known)]
        self.lengths = np.frombuffer(data, "<u8", n, at + 9 * n).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1, at + 17 * n).astype(np.int64)
        self.body = at + 17 * n + 8 * (blocks + 1)
        if len(data) != self.body + self.offsets[-1] + 1:
            raise ValueError("a token file that is cut short")

    def _block(self, i: int) -> np.ndarray:
        a, b = self.body + self.offsets[i], self.body + self.offsets[i + 1]
        return unpack(self.data[a:b], self.bits, min(self.block, self.n_ids - i * self.block))

    def ids(self, start: int, stop: int) -> np.ndarray:
        if start >= stop:
            return np.zeros(0, dtype="<u4")
        if self.bits in (8, 16, 32):  # blocks without gaps
            at = self.body + start * self.bits // 8
            return unpack(self.data[at : at + (stop - start) * self.bits // 8], self.bits, stop - start)
        first, last = start // self.block, (stop - 1) // self.block
        out = np.concatenate([self._block(i) for i in range(first, last + 1)])
        return out[start - first * self.block : stop - first * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


#: Stands for a newline at the start of a piece; texts that hold it are encoded whole.
LINE = "\x01"


class Encoder:
    """Ids of texts by a byte-level BPE file of the tokenizers library, as little-endian bytes.

    A text is cut before every single space between two others that are not white space, and before its newlines:
    no token of such a vocabulary reaches over such a place, so the ids of the pieces are the ids of the text. Arrow
    cuts the texts of a batch, numbers their different pieces and lays out the ids; pieces not met before are
    encoded together, a newline between them, the others come from a table of bounded size. Of a piece that is
    letters and marks after them, the two are looked up apart. A text whose newlines touch other white space is
    cut at spaces alone; one with a space amid other white space, or with what may be a special token, is encoded
    whole, and so is every text where the file's normalizer, pre-tokenizer or model is another."""

    ROOM = 1_000_000

    def __init__(self, path: str, wide: int = 4):
        import json
        import os
        import re

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.odd = re.compile(r"\s (?:\s|$)").search
        # Newlines that are not one or two between other characters, or one at the end.
        self.tangled = re.compile(r"\n(?:[^\S\n]|\n(?:\s|\Z)|(?<=[^\S\n]\n))").search
        self.marked = re.compile(rf"({LINE}?[^\W\d_]+)([^\w\s]+)").fullmatch
        self.edgy: set[str] = {""}  # pieces met with white space at an end
        self.kind, self.wide = f"<u{wide}", wide
        if max(self.tokenizer.get_vocab().values(), default=0) >> 8 * wide:
            raise ValueError(f"ids of {path} need more than {wide} bytes")
        self.seen: dict[str, bytes] = {}  # by the piece without its space
        self.marks: dict[str, bytes] = {}
        parts = json.loads(self.tokenizer.to_str())
        before, model = parts["pre_tokenizer"] or {}, parts["model"]
        (newline,) = self._raw(["\n"])
        self.newline = newline[0] if newline else -1
        self.special = [x["content"] for x in parts["added_tokens"]]
        self.cuts = (
            (before.get("type"), before.get("use_regex"), before.get("add_prefix_space")) == ("ByteLevel", True, False)
            and parts["normalizer"] is None
            and (model["type"], model.get("dropout"), len(newline)) == ("BPE", None, 1)
            and not any(x["lstrip"] or x["rstrip"] for x in parts["added_tokens"])
        )

    def _raw(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes()

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of pieces, each behind a space or, where it starts with LINE, behind a newline."""
        joined, rest, marked, seen, out = set(), [], [], self.seen, {}
        for p in pieces:
            if not p[-1:].isalnum() and (m := self.marked(p)):
                letters, marks = m.groups()
                marked.append((p, letters, marks))
                if letters in seen:
                    out[letters] = seen[letters]
                else:
                    joined.add(letters)
                if marks not in self.marks:
                    self.marks[marks] = b""
            elif p.split() == [p]:
                joined.add(p)
            else:
                rest.append(p)
        for lines in (False, True):
            some = [p for p in joined if (p[0] == LINE) == lines]
            for at in range(0, len(some), 4096):
                groups = [some[i : i + 64] for i in range(at, min(at + 4096, len(some)), 64)]
                # Each piece's ids come after a newline's; pieces behind a newline keep it.
                spelt = ["\n" + "\n".join([p[1:] for p in g] if lines else [" " + p for p in g]) for g in groups]
                for group, ids in zip(groups, self._raw(spelt)):
                    found = np.array(ids, dtype="<u4")
                    edges = np.flatnonzero(found == self.newline).tolist()
                    if len(edges) != len(group):
                        rest += group
                        continue
                    data, w, skip = found.astype(self.kind).tobytes(), self.wide, not lines
                    for p, i, j in zip(group, edges, [*edges[1:], len(found)]):
                        out[p] = data[w * (i + skip) : w * j]
        for at in range(0, len(rest), 4096):
            some = rest[at : at + 4096]
            out.update(zip(some, map(self._bytes, self._raw(["\n" + p[1:] if p[:1] == LINE else " " + p for p in some]))))
        new = [m for m, b in self.marks.items() if not b]
        self.marks.update(zip(new, map(self._bytes, self._raw(new))))
        for p, letters, marks in marked:
            out[p] = out[letters] + self.marks[marks]
        if len(self.marks) > 10_000:
            self.marks.clear()
        return out

    def encode(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        if not self.cuts:
            for at in range(0, len(texts), 256):
                yield from map(self._bytes, self._raw(texts.slice(at, 256).to_pylist()))
        elif len(texts):
            edges, data = self._some(texts)
            for i, j in zip(edges, edges[1:]):
                yield data[i:j].tobytes()

    def _some(self, texts: pa.Array) -> tuple[list[int], memoryview]:
        """The edges of the texts' ids in a buffer, and the buffer."""
        strings = texts.to_pylist()
        tangled = pa.array([self.tangled(t) is not None for t in strings])
        lined = pc.if_else(tangled, texts, pc.replace_substring(texts, "\n", " " + LINE))
        cut = pc.split_pattern(lined, " ")
        edges = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        pieces, at = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        found = list(map(self.seen.get, pieces))
        new = [p for p, b in zip(pieces, found) if b is None]
        edgy = self.edgy
        if len(edgy) < self.ROOM:  # else all texts are searched
            edgy.update(p for p in new if not p or p[0].isspace() or p[-1].isspace())
        if len(edgy) < self.ROOM:
            sharp = np.fromiter((p in edgy for p in pieces), dtype=bool, count=len(pieces))
            suspect = np.logical_or.reduceat(sharp[at], edges[:-1]).tolist()
        else:
            suspect = [True] * len(strings)
        special = [LINE, "<|", *self.special]
        whole = [any(x in t for x in special) or bool(s and self.odd(t)) for t, s in zip(strings, suspect)]
        learned = self._learn(new)
        if len(self.seen) < self.ROOM:
            self.seen.update(learned)
        table = [learned[p] if b is None else b for p, b in zip(pieces, found)]
        # A text's first piece has no space before it; that of a text to be encoded whole is all of it.
        firsts = self._raw([t if w else pieces[i] for t, w, i in zip(strings, whole, at[edges[:-1]].tolist())])
        for i in np.flatnonzero(whole).tolist():
            at[edges[i] : edges[i + 1]] = len(table)
        at[edges[:-1]] = len(table) + 1 + np.arange(len(strings))
        laid = pa.array([*table, b"", *map(self._bytes, firsts)], pa.large_binary()).take(pa.array(at))
        _, offsets, data = laid.buffers()
        return np.frombuffer(offsets, "<i8", len(laid) + 1)[edges].tolist(), memoryview(data or b"")


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder_for(path: str, wide: int) -> Encoder:
    """One for each file and worker: what a task has met helps the tasks after it."""
    if (path, wide) not in _encoders:
        _encoders[path, wide] = Encoder(path, wide)
    return _encoders[path, wide]


def _encode(path: str, end_id: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = 2 if bits <= 16 else 4
        encoder, end = encoder_for(path, wide), end_id.to_bytes(wide, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                rows = [x + end for x in encoder.encode(pc.fill_null(part["text"], ""))]
                names = [n for n in part.schema.names if n != "text"]
                yield pa.record_batch([*[part[n] for n in names], pa.array(rows, pa.binary())], names=[*names, "ids"])

    return run


def _files(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, number, before, bucket = [], 0, 0, 0, 0
        kind = "<u2" if bits <= 16 else "<u4"

        def close() -> pa.RecordBatch:
            nonlocal held, n, number, before
            data = build_file(held, bits, bucket, number, before)
            held, n, number, before = [], 0, number + 1, before + n
            return pa.record_batch([pa.array([data], pa.binary())], names=["data"])

        for batch in batches:
            for doc_id, at, ids in zip(batch["doc_id"].to_pylist(), batch["bucket"].to_pylist(), batch["ids"]):
                ids = np.frombuffer(ids.as_buffer(), dtype=kind)
                if held and n + len(ids) > FILE_IDS:
                    yield close()
                bucket = at
                held.append((doc_id, ids))
                n += len(ids)
        if held:
            yield close()

    return run


def write_token_files(df: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write the files of the table to the folder path. tokenizer: a path that is the
    same on all executors."""
    bits = bits_for(max(vocabulary_of(tokenizer), end_id + 1))
    bounded_batches(df.sparkSession)
    plain = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    dealt = ordered_buckets(plain, "doc_id", "text", shuffle_partitions(df.sparkSession))
    k1, k2, bucket = dealt.names
    rows = dealt.rows.select("doc_id", F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(bucket).alias("bucket"), "text")
    coded = rows.mapInArrow(_encode(tokenizer, end_id, bits), "doc_id long, k1 long, k2 long, bucket int, ids binary")
    placed = coded.repartitionById(dealt.n, F.col("bucket")).sortWithinPartitions("k1", "k2").select("doc_id", "bucket", "ids")
    files = placed.mapInArrow(_files(bits), "data binary")
    # Bytes pass through the text writer unchanged; each record becomes a file, closed by a newline.
    files.select(F.col("data").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("compression", "none").option("lineSep", "\n").text(path)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch["content"]:
            f = TokenFile(data.as_py())
            n = len(f.doc_ids)
            ids, edges = memoryview(f.ids(0, f.n_ids).astype("<u4").tobytes()), (4 * f.starts).tolist()
            sums = [zlib.crc32(ids[i:j]) for i, j in zip(edges, edges[1:])]
            columns = [
                pa.array(f.doc_ids, pa.int64()), pa.array(np.full(n, f.bucket), pa.int32()),
                pa.array(f.before + f.starts[:-1], pa.int64()), pa.array(f.lengths, pa.int64()), pa.array(sums, pa.int64()),
            ]
            yield pa.record_batch(columns, names=["doc_id", "bucket", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold: a row per document with the place of its ids among those of all documents."""
    found = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(path).select("content")
    local = save(found.mapInArrow(_read, "doc_id long, bucket int, start long, n_tokens long, ids_crc32 long"), "token-index")
    totals = {r[0]: r[1] for r in local.groupBy("bucket").agg(F.sum("n_tokens")).collect()}
    before, at = [], 0
    for b in range(max(totals, default=-1) + 1):
        before.append(at)
        at += totals.get(b, 0)
    offset = F.element_at(array_literal(before or [0], "bigint"), F.col("bucket") + 1)
    return local.select("doc_id", (F.col("start") + offset).alias("start"), "n_tokens", "ids_crc32")


def round_trip(df: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files of df to the shared folder and read them back."""
    path = fresh_path(df.sparkSession, "tokens")
    write_token_files(df, path, tokenizer, end_id, id_col, text_col)
    return read_token_files(df.sparkSession, path)

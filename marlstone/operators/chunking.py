"""Chunkers. A text's chunks are made within its row; packing of token ids uses prefix sums over the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import SPACE, let, strip, sub, text_of, word_count, words
from ..functions.text import prefilter
from .rows import SLICE_ROWS, draw, offsets, sliced

#: Tokens that one task puts in their places.
SLICE_TOKENS = 4_000_000
BLANK_LINE = f"\\n{SPACE}*\\n"


def word_windows(text: Column, size: int = 800, overlap: int = 120) -> Column:
    """array<string>: windows of words that overlap; the last is the first to reach the end."""
    step = max(1, size - overlap)

    def of(w: Column) -> Column:
        n = F.greatest(F.lit(0), F.ceil((F.size(w) - size) / F.lit(float(step)))).cast("int") + 1
        windows = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array_join(F.slice(w, i * step + 1, F.lit(size)), " "))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(windows)

    return let(words(text_of(text)), of)


def _cut(parts: Column, size, limit: int, joiner: str, own: Column | None = None) -> Column:
    """array<string>: consecutive parts joined, a new chunk where the next part would pass the limit."""
    start = F.struct(F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("len"), F.lit(0).alias("n"), F.array().cast("array<bigint>").alias("runs"))

    def step(acc: Column, p: Column) -> Column:
        def after(s: Column) -> Column:
            over = (acc["n"] > 0) & (acc["len"] + s > limit)
            run = acc["run"] + over.cast("long")
            return F.struct(run.alias("run"), F.when(over, s).otherwise(acc["len"] + s).alias("len"), (acc["n"] + 1).alias("n"), F.array_append(acc["runs"], run).alias("runs"))

        return let(size(p).cast("long"), after)

    return let(parts, lambda ps: joined_runs(ps, F.aggregate(ps, start, step)["runs"], joiner))


def joined_runs(parts: Column, runs: Column, joiner: str) -> Column:
    """Parts of equal run numbers, which ascend, joined."""

    def of(s: Column) -> Column:
        n = F.size(s["runs"])
        first = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (F.element_at(s["runs"], i) != F.element_at(s["runs"], F.greatest(i - 1, F.lit(1)))))
        ends = F.concat(F.slice(first, F.lit(2), F.size(first)), F.array(n + 1))
        out = F.zip_with(first, ends, lambda a, b: F.array_join(F.slice(s["parts"], a, b - a), joiner))
        return F.when(n == 0, F.array().cast("array<string>")).otherwise(let(F.struct(first.alias("f")), lambda _: out))

    return let(F.struct(parts.alias("parts"), runs.alias("runs")), of)


def paragraphs(text: Column, pattern: str = "\\n\\n") -> Column:
    return F.filter(F.transform(F.split(text_of(text), pattern, -1), strip), lambda p: p != "")


def paragraphs_by_words(text: Column, most: int = 1200) -> Column:
    """Paragraphs joined up to so many words; a longer one stands alone."""
    return _cut(paragraphs(text), word_count, most, "\n\n")


def paragraphs_by_chars(text: Column, most: int = 7000) -> Column:
    """Prefiltered text's paragraphs joined up to so many characters, two counted for each; a longer one is cut
    every so many."""
    parts = paragraphs(prefilter(text), BLANK_LINE)
    start = F.struct(F.lit(0).cast("long").alias("run"), F.lit(-1).cast("long").alias("len"), F.array().cast("array<struct<r:bigint,p:string>>").alias("out"))

    def step(acc: Column, p: Column) -> Column:
        n = F.char_length(p).cast("long")
        pieces = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(n / F.lit(float(most))).cast("int") - 1)), lambda i: F.substring(p, i * most + 1, F.lit(most)))
        numbered = F.transform(pieces, lambda x, i: F.struct((acc["run"] + 1 + i).alias("r"), x.alias("p")))
        over = (acc["len"] >= 0) & (acc["len"] + n + 2 > most)
        run = acc["run"] + over.cast("long")
        small = F.struct(run.alias("run"), (F.when(over | (acc["len"] < 0), F.lit(0)).otherwise(acc["len"]) + n + 2).alias("len"), F.array_append(acc["out"], F.struct(run.alias("r"), p.alias("p"))).alias("out"))
        large = F.struct((acc["run"] + F.size(pieces) + 1).cast("long").alias("run"), F.lit(-1).cast("long").alias("len"), F.concat(acc["out"], numbered).alias("out"))
        return F.when(n > most, large).otherwise(small)

    return let(F.aggregate(parts, start, step)["out"], lambda o: joined_runs(F.transform(o, lambda x: x["p"]), F.transform(o, lambda x: x["r"]), "\n\n"))


def paragraphs_by_chars_loose(text: Column, most: int = 8000) -> Column:
    """As paragraphs_by_chars, without prefilter, and cutting only paragraphs over one and a half times the limit,
    whose rest goes on with what follows."""
    parts = paragraphs(strip(text_of(text)), BLANK_LINE)
    start = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("cur"), F.lit(0).cast("long").alias("len"))

    def step(acc: Column, p: Column) -> Column:
        n = F.char_length(p).cast("long")
        over = (acc["len"] + n + 2 > most) & (F.size(acc["cur"]) > 0)
        done = F.when(over, F.array_append(acc["done"], F.array_join(acc["cur"], "\n\n"))).otherwise(acc["done"])
        kept = F.struct(done.alias("done"), F.when(over, F.array(p)).otherwise(F.array_append(acc["cur"], p)).alias("cur"), F.when(over, n + 2).otherwise(acc["len"] + n + 2).alias("len"))
        # A long paragraph takes the place of what has gathered: all but a rest of at most one limit is cut off.
        cuts = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(n / F.lit(float(most))).cast("int") - 2)), lambda i: F.substring(p, i * most + 1, F.lit(most)))
        rest = F.substring(p, F.size(cuts) * most + 1, n.cast("int"))
        long_ = F.struct(F.concat(done, cuts).alias("done"), F.array(rest).alias("cur"), F.char_length(rest).cast("long").alias("len"))
        return F.when(n > most * 1.5, long_).otherwise(kept)

    return let(F.aggregate(parts, start, step), lambda a: F.when(F.size(a["cur"]) > 0, F.array_append(a["done"], F.array_join(a["cur"], "\n\n"))).otherwise(a["done"]))


def sections(text: Column, most: int = 3000, least: int = 300) -> Column:
    """Sections joined until the next would pass most, as long as there are least characters; a tail below least
    is dropped."""
    parts = paragraphs(text, "\\n\\n+")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))

    def step(acc: Column, p: Column) -> Column:
        n = F.char_length(acc["cur"])
        full = (n + F.char_length(p) + 2 > most) & (n >= least)
        joined = F.when(acc["cur"] == "", p).otherwise(F.concat(acc["cur"], F.lit("\n\n"), p))
        return F.struct(F.when(full, F.array_append(acc["done"], strip(acc["cur"]))).otherwise(acc["done"]).alias("done"), F.when(full, p).otherwise(joined).alias("cur"))

    return let(F.aggregate(parts, start, step), lambda a: F.when(F.char_length(a["cur"]) >= least, F.array_append(a["done"], strip(a["cur"]))).otherwise(a["done"]))


def running_concat(df: DataFrame, group: str, order: str, text_col: str = "text", target: int = 1200) -> DataFrame:
    """Rows of each group joined by spaces in order; a chunk ends with the row that takes its length (each row's
    characters and one) to the target. Columns: group, chunk_idx, text, n_rows.

    The length starts anew after every chunk, which no frame of a window expresses: each group is folded in its
    order from a sorted stream, holding one chunk at a time."""
    import pyarrow as pa

    def fold(batches):
        key, buf, size, idx = object(), [], 0, 0
        names = [group, "chunk_idx", "text", "n_rows"]

        def chunk():
            return (key, idx, " ".join(buf), len(buf))

        for batch in batches:
            out = []
            for g, t in zip(batch[group].to_pylist(), batch["t"].to_pylist()):
                if g != key:
                    if buf:
                        out.append(chunk())
                    key, buf, size, idx = g, [], 0, 0
                buf.append(t)
                size += len(t) + 1
                if size >= target:
                    out.append(chunk())
                    buf, size, idx = [], 0, idx + 1
            if out:
                yield pa.record_batch([pa.array(c, f) for c, f in zip(zip(*out), (batch.schema.field(group).type, pa.int64(), pa.string(), pa.int64()))], names=names)
            last = batch.schema.field(group).type
        if buf:
            yield pa.record_batch([pa.array([v], f) for v, f in zip(chunk(), (last, pa.int64(), pa.string(), pa.int64()))], names=names)

    rows = df.select(group, order, strip(text_of(F.col(text_col))).alias("t")).where("t <> ''")
    kind = df.schema[group].dataType.simpleString()
    return rows.repartition(group).sortWithinPartitions(group, order).select(group, "t").mapInArrow(fold, f"`{group}` {kind}, chunk_idx long, text string, n_rows long")


def pack_tokens(df: DataFrame, order: str, tokens: str, length: int, rows: int = SLICE_ROWS, shuffle: str | None = None, max_sequences: int = 0) -> DataFrame:
    """Fixed blocks cut from all rows' tokens in order: block, tokens. The tail that fills no block is dropped.
    shuffle: a seed, by which rows are put in the order of a draw instead; max_sequences: blocks at most (0: all).

    A row's offset is a prefix sum in two steps: sums of slices of the order, of bounded rows and tokens, and sums
    within. A slice is one task; those that begin behind the last block stay where they are."""
    kept = df.select(F.col(order).alias("o") if shuffle is None else draw(shuffle, F.col(order)).alias("o"), F.col(tokens).alias("t"))
    parts, n = sliced(kept, "o", rows, F.size("t"), SLICE_TOKENS)
    before, total = offsets(parts, F.size("t"))
    blocks = total // length if max_sequences <= 0 else min(max_sequences, total // length)
    parts = parts.where(before < blocks * length)
    if n > 1:
        parts = parts.repartitionById(n, F.col("_slice").cast("int"))
    inner = F.sum(F.size("t")).over(Window.partitionBy("_slice").orderBy("o").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.size("t")
    placed = parts.withColumn("at", inner + before).where(F.size("t") > 0)
    # A row goes to each block that it reaches, with only its part of it.
    first, last = F.floor(F.col("at") / length), F.floor((F.col("at") + F.size("t") - 1) / length)
    cut = placed.withColumn("block", F.explode(F.sequence(first, last))).where(F.col("block") < blocks)
    lo = F.greatest(F.lit(0), F.col("block") * length - F.col("at"))
    hi = F.least(F.size("t"), (F.col("block") + 1) * length - F.col("at"))
    cut = cut.select("block", F.struct((F.col("at") + lo).alias("at"), F.slice("t", (lo + 1).cast("int"), (hi - lo).cast("int")).alias("t")).alias("p"))
    if n > 1:
        cut = cut.repartition(max(n, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "block")
    return cut.groupBy("block").agg(F.flatten(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["t"])).alias("tokens"))


def packing_summary(df: DataFrame, tokens: str, length: int, max_sequences: int = 0) -> DataFrame:
    """One row: documents, tokens, sequences, used_tokens and dropped_tokens of pack_tokens."""
    total = F.coalesce(F.sum(F.size(tokens)), F.lit(0)).cast("long")
    whole = F.floor(total / length)
    sums = df.agg(F.count("*").alias("documents"), total.alias("tokens"), (whole if max_sequences <= 0 else F.least(whole, F.lit(max_sequences))).alias("sequences"))
    return sums.withColumn("used_tokens", F.col("sequences") * length).withColumn("dropped_tokens", F.col("tokens") - F.col("used_tokens"))


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("annotations", "sub")]

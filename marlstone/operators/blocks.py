"""Segmentation of texts into blocks, their classification, scoring and chunking.

A text stays one row all the way: lines, blocks and chunks are arrays within it, so that no step shuffles. The
two ordered passes (classes that depend on earlier blocks, and chunks that fill up) are folds over the row's
blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import SPACE, WORD, chars_in, chars_not_in, hits, let, n_chars, ratio, squeeze, strip, sub, text_of, unfold

LINES = "array<string>"


def segment(text: Column) -> Column:
    """array<struct<line_start, line_end, lines>>: groups of lines without blank ones between them, by 1-based
    line number."""

    def blocks(lines: Column) -> Column:
        blank = lambda i: strip(F.get(lines, i)) == ""
        starts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: ~blank(i) & ((i == 0) | blank(F.greatest(i - 1, F.lit(0)))))
        ends = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: ~blank(i) & ((i == F.size(lines) - 1) | blank(F.least(i + 1, F.size(lines) - 1))))
        return F.zip_with(
            starts, ends,
            lambda a, b: F.struct((a + 1).cast("int").alias("line_start"), (b + 1).cast("int").alias("line_end"), F.slice(lines, a + 1, b - a + 1).alias("lines")),
        )

    return let(F.split(text_of(text), "\n", -1), blocks)


# The shapes of lines that tell tables of contents, indexes, references and diagrams.
DOTTED = "\\.{3,}\\s*\\p{Nd}+\\s*\\z"
PAGE_TAIL = ",\\s*\\p{Nd}+([\\s,\\-–]++\\p{Nd}++)*+\\s*\\z"
AUTHOR = "\\A\\s*\\p{Nd}+\\.?\\s+[A-Z][A-Za-z'\\-]+,\\s+[A-Z]\\."
FORMULA = "\\A(?:[A-Z]?[a-z]?\\p{Nd}?\\+?-?|[A-Z][A-Z]?\\p{Nd}?\\+?-?|[HCONSP][a-z0-9+\\-]{0,3})\\z"
LETTER = "\\A\\s*[A-Z]\\s*\\z"
ALL_DIGITS = "\\A\\s*\\p{Nd}+(\\s+\\p{Nd}+)*\\s*\\z"
FRONT_CUES = (
    "ISBN|Library of Congress|All rights reserved|Copyright|©|Verlag|Publisher|Cover design|Typesetting by|Printed in|First published|"
    "DOI:|Catalog(?:uing)?-in-Publication"
)
CONTENTS_CUES, INDEX_CUE = "Contents|Table of Contents", "(?i)\\A\\s*Index\\s*\\z"


def edges(alternatives: str, flags: str = "(?i)") -> str:
    """Alternatives between word edges as Python reads \\b: also beside a mark that a letter touches."""
    edge = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
    return f"{flags}{edge}(?:{alternatives}){edge}"


def solid(s: Column) -> Column:
    """A struct of s, its number of words, and solid: s without white space, in which runs of letters are longer, so that
    fewer matches count what is in it."""

    def of(q: Column) -> Column:
        joined = F.replace(q, F.lit(" "), F.lit(""))
        return let(joined, lambda x: F.struct(s.alias("s"), q.alias("squeezed"), x.alias("solid"), F.when(q == "", F.lit(0)).otherwise(n_chars(q) - n_chars(x) + 1).cast("long").alias("words")))

    return let(squeeze(s), of)


def line_features(line: Column) -> Column:
    """A struct of what a line looks like."""

    def of(x: Column) -> Column:
        s = x["s"]
        counts = F.struct(
            s.alias("s"), n_chars(s).alias("len"), x["words"].alias("words"), chars_in(x["solid"], "\\p{Nd}").alias("digits"), chars_in(x["solid"], "\\p{L}").alias("letters"), chars_in(x["solid"], "\\p{Lu}").alias("upper")
        )
        return let(
            counts,
            lambda c: F.struct(
                c["len"].alias("len"), c["words"].alias("words"), ratio(c["digits"], c["len"]).alias("digit_ratio"), ratio(c["letters"], c["len"]).alias("alpha_ratio"),
                ratio(c["upper"], c["letters"]).alias("upper_ratio"), c["s"].rlike("\\p{Nd}\\z").alias("ends_digit"), c["s"].rlike(DOTTED).alias("dotted_leader"),
                c["s"].rlike(PAGE_TAIL).alias("page_ref_tail"), ((c["s"] != "") & c["s"].rlike(FORMULA)).alias("chem_only"), c["s"].rlike(LETTER).alias("alpha_section"),
                c["s"].rlike(ALL_DIGITS).alias("all_digits"), c["s"].rlike(AUTHOR).alias("author"),
            ),
        )

    return let(strip(text_of(line)), lambda s: let(solid(s), of))


def _mean(features: Column, of) -> Column:
    """Null for a block without lines."""
    total = F.aggregate(features, F.lit(0.0), lambda a, f: a + of(f).cast("double"))
    return total / F.nullif(F.size(features), F.lit(0))


def _median(values: Column) -> Column:
    def middle(v: Column) -> Column:
        n = F.size(v)
        return (F.get(v, F.floor((n - 1) / 2).cast("int")) + F.get(v, F.floor(n / 2).cast("int"))) / F.lit(2.0)

    return let(F.sort_array(values), middle)


def block_features(lines: Column) -> Column:
    """A struct of means over a block's lines, each looked at once."""

    def of(f: Column) -> Column:
        share = lambda test: _mean(f, test)
        return F.struct(
            F.size(f).cast("long").alias("n"), _median(F.transform(f, lambda x: x["len"])).alias("median_len"), share(lambda x: x["words"]).alias("mean_words"),
            share(lambda x: x["len"] < 30).alias("short_ratio"), share(lambda x: x["words"] <= 2).alias("very_short_ratio"),
            share(lambda x: x["ends_digit"]).alias("ends_digit_ratio"), share(lambda x: x["dotted_leader"]).alias("dotted_ratio"),
            share(lambda x: x["page_ref_tail"]).alias("page_ref_tail_ratio"), share(lambda x: x["chem_only"]).alias("chem_only_ratio"),
            share(lambda x: x["alpha_section"]).alias("alpha_section_ratio"), share(lambda x: x["digit_ratio"]).alias("mean_digit_ratio"),
            share(lambda x: x["alpha_ratio"]).alias("mean_alpha_ratio"), share(lambda x: x["upper_ratio"]).alias("mean_upper_ratio"),
            share(lambda x: x["author"]).alias("author_ratio"),
        )

    return let(F.transform(lines, line_features), of)


# Fixed values, too: the tags, their order, the thresholds and the reasons of block_class, and those of quality.
def block_class(lines: Column, f: Column, position: Column, in_index: Column, in_refs: Column) -> Column:
    """struct<tag, reason> of a block by its features, its place in the text (0 to 1) and what goes on before it;
    the first rule that holds."""
    first = strip(F.get(lines, F.lit(0)))
    text = F.array_join(lines, "\n")
    tagged = lambda tag, reason: F.struct(F.lit(tag).alias("tag"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"))
    refs = F.bround(f["author_ratio"] * f["n"], 0).cast("int")
    return (
        F.when(f["n"] == 0, tagged("junk", "empty"))
        .when((f["n"] == 1) & (f["alpha_section_ratio"] == 1.0), tagged("alpha_section", "single-letter divider"))
        .when((position < 0.15) & text.rlike(f"(?i){FRONT_CUES}") & text.rlike(edges(FRONT_CUES)), tagged("front_matter", "ISBN/copyright/publisher boilerplate"))
        .when((f["n"] <= 3) & first.rlike(edges(CONTENTS_CUES)), tagged("toc_marker", "Contents heading"))
        .when((f["dotted_ratio"] > 0.4) & (f["n"] >= 4), tagged("toc", F.format_string("dotted-leader ratio=%.2f", f["dotted_ratio"])))
        .when(first.rlike(INDEX_CUE), tagged("index_marker", "Index heading"))
        .when(
            (position > 0.65) & (f["page_ref_tail_ratio"] > 0.5) & (f["mean_words"] < 8),
            tagged("index", F.format_string("page-ref tail ratio=%.2f, position=%.2f", f["page_ref_tail_ratio"], position)),
        )
        .when((f["n"] >= 3) & (f["author_ratio"] > 0.5), tagged("refs", F.format_string("numbered-author refs=%d/%d", refs, f["n"])))
        .when(in_index & (f["page_ref_tail_ratio"] > 0.35) & (f["mean_words"] < 12), tagged("index", "index continuation"))
        .when(in_refs & (f["author_ratio"] > 0.3), tagged("refs", "refs continuation"))
        .when((f["chem_only_ratio"] > 0.4) & (f["mean_words"] < 2.5), tagged("chemfrag", F.format_string("chem-only lines ratio=%.2f", f["chem_only_ratio"])))
        .when((f["very_short_ratio"] > 0.8) & (f["mean_words"] < 3) & (f["n"] >= 4), tagged("fragments", F.format_string("very-short-line cluster (%.1f w/line)", f["mean_words"])))
        .when((f["mean_upper_ratio"] > 0.75) & (f["mean_words"] < 4) & (f["n"] >= 3), tagged("form", F.format_string("all-caps fragment cluster (%.2f upper)", f["mean_upper_ratio"])))
        .when((f["mean_digit_ratio"] > 0.5) & (f["mean_words"] < 4), tagged("numeric", F.format_string("digit ratio=%.2f", f["mean_digit_ratio"])))
        .otherwise(tagged("prose", ""))
    )


def measures(text: Column) -> Column:
    """What quality() looks at, each counted once: a struct of words, chars, sentences, solid, letters, marks,
    distinct."""
    def of(x: Column) -> Column:
        return F.struct(
            x["words"].alias("words"), n_chars(x["s"]).alias("chars"), hits(x["s"], f"[.!?]{SPACE}").alias("sentences"), n_chars(x["solid"]).alias("solid"), chars_in(x["solid"], "\\p{L}").alias("letters"),
            chars_not_in(x["solid"], "\\p{L}\\p{N}").alias("marks"), F.size(F.array_distinct(F.array_remove(F.split(F.lower(x["squeezed"]), " ", -1), ""))).alias("distinct"),
        )

    return let(text_of(text), lambda t: let(solid(t), of))


def quality(text: Column) -> Column:
    """0 to 1 for prose, the sum of five bands: sentence and word length, letters, marks, vocabulary; 0 for fewer
    than 8 words."""
    # In hundredths, so that sums are exact.
    band = lambda *steps: F.coalesce(*[F.when(test, F.lit(points)) for test, points in steps], F.lit(0))

    def of(m: Column) -> Column:
        sentence, length = ratio(m["words"], F.greatest(F.lit(1), m["sentences"])), ratio(m["solid"], m["words"])
        letters, marks, distinct = ratio(m["letters"], m["chars"]), ratio(m["marks"], m["chars"]), ratio(m["distinct"], m["words"])
        points = (
            band((sentence.between(6, 60), 30), (sentence.between(3, 90), 15))
            + band((length.between(3.5, 7.5), 20), (length.between(3.0, 9.0), 10))
            + band((letters > 0.6, 20), (letters > 0.45, 10))
            + band((marks < 0.10, 15), (marks < 0.18, 5))
            + band((distinct > 0.50, 15), (distinct > 0.35, 8))
        )
        return F.when(m["words"] < 8, F.lit(0.0)).otherwise(points / F.lit(100.0))

    return let(measures(text), of)


def classified(text: Column, low: float = 0.35) -> Column:
    """The text's blocks with features, tag, reason and, for prose, quality; prose below low is marked so.

    A fold carries whether an index or references go on; only prose of three lines and twelve words a line ends
    them."""

    def of(s: Column) -> Column:
        total, blocks = s["total"], s["blocks"]
        start = F.struct(F.lit(False).alias("index"), F.lit(False).alias("refs"), F.array().cast("array<struct<tag:string,reason:string>>").alias("out"))

        def step(acc: Column, b: Column) -> Column:
            def after(t: Column) -> Column:
                strong = (t["tag"] == "prose") & (b["f"]["n"] >= 3) & (b["f"]["mean_words"] >= 12)
                going = lambda now, tags: F.when(t["tag"].isin(*tags), F.lit(True)).when(strong, F.lit(False)).otherwise(now)
                return F.struct(
                    going(acc["index"], ("index", "index_marker")).alias("index"), going(acc["refs"], ("refs",)).alias("refs"),
                    F.array_append(acc["out"], t).alias("out"),
                )

            return let(block_class(b["lines"], b["f"], b["line_start"] / F.greatest(total, F.lit(1)), acc["index"], acc["refs"]), after)

        tags = F.aggregate(blocks, start, step)["out"]

        def join(b: Column, t: Column) -> Column:
            q = F.when(t["tag"] == "prose", quality(F.array_join(b["lines"], "\n"))).otherwise(F.lit(0.0))
            return let(
                F.struct(b.alias("b"), t.alias("t"), q.alias("q")),
                lambda x: F.struct(
                    x["b"]["line_start"].alias("line_start"), x["b"]["line_end"].alias("line_end"), x["b"]["lines"].alias("lines"), x["b"]["f"].alias("features"),
                    F.when((x["t"]["tag"] == "prose") & (x["q"] < low), F.lit("low_quality_prose")).otherwise(x["t"]["tag"]).alias("tag"),
                    F.when((x["t"]["tag"] == "prose") & (x["q"] < low), F.format_string("quality=%.2f", x["q"])).otherwise(x["t"]["reason"]).alias("reason"),
                    x["q"].alias("quality"),
                ),
            )

        return F.zip_with(blocks, tags, join)

    with_features = F.transform(
        segment(text), lambda b: F.struct(b["line_start"].alias("line_start"), b["line_end"].alias("line_end"), b["lines"].alias("lines"), block_features(b["lines"]).alias("f"))
    )
    total = F.size(F.split(text_of(text), "\n", -1))
    return let(F.struct(total.alias("total"), with_features.alias("blocks")), of)


def chars(lines: Column) -> Column:
    """Characters of a block without its newlines."""
    return F.aggregate(lines, F.lit(0), lambda a, x: a + F.char_length(x))


def prose_chunks(blocks: Column, target: int = 6000, least: int = 800) -> Column:
    """array<struct<text, line_start, line_end, n_blocks, quality>>: runs of prose cut as soon as they reach the
    target; anything else ends a run; runs shorter than least are dropped."""
    # Every block gets its run: a run's number grows after a block that fills it, and at other blocks.
    start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("len"), F.array().cast("array<int>").alias("runs"))

    def step(acc: Column, b: Column) -> Column:
        prose = b["tag"] == "prose"
        now = acc["len"] + chars(b["lines"]) + 2
        full = now >= target
        return F.struct(
            F.when(~prose & (acc["len"] > 0), acc["run"] + 1).when(prose & full, acc["run"] + 1).otherwise(acc["run"]).alias("run"),
            F.when(prose & ~full, now).otherwise(F.lit(0)).alias("len"),
            F.array_append(acc["runs"], F.when(prose, acc["run"]).otherwise(F.lit(-1))).alias("runs"),
        )

    def of(b: Column) -> Column:
        marked = F.zip_with(b, F.aggregate(b, start, step)["runs"], lambda x, r: F.struct(r.alias("r"), x.alias("x")))

        def cut(m: Column) -> Column:
            numbers = F.array_distinct(F.filter(F.transform(m, lambda x: x["r"]), lambda r: r >= 0))

            def chunk(r: Column) -> Column:
                def make(mine: Column) -> Column:
                    good = F.filter(F.transform(mine, lambda x: x["x"]["quality"]), lambda q: q > 0)
                    mean = F.when(F.size(good) == 0, F.lit(0.0)).otherwise(F.bround(F.aggregate(good, F.lit(0.0), lambda a, q: a + q) / F.size(good), 3))
                    return F.struct(
                        F.array_join(F.transform(mine, lambda x: F.array_join(x["x"]["lines"], "\n")), "\n\n").alias("text"),
                        F.get(mine, F.lit(0))["x"]["line_start"].alias("line_start"), F.element_at(mine, -1)["x"]["line_end"].alias("line_end"),
                        F.size(mine).alias("n_blocks"), mean.alias("quality"),
                    )

                return let(F.filter(m, lambda x: x["r"] == r), make)

            return F.filter(F.transform(numbers, chunk), lambda c: F.char_length(c["text"]) >= least)

        return let(marked, cut)

    return let(blocks, of)


def process(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", target: int = 6000, least: int = 800) -> dict[str, DataFrame]:
    """chunks, audit and stats of every text: three reports from one pass over its blocks."""
    done = df.select(F.col(id_col).alias("book"), F.col(text_col).alias("raw"), classified(F.col(text_col)).alias("blocks"))
    chunked = done.withColumn("chunks", prose_chunks(F.col("blocks"), target, least))
    chunks = unfold(chunked, ["book"], F.col("chunks"), "chunk_idx", "c").select("book", "chunk_idx", "c.*")
    sample = sub(F.left(F.array_join(F.col("b.lines"), "\n"), F.lit(240)), "\\n", " / ")
    audit = (
        unfold(done, ["book"], F.col("blocks"), "i", "b")
        .where("b.tag <> 'prose'")
        .select("book", "b.line_start", "b.line_end", "b.tag", "b.reason", F.size("b.lines").alias("n_lines"), chars(F.col("b.lines")).alias("n_chars"), sample.alias("sample"))
    )
    kept = F.aggregate("chunks", F.lit(0), lambda a, c: a + F.char_length(c["text"]))
    stats = chunked.select(
        "book", n_chars(text_of(F.col("raw"))).alias("raw_chars"), F.size("blocks").alias("n_blocks"), F.size("chunks").alias("n_chunks"), kept.alias("kept_chars"),
        F.bround(ratio(kept, n_chars(text_of(F.col("raw")))), 4).alias("retention"),
    )
    return {"chunks": chunks, "audit": audit, "stats": stats, "tags": tag_totals(done)}


def tag_totals(done: DataFrame) -> DataFrame:
    """Blocks and characters of each tag, per book and over all (book null)."""
    rows = unfold(done, ["book"], F.col("blocks"), "i", "b").select("book", F.col("b.tag").alias("tag"), chars(F.col("b.lines")).cast("long").alias("chars"))
    return rows.rollup("tag", "book").agg(F.count("*").alias("blocks"), F.sum("chars").alias("chars")).where("tag is not null")

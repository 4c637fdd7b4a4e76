"""Row sets: coercion to fixed shapes, union, deduplication, splits, samples and schedules.

Random choices follow from hashes of a seed and a key, so that they are the same on every run and engine. Exact
counts of a split need the n-th digest, which is found by counting prefixes, and ranks over a whole table are made of
ranks within slices of its order and the rows of the slices before.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import n_chars, strip, text_of
from ..functions.text import dedup_key, first_filled


def coerce_sft(df: DataFrame) -> DataFrame:
    """question, answer, source, topic of rows of any such shape: q of 10 and a of 20 characters at least."""
    c = _columns(df)
    out = df.select(
        *_kept(df), first_filled(c("question"), c("prompt")).alias("question"), first_filled(c("answer"), c("response")).alias("answer"),
        first_filled(c("source"), F.lit("unknown")).alias("source"), first_filled(c("topic"), F.lit("Dentistry")).alias("topic"),
    )
    return out.where((n_chars(F.col("question")) >= 10) & (n_chars(F.col("answer")) >= 20))


def coerce_dpo(df: DataFrame) -> DataFrame:
    """prompt, chosen, rejected, source, topic: 10, 20 and 20 characters at least."""
    c = _columns(df)
    out = df.select(
        *_kept(df), first_filled(c("prompt"), c("question")).alias("prompt"), first_filled(c("chosen")).alias("chosen"), first_filled(c("rejected")).alias("rejected"),
        first_filled(c("source"), F.lit("unknown")).alias("source"), first_filled(c("topic"), F.lit("Dentistry")).alias("topic"),
    )
    return out.where((n_chars(F.col("prompt")) >= 10) & (n_chars(F.col("chosen")) >= 20) & (n_chars(F.col("rejected")) >= 20))


def coerce_cpt(df: DataFrame, least: int = 50) -> DataFrame:
    """text, source: texts of so many characters at least."""
    c = _columns(df)
    out = df.select(*_kept(df), first_filled(c("text")).alias("text"), first_filled(c("source"), F.lit("unknown")).alias("source"))
    return out.where(n_chars(F.col("text")) >= least)


def _columns(df: DataFrame):
    return lambda name: F.col(name) if name in df.columns else F.lit(None).cast("string")


def _kept(df: DataFrame) -> list[str]:
    """The columns that order rows."""
    return [c for c in ("src_rank", "ord") if c in df.columns]


def bounded_sft(question: Column, answer: Column, source: Column, topic: Column) -> Column:
    """A cleaned question of 5 to 6000 and answer of 5 to 30000 characters as a struct, else null."""
    from ..functions.text import clean_text

    q, a = clean_text(question), clean_text(answer)
    row = F.struct(q.alias("question"), a.alias("answer"), first_filled(source, F.lit("unknown")).alias("source"), first_filled(topic, F.lit("Dentistry")).alias("topic"))
    return F.when(n_chars(q).between(5, 6000) & n_chars(a).between(5, 30000), row)


def union_ranked(*parts: DataFrame) -> DataFrame:
    """All rows of the parts, in order of src_rank; columns that a part lacks are null."""
    ranked = [p.withColumn("src_rank", F.lit(i)) for i, p in enumerate(parts)]
    out = ranked[0]
    for p in ranked[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def first_wins(df: DataFrame, key: Column, *order: str) -> DataFrame:
    """Of rows with equal keys the first by order. Each task keeps one row a key before rows move."""
    w = Window.partitionBy("_key").orderBy(*order)
    return df.withColumn("_key", key).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_key", "_n")


def last_wins(df: DataFrame, key: Column, *order: str) -> DataFrame:
    w = Window.partitionBy("_key").orderBy(*[F.col(o).desc() for o in order])
    return df.withColumn("_key", key).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_key", "_n")


def unseen(df: DataFrame, seen: DataFrame, key: Column, seen_key: Column) -> DataFrame:
    """Rows whose key is not among those seen."""
    return df.withColumn("_key", key).join(seen.select(seen_key.alias("_key")).distinct(), "_key", "left_anti").drop("_key")


def dedup_across_shapes(questions: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First-wins over one key space: a text whose beginning has the key of a question kept is dropped too."""
    q = first_wins(questions, F.sha1(dedup_key(F.col("question"))), "src_rank", "ord")
    # The key goes along, so that texts move only where they are asked for.
    t = first_wins(texts.withColumn("_k", F.sha1(dedup_key(F.left("text", F.lit(500))))), F.col("_k"), "src_rank", "ord")
    return q, unseen(t, q, F.col("_k"), F.sha1(dedup_key(F.col("question")))).drop("_k")


def listed(df: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """The rows whose key is on a list."""
    return df.join(allowed.select(key).distinct(), key, "left_semi")


def missing(required: tuple[str, ...], present: Column) -> Column:
    """array<string>: what is required and not present."""
    return F.array_except(F.array(*[F.lit(r) for r in required]), present)


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    """The ids that occur, each once, in order."""
    return df.where(F.col(key).isNotNull()).select(key).distinct().orderBy(key)


def with_book(images: DataFrame, books: DataFrame, key: str = "book", rank: str = "src_rank") -> DataFrame:
    """Images with the book of their key; of books that share one the one of the least rank."""
    return images.join(first_wins(books, F.col(key), rank), key)


def overlay(raw: DataFrame, cleaned: DataFrame, key: str, value: str) -> DataFrame:
    """raw with the values that cleaned has instead."""
    new = cleaned.select(key, F.col(value).alias("_new"))
    return raw.join(new, key, "left").withColumn(value, F.coalesce("_new", value)).drop("_new")


def core_then_selective(core: DataFrame, cleaned: DataFrame, selective: DataFrame, key: str = "name", value: str = "text") -> DataFrame:
    """Core rows, as cleaned where they are, and the selective rows that are not core."""
    first = overlay(core, cleaned, key, value).withColumn("group", F.lit("core"))
    return first.unionByName(selective.join(core.select(key), key, "left_anti").withColumn("group", F.lit("selective")), allowMissingColumns=True)


def restore_destroyed(raw: DataFrame, cleaned: DataFrame, key: str = "name", value: str = "text", least: float = 0.05) -> DataFrame:
    """Rows whose cleaned text has less than the share of the raw text's characters: key, ratio, the raw text."""
    r, c = raw.select(key, F.col(value).alias("_raw")), cleaned.select(key, F.col(value).alias("_clean"))
    share = n_chars(text_of(F.col("_clean"))) / F.greatest(n_chars(text_of(F.col("_raw"))), F.lit(1)).cast("double")
    return r.join(c, key).withColumn("ratio", share).where(F.col("ratio") < least).select(key, "ratio", F.col("_raw").alias(value))


def draw(seed: str, *keys: Column) -> Column:
    """A hex digest that orders rows at random."""
    return F.sha1(F.concat_ws(":", F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]))


def _nth(digests: DataFrame, name: str, n: int) -> tuple[str, int, int]:
    """(prefix, wanted, there): the digests that begin so are there in that number, and wanted of them, with all
    below, make n. Found by counting prefixes of four more hex digits a round: 65,536 counts at most, no sort."""
    prefix, left = "", n
    while True:
        size = len(prefix) + 4
        counts = digests.where(F.col(name).startswith(prefix)).groupBy(F.left(name, F.lit(size)).alias("p")).count().collect()
        for p, there in sorted((r["p"], r["count"]) for r in counts):
            if left <= there:
                break
            left -= there
        if p == prefix or left == there or there == 1:
            return p, left, there
        prefix = p


def take_lowest(df: DataFrame, digest: Column, n: int, total: int) -> DataFrame:
    """df with taken, true for exactly n of its total rows: those with the lowest digests, and among rows of one
    digest those whose other columns hash lowest. Rows that are equal in all are not told apart: an error if some of
    them would have to be taken."""
    if n <= 0 or n >= total:
        return df.withColumn("taken", F.lit(n > 0))
    marked = df.withColumn("_d", digest)
    prefix, wanted, there = _nth(marked.select("_d"), "_d", n)
    own = F.left("_d", F.lit(len(prefix)))
    if wanted == there:
        return marked.withColumn("taken", own <= prefix).drop("_d")
    tied = marked.withColumn("_e", F.sha1(F.to_json(F.struct(*df.columns))))
    second, wanted, there = _nth(tied.where(own == prefix).select("_e"), "_e", wanted)
    if wanted != there:
        raise ValueError(f"{wanted} of {there} equal rows would have to be taken")
    return tied.withColumn("taken", (own < prefix) | ((own == prefix) & (F.left("_e", F.lit(len(second))) <= second))).drop("_d", "_e")


#: Rows that one task ranks, and slices at most.
SLICE_ROWS, MOST_SLICES = 1_000_000, 4096


def sliced(df: DataFrame, order: str, rows: int = SLICE_ROWS, weight: Column | None = None, most: int = 1) -> tuple[DataFrame, int]:
    """df with _slice, which ascends with the order, of about so many rows each, and of about most of the summed weight
    if one is given, and the number of slices. The bounds are quantiles of a bounded sample of the values, those that
    hash lowest, and so the same on every run."""
    count, heavy = df.agg(F.count("*"), F.sum(F.lit(0) if weight is None else weight)).first()
    n = min(MOST_SLICES, max(-(-count // rows), -(-int(heavy or 0) // most)))
    if n < 2:
        return df.withColumn("_slice", F.lit(0)), 1
    got = df.select(order).where(F.col(order).isNotNull()).orderBy(F.xxhash64(order)).limit(32 * n).collect()
    values = sorted(r[0] for r in got)
    bounds = sorted({values[i * len(values) // n] for i in range(1, n)}) if values else []
    step = max(1, math.isqrt(len(bounds)))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    below = lambda keys: F.size(F.filter(F.array(*[F.lit(k) for k in keys]), lambda k: k <= F.col(order)))
    # Two steps of some sqrt(n) comparisons.
    head = below([p[0] for p in parts]) if parts else F.lit(0)
    inner = F.lit(0)
    for i, p in enumerate(parts):
        inner = F.when(F.col("_head") == i + 1, below(p)).otherwise(inner)
    out = df.withColumn("_head", F.when(F.col(order).isNull(), F.lit(0)).otherwise(head))
    return out.withColumn("_slice", F.when(F.col("_head") == 0, F.lit(0)).otherwise((F.col("_head") - 1) * step + inner)).drop("_head"), len(bounds) + 1


def offsets(df: DataFrame, size: Column) -> tuple[Column, int]:
    """The sum of size over all slices before a row's own, from a row for each slice, and the total."""
    sums = {r["_slice"]: int(r["n"] or 0) for r in df.groupBy("_slice").agg(F.sum(size).alias("n")).collect()}
    before, total = [], 0
    for i in range(max(sums, default=-1) + 1):
        before.append(total)
        total += sums.get(i, 0)
    return F.element_at(F.from_json(F.lit(json.dumps(before or [0])), "array<bigint>"), F.col("_slice") + 1), total


def numbered(df: DataFrame, order: str, name: str = "n", rows: int = SLICE_ROWS) -> DataFrame:
    """df with name: each row's place in the order, from 0; ranks within slices and the rows of those before."""
    parts, _ = sliced(df, order, rows)
    before, _ = offsets(parts, F.lit(1))
    rank = F.row_number().over(Window.partitionBy("_slice").orderBy(order)) - 1
    return parts.withColumn(name, rank + before).drop("_slice")


def split_train_val(df: DataFrame, key: str, share: float = 0.05, least: int = 1, seed: str = "42") -> DataFrame:
    """df with split: val for max(least, int(n * share)) rows, train for the rest. Keys are distinct."""
    total = df.count()
    taken = take_lowest(df, draw(seed, F.col(key)), max(least, int(total * share)), total)
    return taken.withColumn("split", F.when(F.col("taken"), "val").otherwise("train")).drop("taken")


def split_by_group(df: DataFrame, group: str, share: float, seed: str = "42") -> DataFrame:
    """df with split: whole groups, round(groups * share) of them and at least one but not all, are val."""
    groups = df.select(group).distinct()
    n = groups.count()
    k = 0 if share <= 0 or n < 2 else min(n - 1, max(1, round(n * share)))
    taken = take_lowest(groups, draw(seed, F.col(group)), k, n).where("taken").select(group)
    return df.join(taken.withColumn("_v", F.lit(True)), group, "left").withColumn("split", F.when(F.col("_v"), "val").otherwise("train")).drop("_v")


def split_stratified(df: DataFrame, stratum: str, key: str, share: float = 0.08, most: int = 1, least_rows: int = 3, seed: str = "42") -> DataFrame:
    """df with split: of each stratum of least_rows and more, max(1, round(n * share)) rows are val, most of them
    at most (0: no limit) and never all."""
    sizes = df.groupBy(stratum).agg(F.count("*").alias("_n"))
    k = F.greatest(F.lit(1), F.bround(F.col("_n") * share, 0).cast("long"))
    k = F.least(k, F.lit(most)) if most > 0 else k
    sizes = sizes.withColumn("_k", F.when((F.col("_n") < least_rows) | F.lit(share <= 0), F.lit(0)).otherwise(F.least(k, F.col("_n") - 1)))
    place = F.row_number().over(Window.partitionBy(stratum).orderBy("_d"))
    ranked = df.select(stratum, key, draw(seed, F.col(key)).alias("_d")).withColumn("_r", place)
    if most > 0:
        ranked = ranked.where(F.col("_r") <= most)  # a limit for each group, kept by every task before rows move
    chosen = ranked.join(sizes, stratum).where(F.col("_r") <= F.col("_k")).select(key, F.lit(True).alias("_v"))
    return df.join(chosen, key, "left").withColumn("split", F.when(F.col("_v"), "val").otherwise("train")).drop("_v")


def sample(df: DataFrame, key: str, n: int, seed: str = "42") -> DataFrame:
    """n rows without replacement."""
    return df.orderBy(draw(seed, F.col(key)), key).limit(n)


def every_nth(df: DataFrame, order: str, k: int, rows: int = SLICE_ROWS) -> DataFrame:
    """k rows at even steps of the order, the first among them; none if there are fewer than k."""
    step = df.count() // k
    if not step:
        return df.limit(0)
    picked = numbered(df.select(order), order, "_n", rows).where((F.col("_n") % step == 0) & (F.col("_n") < step * k)).select(order)
    return df.join(picked, order, "left_semi")


def oversample(df: DataFrame, group: str, chosen: str, weight: float, key: str, seed: str = "42") -> DataFrame:
    """Rows of one group int(weight) times, and once more with the chance of the fraction; others once."""
    whole, part = int(weight), weight - int(weight)
    unit = F.conv(F.substring(draw(seed, F.col(key)), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))
    copies = F.lit(max(1, whole)) + F.when(unit < part, 1).otherwise(0)
    copies = F.when(F.col(group) == chosen, copies).otherwise(F.lit(1)) if weight > 1 else F.lit(1)
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), copies.cast("int") - 1)))


def round_robin(df: DataFrame, group: str, key: str, seed: str = "42") -> DataFrame:
    """df with turn and place: one row of each group in every turn, groups shuffled within it. Sorting by (turn,
    place) gives the order. Ranks are counted in slices of the draw, so that a group that holds a third of all rows
    goes to many tasks."""
    drawn = df.withColumn("_d", draw(seed, F.col(group), F.col(key))).withColumn("_s", F.left("_d", F.lit(2)))
    within = Window.partitionBy(group, "_s").orderBy("_d", key)
    counts = drawn.groupBy(group, "_s").agg(F.count("*").alias("_c"))
    earlier = Window.partitionBy(group).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col(group).alias("_g"), F.col("_s").alias("_t"), F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_b"))
    ranked = drawn.withColumn("_r", F.row_number().over(within).cast("long") - 1)
    out = ranked.join(before, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_s") == F.col("_t")))
    return out.withColumn("turn", F.col("_r") + F.col("_b")).withColumn("place", draw(seed, F.col(group), F.col("turn"))).drop("_d", "_s", "_r", "_b", "_g", "_t")


def schedule(df: DataFrame, group: str, subject: str, key: str, core: str = "core", core_epochs: int = 1, mixed_epochs: int = 1, weight: float = 1.0, seed: str = "42") -> DataFrame:
    """The training schedule: epochs over core rows, then over all with core rows oversampled, each in turns by
    subject. Columns: those of df, stage, epoch, turn, place; order by (stage, epoch, turn, place, key)."""
    first = round_robin(df.where(F.col(group) == core).withColumn("copy", F.lit(0)), subject, key, seed).withColumn("stage", F.lit(1))
    mixed = oversample(df, group, core, weight, key, seed)
    mixed = round_robin(mixed.withColumn("_k", F.concat_ws("#", key, "copy")), subject, "_k", f"{seed}+7").drop("_k").withColumn("stage", F.lit(2))
    epochs = lambda t, n: t.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(n)))) if n else t.withColumn("epoch", F.lit(1)).limit(0)
    return epochs(first, core_epochs).unionByName(epochs(mixed, mixed_epochs))


def template_choice(entity: Column, templates: list[str], salt: str = "") -> Column:
    """A template for each entity, always the same one."""
    n = F.conv(F.substring(F.sha1(F.concat(F.lit(salt), entity)), 1, 8), 16, 10).cast("long") % len(templates)
    return F.element_at(F.array(*[F.lit(t) for t in templates]), (n + 1).cast("int"))


# How styles of tasks take turns, eight, five, four, two and one of twenty.
TASK_STYLES = ["clinical_student"] * 8 + ["patient_friendly"] * 5 + ["exam_reasoning"] * 4 + ["differential_comparison"] * 2 + ["safety_referral"]


def task_style(index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in TASK_STYLES]), (index % len(TASK_STYLES) + 1).cast("int"))


def targets(words: Column, per: int, least: int, most: int) -> Column:
    """How many items a text of so many words is to give."""
    return F.greatest(F.lit(least), F.least(F.lit(most), F.bround(words / F.lit(float(per)), 0).cast("int")))


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("annotations", "strip")]

"""Reports: counts, duplicates, contradictions, cleaning and evaluation. Each is one or two aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import SPACE, let, n_chars, ratio, text_of, word_count, words
from ..functions.text import dedup_key
from .rows import last_wins


def counts(df: DataFrame, *keys: str) -> DataFrame:
    """How many rows there are of each combination of keys."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def top_k(df: DataFrame, key: str, k: int, order: str) -> DataFrame:
    """The k most frequent values with their counts; of equal counts the first seen."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.min(order).alias("first_seen")).orderBy(F.desc("n"), "first_seen").limit(k)


def corpus_stats(df: DataFrame, by: str, text_col: str = "text") -> DataFrame:
    """Rows, characters, words, means and tokens at four characters each, per group and over all (group null)."""
    c, w = n_chars(text_of(F.col(text_col))), word_count(text_of(F.col(text_col)))
    rows = df.select(by, c.alias("c"), w.alias("w"))
    return rows.rollup(by).agg(
        F.count("*").alias("n"), F.sum("c").alias("chars"), F.sum("w").alias("words"), F.avg("c").alias("mean_chars"), (F.sum("c") / 4.0).alias("est_tokens"), F.grouping(by).cast("long").alias("is_total")
    )


def pair_keys(df: DataFrame, question: str = "question", answer: str = "answer", source: str = "source") -> DataFrame:
    """Hashes of each row's question, and of the first 300 characters of its answer's key; rows without either
    are left out."""
    rows = df.where((text_of(F.col(question)) != "") & (text_of(F.col(answer)) != ""))
    return rows.select(F.sha1(dedup_key(F.col(question))).alias("q"), F.sha1(F.left(dedup_key(F.col(answer)), F.lit(300))).alias("a"), F.coalesce(source, F.lit("?")).alias("source"))


def duplicate_report(keys: DataFrame) -> DataFrame:
    """One row: rows, distinct and repeated questions and pairs, contradictions, rates in percent."""
    pairs = keys.groupBy("q", "a").agg(F.count("*").alias("n"))
    questions = pairs.groupBy("q").agg(F.sum("n").alias("n"), F.count("*").alias("answers"), F.sum(F.col("n") - 1).alias("extra"))
    total = F.greatest(F.coalesce(F.sum("n"), F.lit(0)), F.lit(1))
    return questions.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("distinct_questions"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_question_extras"),
        F.coalesce(F.sum("answers"), F.lit(0)).alias("distinct_pairs"), F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_pair_extras"), F.count_if(F.col("answers") > 1).alias("contradictions"),
        F.round(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)) * 100.0 / total, 2).cast("double").alias("duplication_rate_pct"),
        F.round(F.coalesce(F.sum("extra"), F.lit(0)) * 100.0 / total, 2).cast("double").alias("pair_duplication_rate_pct"),
    )


def multiplicities(keys: DataFrame) -> DataFrame:
    """How many questions occur once, twice, 3-5, 6-10 or more times."""
    n = F.col("n")
    bucket = F.when(n == 1, "1").when(n == 2, "2").when(n <= 5, "3-5").when(n <= 10, "6-10").otherwise(">10")
    return keys.groupBy("q").agg(F.count("*").alias("n")).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("questions"))


def contradictions(keys: DataFrame) -> DataFrame:
    """Questions with more than one answer: q, answers, sources."""
    return keys.groupBy("q").agg(F.countDistinct("a").alias("answers"), F.countDistinct("source").alias("sources")).where("answers > 1")


def warning_histogram(df: DataFrame, warnings: Column) -> DataFrame:
    return df.select(F.explode(warnings).alias("warning")).groupBy("warning").agg(F.count("*").alias("n"))


def cleaning_report(raw: DataFrame, cleaned: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """Each raw row's retention and warnings; missing_cleaned where there is no cleaned row."""
    from ..functions.predicates import cleaning_warnings, repeated_line_share

    r, c = raw.select(key, F.col(text_col).alias("a")), cleaned.select(key, F.col(text_col).alias("b"), F.lit(True).alias("there"))
    both = r.join(c, key, "left")
    warned = F.when(F.col("there").isNull(), F.array(F.lit("missing_cleaned"))).otherwise(cleaning_warnings(F.col("a"), F.col("b")))
    n = lambda x: n_chars(text_of(F.col(x)))
    return both.select(
        key, n("a").alias("input_chars"), F.when(F.col("there"), n("b")).alias("output_chars"), F.when(F.col("there"), F.bround(ratio(n("b"), n("a")), 4)).alias("retention"),
        F.when(F.col("there"), repeated_line_share(F.col("b"))).alias("repeated_line_fraction"), warned.alias("warnings"),
    )


def preparation_summary(df: DataFrame, text_col: str = "text", least: int = 2000) -> DataFrame:
    """Seen, written and skipped texts, and the characters written: texts below least are skipped, not dropped."""
    n = n_chars(text_of(F.col(text_col)))
    return df.agg(
        F.count("*").alias("seen"), F.count_if(n >= least).alias("written"), F.count_if(n < least).alias("skipped_too_short"), F.coalesce(F.sum(F.when(n >= least, n)), F.lit(0)).alias("total_chars")
    )


def accuracy(df: DataFrame, correct: str = "correct") -> DataFrame:
    """Scored rows, correct ones and their share to 4 places; null if none is scored."""
    scored, right = F.count(correct), F.count_if(F.col(correct))
    return df.agg(scored.alias("scored"), right.alias("correct"), F.round(F.try_divide(right.cast("double"), scored), 4).alias("accuracy"))


def compare_accuracy(baseline: DataFrame, candidate: DataFrame, order: str, key: str = "id", correct: str = "correct") -> DataFrame:
    """Accuracy of both, and the questions gained and lost by id; of rows with one id the last counts."""
    one = lambda t, name: last_wins(t, F.col(key), order).select(key, F.coalesce(correct, F.lit(False)).alias(name))
    both = one(baseline, "b").join(one(candidate, "c"), key)
    changed = both.agg(F.count_if(~F.col("b") & F.col("c")).alias("improvements"), F.count_if(F.col("b") & ~F.col("c")).alias("regressions"))
    total = lambda t, name: t.agg(F.count_if(correct).alias(f"{name}_correct"), F.try_divide(F.count_if(correct).cast("double"), F.count("*")).alias(f"{name}_accuracy"))
    out = changed.crossJoin(total(baseline, "baseline")).crossJoin(total(candidate, "candidate"))  # one row each
    return out.withColumns({"net_improvement": F.col("improvements") - F.col("regressions"), "accuracy_delta": F.col("candidate_accuracy") - F.col("baseline_accuracy")})


def has_repetition(text: Column) -> Column:
    """Whether a sentence occurs three times among more than three, or, of more than 20 words, some ten in a row
    occur again after them. Occurrences are compared as text, not at word edges."""
    t = text_of(text)

    def sentences(s: Column) -> Column:
        ordered = F.array_sort(F.filter(s, lambda x: x != ""))
        thrice = let(ordered, lambda o: F.exists(F.sequence(F.lit(0), F.greatest(F.size(o) - 3, F.lit(0))), lambda i: F.coalesce(F.get(o, i) == F.get(o, i + 2), F.lit(False))))
        return (F.size(s) > 3) & thrice

    def phrases(w: Column) -> Column:
        # Ten words occur again as text where the eight within are equal words, the first ends the word at its place
        # and the last begins the one at its own. Only eights that occur twice are looked at, by their hash.
        eights = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 10, F.lit(0))), lambda i: F.struct(F.xxhash64(F.slice(w, i + 2, F.lit(8))).alias("h"), i.alias("i")))

        def twice(s: Column) -> Column:
            same = lambda i, j: F.coalesce(F.get(s, i)["h"] == F.get(s, j)["h"], F.lit(False))
            return F.filter(s, lambda x, i: same(i, i + 1) | ((i > 0) & same(i, F.greatest(i - 1, F.lit(0)))))

        def again(d: Column) -> Column:
            def matches(x: Column, y: Column) -> Column:
                near = (x["h"] == y["h"]) & (y["i"] >= x["i"] + 10)
                ends = F.get(w, y["i"]).endswith(F.get(w, x["i"])) & F.get(w, y["i"] + 9).startswith(F.get(w, x["i"] + 9))
                return near & ends & (F.slice(w, x["i"] + 2, F.lit(8)) == F.slice(w, y["i"] + 2, F.lit(8)))

            return F.exists(d, lambda x: F.exists(d, lambda y: matches(x, y)))

        return (F.size(w) > 20) & let(let(F.array_sort(eights), twice), again)

    return let(F.split(t, "\\. ", -1), sentences) | let(words(t), phrases)


# Disclaimers that say nothing.
DISCLAIMERS = ("I am not a doctor", "I am not a dentist", "I can't tell you what is wrong", "I can't give you a diagnosis")


def answer_score(text: Column) -> Column:
    t = text_of(text)
    generic = F.size(F.filter(F.array(*[F.lit(d) for d in DISCLAIMERS]), lambda d: F.contains(t, d)))
    return (
        F.when(has_repetition(t), -3).otherwise(0) + F.when(n_chars(t).between(200, 800), 1).otherwise(0)
        + F.when(F.contains(t, F.lit("\n")) | F.contains(t, F.lit("- ")), 1).otherwise(0) + F.when(generic > 2, -1).otherwise(0)
    )


def better_answer(baseline: Column, candidate: Column) -> Column:
    b, c = answer_score(baseline), answer_score(candidate)
    return F.when(c > b, "candidate").when(b > c, "baseline").otherwise("tie")


def compare_answers(baseline: DataFrame, candidate: DataFrame, order: str, key: str = "id", text_col: str = "prediction") -> DataFrame:
    """One row: shared questions, mean lengths, and answers with repetitions of both."""
    one = lambda t, name: last_wins(t, F.col(key), order).select(key, text_of(F.col(text_col)).alias(name))
    both = one(baseline, "b").join(one(candidate, "c"), key)
    return both.agg(
        F.count("*").alias("questions"), F.avg(n_chars(F.col("b"))).alias("mean_length_baseline"), F.avg(n_chars(F.col("c"))).alias("mean_length_candidate"),
        F.count_if(has_repetition(F.col("b"))).alias("repetitions_baseline"), F.count_if(has_repetition(F.col("c"))).alias("repetitions_candidate"),
    )


def perplexity(loss: Column) -> Column:
    """exp(loss); infinite where that overflows."""
    return F.exp(loss)


def annotation_report(df: DataFrame, annotation: str, required: tuple[str, ...], score: str, flags: str) -> DataFrame:
    """One row: rows, those without annotation or required keys, with flags, mean score, and up to 5 examples of
    bad ones. annotation: a JSON column; score and flags: keys in it."""
    a = F.col(annotation)
    missing = F.array_except(F.array(*[F.lit(r) for r in required]), F.coalesce(F.json_object_keys(a), F.array().cast("array<string>")))
    v = F.try_parse_json(a)
    value = F.try_variant_get(v, f"$.{score}", "double")
    n_flags = F.size(F.coalesce(F.try_variant_get(v, f"$.{flags}", "array<string>"), F.array().cast("array<string>")))
    report = df.agg(
        F.count("*").alias("rows"), F.count_if(v.isNull()).alias("invalid"), F.count_if(v.isNotNull() & (F.size(missing) > 0)).alias("missing_keys"), F.count_if(n_flags > 0).alias("flagged"),
        F.avg(value).alias("mean_score"), F.min(value).alias("least_score"), F.max(value).alias("greatest_score"),
    )
    bad = df.where(v.isNull()).select(F.left(a, F.lit(80)).alias("a")).where("a is not null").distinct().orderBy("a").limit(5)
    return report.crossJoin(bad.agg(F.array_sort(F.collect_list("a")).alias("examples")))  # one row each, of five values at most


def question_type(question: Column) -> Column:
    """The first type whose words the question has."""
    low = F.lower(text_of(question))
    has = lambda *ws: F.exists(F.array(*[F.lit(w) for w in ws]), lambda w: F.contains(low, w))
    return (
        F.when(text_of(question).startswith("exam_reasoning"), "exam_reasoning").when(has("explain", "describe"), "explanation").when(has("what", "how"), "factual")
        .when(has("compare", "differ"), "comparison").otherwise("other")
    )


def dataset_profile(df: DataFrame, question: str = "question", answer: str = "answer", topic: str = "topic", source: str = "source") -> DataFrame:
    """One row: samples, mean words, distinct topics and sources, the share of the most frequent topic."""
    rows = df.select(topic, source, word_count(text_of(F.col(question))).alias("q"), word_count(text_of(F.col(answer))).alias("a"))
    top = rows.groupBy(topic).agg(F.count("*").alias("n")).agg(F.max("n").alias("top"))  # one row
    total = rows.agg(F.count("*").alias("samples"), F.avg("q").alias("mean_question_words"), F.avg("a").alias("mean_answer_words"), F.countDistinct(topic).alias("topics"), F.countDistinct(source).alias("sources"))
    return total.crossJoin(top).withColumn("top_topic_pct", F.try_divide(F.col("top") * 100.0, F.col("samples"))).drop("top")


def diversity_verdict(sft: DataFrame, dpo: DataFrame) -> DataFrame:
    """One row from two profiles: verdict, strengths and concerns (array<string>)."""
    s, d = sft.select(*[F.col(c).alias(f"s_{c}") for c in sft.columns]), dpo.select(*[F.col(c).alias(f"d_{c}") for c in dpo.columns])
    c, listed = F.col, lambda *x: F.array_compact(F.array(*x))
    both = s.crossJoin(d)  # one row
    return both.select(
        F.when((c("s_samples") >= 25_000) & (c("d_samples") >= 8_000) & (c("s_sources") >= 15), "sufficient").otherwise("augment").alias("verdict"),
        listed(F.when(c("s_samples") >= 25_000, "sft_size"), F.when(c("d_samples") >= 8_000, "dpo_size"), F.when(c("s_sources") >= 20, "source_diversity"), F.when(c("s_topics") >= 30, "topic_diversity")).alias("strengths"),
        listed(F.when(c("s_topics") < 20, "few_topics"), F.when(c("d_topics") < 15, "few_dpo_topics"), F.when(c("s_top_topic_pct") > 30, "dominant_topic")).alias("concerns"),
    )

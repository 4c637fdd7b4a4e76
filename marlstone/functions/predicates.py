"""Filters: conditions, measures and ordered reasons, all JVM-side."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import domain
from .expr import WORD, WS, chars_in, chars_not_in, hits, let, listed, n_chars, pieces, ratio, split_lines, squeeze, strip, sub, text_of, word_count, words
from .text import ascii_key

#: Words of Latin letters, as measures count them.
LATIN = listed("AZ", "az", "Àÿ")
LATIN_HYPHEN = "[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ\\-]+"


def _stem(pattern: str) -> str | None:
    """What is between the \\b at both ends, if it begins and ends in letters, so that they are edges before and after
    a word; else null."""
    group = "\\(\\?:[a-z \\-]+(?:\\\\w\\*)?(?:\\|[a-z \\-]+(?:\\\\w\\*)?)*\\)"
    m = re.fullmatch(f"\\\\b([a-z](?:[a-z \\-]|{group})*(?:\\\\w\\*)?)\\\\b", pattern)
    ends = [] if m is None else re.split("[|)]+", m[1].removesuffix("\\w*"))
    return m[1] if ends and all(re.search("[a-z]$", e.removesuffix("\\w*")) for e in ends if e) else None


def unicode_pattern(patterns: tuple[str, ...] | list[str]) -> str:
    """Alternatives with \\b and \\w in their Unicode meaning, without case. Those that are whole words are tried only
    where a word begins, and of them those with its first letter."""
    stems = [_stem(p) for p in patterns]
    if stems and all(stems):
        first = {s[0]: [x[1:] for x in stems if x[0] == s[0]] for s in stems}
        tried = "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in first.items()).replace("\\w", WORD)
        return f"(?iu)(?=[{''.join(first)}])(?<!{WORD})(?:{tried})(?!{WORD})"
    joined = "|".join(patterns).replace("\\w", WORD)
    # An edge before a letter or digit in the pattern, or after one: spelled out by looking around.
    return "(?iu)" + joined.replace("\\b", f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))")


def relevant(*texts: Column, patterns: tuple[str, ...] = domain.RELEVANT) -> Column:
    """Whether any of the texts has any of the patterns."""
    p = unicode_pattern(patterns)
    out = F.lit(False)
    for t in texts:
        out = out | F.coalesce(t.rlike(p), F.lit(False))
    return out


def headings_relevant(headings: Column, terms: tuple[str, ...] = domain.HEADINGS) -> Column:
    """Whether the joined headings hold any of the terms."""
    joined = F.lower(F.array_join(headings, " "))
    return F.coalesce(F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(joined, t)), F.lit(False))


def whole_word_hits(text: Column, terms: tuple[str, ...] = domain.WHOLE_WORDS) -> Column:
    """How often whole words of the list occur: stems in it hit only themselves."""
    return hits(text_of(text), f"(?iu)(?<!{WORD})(?:{'|'.join(terms)})(?!{WORD})")


def page_reference_density(text: Column) -> Column:
    """Numbers of 2 to 4 digits per word; 1 for fewer than 20 words."""
    n = F.size(pieces(text, LATIN))
    return F.when(n < 20, F.lit(1.0)).otherwise(ratio(hits(text, f"\\p{{Nd}}(?<!{WORD}\\p{{Nd}})\\p{{Nd}}{{1,3}}(?!{WORD})"), n))


def vocabulary_diversity(text: Column) -> Column:
    """Distinct words per word, without case; 0 for fewer than 30 words."""
    return let(pieces(F.lower(text), listed("az", "àÿ")), lambda w: F.when(F.size(w) < 30, F.lit(0.0)).otherwise(ratio(F.size(F.array_distinct(w)), F.size(w))))


def alpha_share(text: Column) -> Column:
    return ratio(chars_in(text, "\\p{L}"), n_chars(text))


def punctuation_share(text: Column) -> Column:
    return ratio(chars_not_in(text, f"\\p{{L}}\\p{{N}}{WS}"), n_chars(text))


def mean_word_length(text: Column) -> Column:
    return ratio(chars_not_in(text, WS), word_count(text))


def drop_reason(text: Column, quality: Column) -> Column:
    """Why a chunk of a book is dropped, the first reason that holds; null if none does. Duplicates come after."""
    t = text_of(text)
    return (
        F.when(n_chars(t) < 400, "short")
        .when(quality < 0.75, "quality")
        .when((n_chars(t) < 3000) & (page_reference_density(t) > 0.10), "index")
        .when(vocabulary_diversity(t) < 0.30, "diversity")
    )


def answer_quality(text: Column) -> Column:
    """Of a model's cleaned text: 0 for fragments, 0.3 for odd word lengths, else 0.8."""
    t = text_of(text)
    bad = (n_chars(t) < 200) | (word_count(t) < 30) | (alpha_share(t) < 0.55) | (punctuation_share(t) > 0.25)
    return F.when(bad, F.lit(0.0)).when(~mean_word_length(t).between(3.2, 9.0), F.lit(0.3)).otherwise(F.lit(0.8))


def front_matter_density(text: Column) -> Column:
    t = text_of(text)
    return ratio(hits(t, f"(?i)(?<!{WORD})(?:{domain.FRONT_MATTER})(?!{WORD})"), hits(t, LATIN_HYPHEN))


def worth_questions(text: Column, chunk_idx: Column, skip: int = 5, most: float = 0.012) -> Column:
    """Chunks to make questions of: past a book's first ones, and not front matter."""
    return (F.coalesce(chunk_idx, F.lit(0)) >= skip) & (front_matter_density(text) <= most)


def meta_question(q: Column) -> Column:
    return text_of(q).rlike(f"(?i)(?<!{WORD})(?:{domain.META_QUESTIONS})(?!{WORD})")


def content_tokens(text: Column) -> Column:
    """The distinct words of three letters and more that are not stop words."""
    found = F.regexp_extract_all(F.lower(text_of(text)), F.lit("([a-zà-ÿ][a-zà-ÿ\\-]+)"), F.lit(1))
    return F.array_distinct(F.filter(found, lambda w: (F.length(w) > 2) & ~w.isin(domain.STOPWORDS)))


def grounding(answer: Column, source: Column) -> Column:
    """The share of the answer's content words that the source has; 0 without any."""
    a, s = content_tokens(answer), content_tokens(source)
    return F.when(F.size(a) == 0, F.lit(0.0)).otherwise(ratio(F.size(F.array_intersect(a, s)), F.size(a)))


def divergence(a: Column, b: Column) -> Column:
    """1 less the Jaccard similarity of content words; null if either has none."""
    x, y = content_tokens(a), content_tokens(b)
    return F.when((F.size(x) > 0) & (F.size(y) > 0), 1 - ratio(F.size(F.array_intersect(x, y)), F.size(F.array_union(x, y))))


def question_fault(question: Column, chosen: Column, rejected: Column, source: Column) -> Column:
    """Why a generated question is refused, the first reason; ok if none."""
    q, c, r = (strip(text_of(x)) for x in (question, chosen, rejected))
    return (
        F.when(~n_chars(q).between(25, 800), "q_length")
        .when(meta_question(q), "meta_question")
        .when(~n_chars(c).between(80, 3000), "chosen_length")
        .when(~n_chars(r).between(80, 3000), "rejected_length")
        .when(grounding(c, source) < 0.40, "grounding")
        .when(~F.coalesce(divergence(c, r) >= 0.30, F.lit(False)), "rejected_too_similar")
        .when(F.lower(c) == F.lower(r), "identical")
        .otherwise("ok")
    )


def good_instruction(instruction: Column, output: Column, least: int = 60, most: int = 200) -> Column:
    i, o = strip(text_of(instruction)), strip(text_of(output))
    return (n_chars(i) >= 12) & (n_chars(o) >= 40) & word_count(o).between(least, most)


def good_preference(prompt: Column, chosen: Column, rejected: Column, least: int = 80, most: int = 220) -> Column:
    p, c, r = (strip(text_of(x)) for x in (prompt, chosen, rejected))
    return (n_chars(p) >= 12) & (n_chars(c) >= 40) & (n_chars(r) >= 20) & (ascii_key(c) != ascii_key(r)) & word_count(c).between(least, most)


def repeated_line_share(text: Column) -> Column:
    """Of the lines of 5 to 120 characters, the share that occur three times or more, to 4 places."""
    norms = F.filter(F.transform(split_lines(text_of(text)), lambda x: F.lower(squeeze(x))), lambda x: n_chars(x).between(5, 120))
    ordered = F.sort_array(norms)

    def share(s: Column) -> Column:
        same = lambda i, j: (i + j >= 0) & (i + j < F.size(s)) & F.coalesce(F.get(s, F.greatest(i, F.lit(0)) + 0 * j) == F.get(s, F.greatest(i + j, F.lit(0))), F.lit(False))
        often = F.filter(s, lambda x, i: (same(i, F.lit(1)) & same(i, F.lit(2))) | (same(i, F.lit(-1)) & same(i, F.lit(1))) | (same(i, F.lit(-1)) & same(i, F.lit(-2))))
        return F.when(F.size(s) == 0, F.lit(0.0)).otherwise(F.bround(ratio(F.size(often), F.size(s)), 4))

    return let(ordered, share)


# Phrases of assistants that leak into cleaned texts.
LEAKED = ("here is the cleaned", "i have cleaned", "as an ai", "output only", "text to clean")


def _list(*reasons: Column) -> Column:
    return F.array_compact(F.array(*reasons))


def retention(source: Column, cleaned: Column) -> Column:
    return ratio(n_chars(text_of(cleaned)), n_chars(text_of(source)))


def cleaning_warnings(source: Column, cleaned: Column) -> Column:
    """array<string>, in a fixed order: the stricter rule set."""
    c, r = text_of(cleaned), retention(source, cleaned)
    start = F.left(F.lower(c), F.lit(1000))
    return _list(
        F.when(strip(c) == "", "empty"),
        F.when(r < 0.35, "very_low_retention").when(r < 0.55, "low_retention_review"),
        F.when(r > 1.08, "unexpected_growth"),
        F.when(repeated_line_share(c) > 0.08, "repeated_layout_leftover"),
        F.when(F.exists(F.array(*[F.lit(p) for p in LEAKED]), lambda p: F.contains(start, p)), "assistant_or_prompt_leak"),
        F.when(F.contains(c, F.lit("<SKIP>")), "skip_token_leak"),
    )


def cleaning_warnings_simple(source: Column, cleaned: Column) -> Column:
    c, r = text_of(cleaned), F.bround(retention(source, cleaned), 4)
    return _list(
        F.when(r < 0.7, "low_retention"), F.when(r > 1.1, "unexpected_growth"), F.when(strip(c) == "", "empty_output"),
        F.when(F.lower(strip(c)).startswith("sure"), "assistant_preface_detected"),
    )


def chunk_warnings(source: Column, cleaned: Column) -> Column:
    c, r = text_of(cleaned), retention(source, cleaned)
    low = F.lower(strip(c))
    found = _list(
        F.when(~r.between(0.8, 1.2), F.format_string("length_ratio_%.2f", r)),
        F.when(low.startswith("sure") | low.startswith("here"), "assistant_preface_detected"),
        F.when(F.contains(c, F.lit("As an AI")), "assistant_disclaimer_detected"),
    )
    return F.when(c == "", F.array(F.lit("empty_output"))).otherwise(found)


def preparation_warnings(source: Column, cleaned: Column) -> Column:
    c = text_of(cleaned)
    found = _list(
        F.when(c.rlike("```|<!--|!\\["), "residual_markdown"), F.when(n_chars(c) < 200, "very_short"), F.when(retention(source, cleaned) < 0.2, "low_retained_ratio")
    )
    return F.when(c == "", F.array(F.lit("empty"))).otherwise(found)


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("annotations", "sub", "words")]

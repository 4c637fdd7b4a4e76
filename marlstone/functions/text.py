"""Text functions: Column in, Column out. All run in the JVM but for nfkc(), which Spark has no function for."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .expr import LINE_BREAK, SPACE, WORD, let, listed, n_chars, rstrip, split_lines, squeeze, strip, sub, text_of

# The characters replaced one for one, those removed, and the spaced-out ligatures of OCR with
# what they stand for.
PLAIN_FROM = "‘’‚‛“”„‟–—−\u00a0"
PLAIN_TO = "''''\"\"\"\"--- "
REMOVED = "\u200b\u200c\u200d\ufeff\u00ad"
LIGATURES = (
    ("dif culty?", "difficult"), ("dif cult", "difficult"), ("ef cien(t|cy|tly)", "efficien$1"), ("ef cacy", "efficacy"),
    ("of cer", "officer"), ("of ce", "office"), ("of cial", "official"), ("suf cient", "sufficient"),
    ("classi cation", "classification"), ("identi cation", "identification"), ("speci c", "specific"), ("signi cant", "significant"),
    ("bene t", "benefit"), ("con rm", "confirm"), ("de nition", "definition"), ("de ned", "defined"), ("in uence", "influence"),
    ("in ammation", "inflammation"), ("coef cient", "coefficient"), ("magni cation", "magnification"), ("justi cation", "justification"),
)
# Lines that book cleaning removes, and citations.
REMOVED_LINES = (
    f"{SPACE}*页码[，,。:]{SPACE}*", f"{SPACE}*Bookmark URL:.*", f"{SPACE}*\\p{{Nd}}+/\\p{{Nd}}+{SPACE}*",
    f"{SPACE}*(?i:Page){SPACE}+\\p{{Nd}}+({SPACE}+(?i:of){SPACE}+\\p{{Nd}}+)?{SPACE}*", f"{SPACE}*(http|https|www)[^{SPACE[1:-1]}]+{SPACE}*",
    f"{SPACE}*©.*", f"{SPACE}*ISBN[{SPACE[1:-1]}-]*\\p{{Nd}}.*",
)
#: All of them: what follows the white space has one of a few first characters.
REMOVED_LINE = f"{SPACE}*+(?=[页B\\p{{Nd}}Pphw©I])(?:{'|'.join(p.removeprefix(f'{SPACE}*') for p in REMOVED_LINES)})"
_NUMBERS = f"\\[\\p{{Nd}}{{1,4}}(?:[,{SPACE[1:-1]}-]*\\p{{Nd}}{{1,4}})*\\]"
CITATIONS = f"(?:{_NUMBERS})+"


@F.arrow_udf(StringType())
def _nfkc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        # A few texts at a time are Python strings beside the batch.
        parts = (texts.slice(at, 128).to_pylist() for at in range(0, len(texts), 128))
        made = [pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in part], pa.string()) for part in parts]
        yield pa.concat_arrays(made) if made else pa.array([], pa.string())


#: ASCII, Latin letters to U+00FF and CJK ideographs stand for themselves in normal form KC, alone and in any order.
NOT_NORMAL = "[^\\x00-\\x7f\\xc0-\\xff\\u4e00-\\u9fff]"


def nfkc(c: Column) -> Column:
    """Unicode normal form KC, in batches. Texts that are in it for sure do not leave the JVM."""
    return F.coalesce(_nfkc(F.when(c.rlike(NOT_NORMAL), c)), c)


def unix_newlines(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def sub_where(c: Column, found: Callable[[Column], Column], f: Callable[[Column], Column]) -> Column:
    """f(c) where found(c), a cheap test without which f changes nothing; c as it is elsewhere."""
    return let(c, lambda x: F.when(found(x), f(x)).otherwise(x))


def few_blanks(c: Column) -> Column:
    """No more than one blank line."""
    return sub_where(c, lambda x: F.contains(x, F.lit("\n\n\n")), lambda x: sub(x, "\\n{3,}", "\n\n"))


def single_spaces(c: Column) -> Column:
    """Runs of spaces and tabs to one space."""
    return sub_where(c, lambda x: F.contains(x, F.lit("  ")) | F.contains(x, F.lit("\t")), lambda x: sub(x, "[ \\t]{2,}|\\t", " "))


def clean_text(c: Column, normal_form: bool = True) -> Column:
    """Normal form KC, newlines, single spaces, no more than one blank line, no white space at the ends; null is
    empty."""
    c = text_of(c)
    c = unix_newlines(nfkc(c) if normal_form else c)
    return strip(few_blanks(single_spaces(c)))


def _within(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(f"\\A(?:{pattern})\\z"), F.lit(False))


def clean_book(c: Column, normal_form: bool = True) -> Column:
    """Book text: plain punctuation, words joined over line ends, page marks and the like removed, ligatures
    mended, citations dropped, blank lines squeezed."""
    c = text_of(c)
    c = nfkc(c) if normal_form else c
    c = sub_where(F.replace(c, F.lit("…"), F.lit("...")), lambda x: x.rlike(f"[[^\\x00-\\x7f]&&[{PLAIN_FROM}{REMOVED}]]"), lambda x: F.translate(x, PLAIN_FROM + REMOVED, PLAIN_TO))
    c = sub_where(unix_newlines(c), lambda x: F.contains(x, F.lit("-\n")), lambda x: sub(x, f"({WORD})-\\n([a-z])", "$1$2"))

    def ligatures(line: Column) -> Column:
        for wrong, right in LIGATURES:
            line = sub(line, f"(?<!{WORD}){wrong}(?!{WORD})", right)
        return line

    def mended(s: Column) -> Column:
        # One pass over the text tells whether any of the ligatures is in it.
        lines = F.filter(F.transform(F.split(s, "\n", -1), rstrip), lambda x: ~_within(x, REMOVED_LINE))
        lines = F.when(s.rlike(any_ligature), F.transform(lines, ligatures)).otherwise(lines)
        lines = F.when(F.contains(s, F.lit("[")), F.transform(lines, lambda x: sub(x, CITATIONS))).otherwise(lines)
        return few_blanks(single_spaces(F.array_join(lines, "\n")))

    any_ligature = f"(?=[{''.join(sorted({w[0] for w, _ in LIGATURES}))}])(?<!{WORD})(?:{'|'.join(w for w, _ in LIGATURES)})(?!{WORD})"
    return strip(let(c, mended))


def clean_ocr(c: Column) -> Column:
    """OCR text: no byte order marks or nulls, words and sentences joined over line ends, single spaces."""
    c = unix_newlines(F.replace(F.replace(text_of(c), F.lit("\ufeff"), F.lit("")), F.lit("\0"), F.lit("")))
    # What is to be found comes first in the patterns, and what stands before it is looked at only there.
    c = sub(c, f"-\\n(?<={WORD}-\\n)(?={WORD})")
    return single_spaces(sub(c, f"\\n(?=[a-z])(?<={WORD}\\n)", " "))


def line_norm(line: Column) -> Column:
    return F.lower(squeeze(line))


def repeated(values: Column, times: int) -> Column:
    """The values that an array without nulls holds so often: those that equal the one times - 1 places on, once sorted."""
    ordered = F.sort_array(values)
    pairs = let(ordered, lambda s: F.zip_with(F.slice(s, F.lit(1), F.greatest(F.size(s) - (times - 1), F.lit(0))), F.slice(s, F.lit(times), F.greatest(F.size(s) - (times - 1), F.lit(0))), lambda a, b: F.when(a == b, a)))
    return F.array_distinct(F.array_compact(pairs))


def drop_repeated_lines(c: Column, min_repeats: int = 4) -> Column:
    """Without the lines of 3 to 100 characters that occur so often, up to case and white space."""

    def kept(lines: Column) -> Column:
        norms = F.transform(lines, line_norm)
        short = F.filter(norms, lambda x: n_chars(x).between(3, 100))
        return let(
            F.struct(lines.alias("lines"), repeated(short, min_repeats).alias("often")),
            lambda s: F.when(F.size(s["often"]) == 0, s["lines"]).otherwise(F.filter(s["lines"], lambda x: ~F.array_contains(s["often"], line_norm(x)))),
        )

    return F.array_join(let(split_lines(text_of(c)), kept), "\n")


# Lines that the prefilter removes, by their stripped form.
PAGE_NUMBER = f"(?i:(?:page{SPACE}*)?\\p{{Nd}}{{1,4}}{SPACE}*)"
URL_ONLY = f"(?i:(https?://|www\\.)[^{SPACE[1:-1]}]+{SPACE}*)"
COPYRIGHT = f"\\A(?:(?i:copyright)(?!{WORD})|(?:\\([cC]\\)|©)(?={WORD}))"
ISBN = f"(?<!{WORD})ISBN(?:-1[03])?[{SPACE[1:-1]}:]*[\\p{{Nd}}\\-Xx]+"


def prefilter(c: Column) -> Column:
    """OCR cleaning, repeated lines dropped, page numbers, lone URLs, copyright and short ISBN lines dropped."""

    def good(line: Column) -> Column:
        s = strip(line)
        return ~(s.rlike(f"\\A(?:(?:{PAGE_NUMBER}|{URL_ONLY})\\z|{COPYRIGHT[2:]})") | (F.contains(s, F.lit("ISBN")) & s.rlike(ISBN) & (n_chars(s) < 120)))

    lines = F.filter(split_lines(drop_repeated_lines(clean_ocr(c))), good)
    return strip(few_blanks(F.array_join(lines, "\n")))


# Lines that the light cleaning removes.
LIGHT_PAGE = "\\p{Nd}{1,4}"
LIGHT_URL = f"https?://[^{SPACE[1:-1]}]+"
LIGHT_ISBN = f"(?i)ISBN(?<!{WORD}ISBN)[{SPACE[1:-1]}\\-:]*[\\p{{Nd}}\\-X]+"
LIGHT_COPYRIGHT = f"(?i)\\A(©|\\(c\\)|Copyright){SPACE}+\\p{{Nd}}{{4}}"
LIGHT_CITATION = f"[A-Z][a-zA-Z'\\-]+({SPACE}+[A-Z]\\.?){{0,3}}.*(?<!{WORD})(19|20)\\p{{Nd}}{{2}}(?!{WORD}).*[;:].*\\p{{Nd}}+[-\\p{{Nd}}]*\\.?"


def light_lines(c: Column) -> Column:
    """array<string>: the lines that the light cleaning keeps; those of white space are empty."""

    def noise(line: Column) -> Column:
        s = strip(line)
        return (
            s.rlike(f"\\A(?:(?:{LIGHT_PAGE}|{LIGHT_URL})\\z|{LIGHT_COPYRIGHT.replace(chr(92) + 'A', '')})") | ((n_chars(s) < 80) & s.rlike(LIGHT_ISBN))
            | ((n_chars(s) < 200) & _within(s, LIGHT_CITATION))
        )

    return F.transform(F.filter(F.split(text_of(c), "\n", -1), lambda x: ~noise(x)), lambda x: F.when(strip(x) == "", F.lit("")).otherwise(x))


def light_clean(c: Column) -> Column:
    """The cleaning used when a model gives no answer: obvious noise lines dropped, blank runs squeezed."""
    return light_joined(light_lines(c))


def light_joined(lines: Column) -> Column:
    return strip(few_blanks(F.array_join(lines, "\n")))


def clean_answer(c: Column) -> Column:
    """A model's cleaned text: no code fence; empty if it says to skip; prefiltered."""
    c = strip(text_of(c))
    c = sub(sub(c, f"\\A```[a-zA-Z]*{SPACE}*"), f"{SPACE}*```\\z")
    return F.when(c.startswith("<SKIP>"), F.lit("")).otherwise(prefilter(c))


def dedup_key(c: Column, keep_all_scripts: bool = False) -> Column:
    """Lower case, single spaces, only a-z, 0-9, Latin letters to U+024F and CJK; all letters and numbers with
    keep_all_scripts (else other scripts leave an empty key)."""
    kept = "\\p{L}\\p{M}\\p{N}" if keep_all_scripts else listed("az", "09", "Àÿ") + "Ā-ɏ一-鿿"
    # A run of what is not kept, or of white space, becomes one space; a plain space alone stays as it is.
    return F.btrim(sub(F.lower(text_of(c)), f"(?![a-z]| [a-z])(?:[^{kept} ][^{kept}]*| [^{kept}]+)", " "), F.lit(" "))


def key_hash(c: Column) -> Column:
    return F.sha1(dedup_key(c))


def prefix_key(c: Column, n: int = 500) -> Column:
    """The key of the first n characters."""
    return dedup_key(F.left(text_of(c), F.lit(n)))


def ascii_key(c: Column) -> Column:
    return strip(sub(F.lower(text_of(c)), "[^a-z0-9]+", " "))


def squeezed_key(c: Column, n: int = 500) -> Column:
    """Squeezed first, then cut: not the same as prefix_key."""
    return F.left(F.lower(squeeze(text_of(c))), F.lit(n))


def forum_text(c: Column) -> Column:
    return strip(sub(squeeze(text_of(c)), "Click to expand\\.\\.\\."))


def compact(c: Column, most: int) -> Column:
    """Single spaces, at most one blank line; cut at the last space before the limit."""
    c = strip(sub(sub(text_of(c), "[ \\t]+", " "), "\\n{3,}", "\n\n"))
    cut = F.left(c, F.lit(most))
    last = F.regexp_extract(cut, "(?s)\\A(.*) ", 1)
    return F.when(n_chars(c) <= most, c).when(F.contains(cut, F.lit(" ")), strip(last)).otherwise(strip(cut))


def safe_name(group: Column, stem: Column, most: int = 230) -> Column:
    """group__stem.txt, without characters that file systems refuse."""
    name = sub(F.concat(group, F.lit("__"), stem), "[<>:\"/\\\\|?*\\x00-\\x1f]", "_")
    return F.concat(F.left(squeeze(name), F.lit(most)), F.lit(".txt"))


def safe_stem(c: Column, most: int = 120) -> Column:
    return F.left(sub(text_of(c), "[^A-Za-z0-9._-]", "_"), F.lit(most))


# How a book's file name begins, and the subjects in such names that are of several parts.
BOOK_PREFIX = "__lib_book_"
COMPOUND_SUBJECTS = ("Dental Anatomy _ Oral Histology", "Oral Medicine _ Radiology")


def subject_of(name: Column, compound: tuple[str, ...] = COMPOUND_SUBJECTS, prefix: str = BOOK_PREFIX) -> Column:
    """The subject in a book's file name: one of several parts if listed, longest first, else what stands before
    the first "_ "; Unknown without the prefix."""
    stem = sub(name, "(?<=.)\\.[^.]*\\z")
    rest = F.substr(stem, F.lit(len(prefix) + 1))
    out = F.when(~stem.startswith(prefix), F.lit("Unknown"))
    for c in sorted(compound, key=len, reverse=True):
        out = out.when(rest.startswith(f"{c}_ "), F.lit(" ".join(c.split())))
    return out.otherwise(squeeze(F.substring_index(rest, "_ ", 1)))


def natural_key(c: Column, width: int = 12) -> Column:
    """A key under which 2 comes before 10: runs of digits padded with zeros."""
    parts = F.regexp_extract_all(F.lower(text_of(c)), F.lit("(\\p{Nd}+|\\P{Nd}+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike("\\A\\p{Nd}"), F.lpad(p, F.greatest(F.length(p), F.lit(width)), F.lit("0"))).otherwise(p)), "")


def source_prefix(c: Column) -> Column:
    return F.substring_index(c, ":", 1)


def first_filled(*cs: Column) -> Column:
    """The first that is neither null nor empty, stripped; one of white space alone is chosen and gives empty."""
    return strip(F.coalesce(*[F.nullif(c, F.lit("")) for c in cs], F.lit("")))


def no_control(c: Column) -> Column:
    """For JSON with raw control characters in it."""
    return sub(c, "[\\x00-\\x1f]", " ")


def json_payload(c: Column) -> Column:
    """The JSON object in a model's answer: without its fence, else from the first brace to the last; null if
    neither is one."""
    s = strip(sub(strip(text_of(c)), f"\\A```(?:json)?|```\\z"))
    inner = F.regexp_extract(s, "(?s)(\\{.*\\})", 1)
    good = lambda x: F.schema_of_variant(F.try_parse_json(x)).startswith("OBJECT")
    return F.when(good(s), s).when(good(F.nullif(inner, F.lit(""))), inner)


def payload_items(payload: Column, key: str) -> Column:
    """array<variant>: the objects under a key, whether it holds a list or one object; empty for anything else."""
    v = F.try_variant_get(F.try_parse_json(payload), f"$.{key}", "variant")
    kind = F.schema_of_variant(v)
    none = F.array().cast("array<variant>")
    items = F.filter(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.schema_of_variant(x).startswith("OBJECT"))
    return F.coalesce(F.when(kind.startswith("ARRAY"), items).when(kind.startswith("OBJECT"), F.array(v)), none)


def choice_of(answer: Column) -> Column:
    """The letter an answer chooses: boxed, or the first alone in the first line, or anywhere; else empty."""
    c = text_of(answer)
    alone = f"(?i)(?<!{WORD})([ABCD])(?!{WORD})"
    first = F.regexp_extract(strip(c), f"(?s)\\A(.*?)(?:{LINE_BREAK}|\\z)", 1)
    found = [F.regexp_extract(c, "(?i)\\\\boxed\\{([ABCD])\\}", 1), F.regexp_extract(first, alone, 1), F.regexp_extract(c, alone, 1)]
    return F.upper(F.coalesce(*[F.nullif(x, F.lit("")) for x in found], F.lit("")))


def _letters() -> Column:
    return F.split(F.lit("A B C D E F G H"), " ")


def mcq_question(question: Column, options: Column) -> Column:
    """The question, a blank line, and the options behind letters; null without a question, or if an option is
    empty."""
    q = strip(text_of(question))
    lettered = F.transform(options, lambda o, i: F.concat(F.get(_letters(), i), F.lit(". "), o))
    whole = (q != "") & (F.size(options) > 0) & F.forall(options, lambda o: text_of(o) != "")
    return F.when(whole, F.concat(q, F.lit("\n\n"), F.array_join(lettered, "\n")))


def mcq_answer(options: Column, index: Column, explanation: Column) -> Column:
    """The right option behind its letter, then the explanation; null where the index has no option."""
    more = strip(text_of(explanation))
    answer = F.concat(F.get(_letters(), index), F.lit(". "), strip(F.get(options, index)))
    return F.when((index >= 0) & (index < F.size(options)), F.concat(answer, F.when(more != "", F.concat(F.lit("\n\nExplanation: "), more)).otherwise(F.lit(""))))


def capitalised(c: Column) -> Column:
    """The first letter upper, the rest lower."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def labelled_context(contexts: Column, labels: Column) -> Column:
    """A line "label: text" for each pair; the longer list's rest is left out, as are empty texts."""
    n = F.least(F.size(contexts), F.size(labels))
    line = lambda a, b: F.when(text_of(b) != "", F.when(text_of(a) != "", F.concat(a, F.lit(": "), b)).otherwise(b))
    pairs = F.zip_with(F.slice(labels, F.lit(1), n), F.slice(contexts, F.lit(1), n), line)
    return F.array_join(F.array_compact(pairs), "\n")


def inverted_abstract(index: Column) -> Column:
    """The text of a map from words to their positions; of words at one position the last stays."""
    entries = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    numbered = F.transform(entries, lambda e, i: F.struct(e["p"].alias("p"), i.alias("i"), e["w"].alias("w")))

    def last(s: Column) -> Column:
        return F.filter(s, lambda e, i: (i + 1 == F.size(s)) | (F.get(s, i + 1)["p"] != e["p"]))

    return F.array_join(F.transform(let(F.sort_array(numbered), last), lambda e: e["w"]), " ")


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("annotations", "LINE_BREAK")]

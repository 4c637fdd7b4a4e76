"""Text functions against plain Python written from the survey."""

import hashlib
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marlstone.functions import predicates as P
from marlstone.functions import text as T
from marlstone.functions.expr import split_lines, strip
from marlstone.operators import blocks as B

SAMPLES = [
    None, "", "   ", "Plain text.", "two\r\nlines\rand\u2028three", "a\tb  c\n\n\n\nd", "ﬁne “quotes” – and … dots\u00a0here", "zero\u200bwidth soft\u00adhyphen \ufeffbom",
    "infor-\nmation and so-\nOn", "A dif cult ef cient of ce speci c bene t", "cited [12,34][5] and [1-3] but [abc]", "12/345\nPage 3 of 9\npage 4\nISBN 978-3\n© 2020 X\nhttp://a.b/c\nwww.x.y z\nkept",
    "Copyright 2020 by\n(c) 2020\n(c)x\nISBN-13: 978-0-00\n" + "x" * 130 + " ISBN 12345\n7\npage 12\nwww.only.url\nhttps://u r l", "head\nbody one\nhead\nbody two\nHEAD \nbody\n  head\nend", "සිංහල Кириллица é漢字", "x\x00y",
    "Smith J. Some title. Journal 1999; 12: 3-4.\n© 2019 Press\nISBN: 123\n42\n\n\nkeep this", "```json\n{\"a\": 1}\n```", "text {\"a\": [1, 2]} more", "[1, 2]", "{", "The answer is c", "\\boxed{b} or A", "\nD\nA", "no letters", "A. The first",
    "word " * 40, "One. Two! Three? " * 12, "11 22 333 words and more words to have enough of them here in a row of plain text for the count 2024 10000",
]


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame(list(enumerate(SAMPLES)), "i int, t string")


def run(samples, column):
    return [r.v for r in samples.select("i", column.alias("v")).orderBy("i").collect()]


def check(samples, column, f):
    for t, got in zip(SAMPLES, run(samples, column)):
        assert got == f(t or ""), repr(t)




def test_strip_and_lines(samples):
    check(samples, strip(F.coalesce(F.col("t"), F.lit(""))), str.strip)
    check(samples, split_lines(F.coalesce(F.col("t"), F.lit(""))), str.splitlines)


def test_clean_text(samples):
    def f(t):
        t = unicodedata.normalize("NFKC", t).replace("\r\n", "\n").replace("\r", "\n")
        return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", t)).strip()

    check(samples, T.clean_text(F.col("t")), f)


def test_clean_book(samples):
    got = dict(zip(SAMPLES, run(samples, T.clean_book(F.col("t")))))
    assert got["ﬁne “quotes” – and … dots\u00a0here"] == 'fine "quotes" - and ... dots here'
    assert got["zero\u200bwidth soft\u00adhyphen \ufeffbom"] == "zerowidth softhyphen bom"
    assert got["infor-\nmation and so-\nOn"] == "information and so-\nOn"
    assert got["A dif cult ef cient of ce speci c bene t"] == "A difficult efficient office specific benefit"
    assert got["cited [12,34][5] and [1-3] but [abc]"] == "cited and but [abc]"
    assert got[SAMPLES[11]] == "www.x.y z\nkept"
    assert got[None] == ""


OCR = [
    ("\ufeffOne\x00 two", "One two"), ("win-\r\ndow", "window"), ("Alpha-\nBeta", "AlphaBeta"), ("a line\ngoes on", "a line goes on"), ("A line\nStarts anew", "A line\nStarts anew"),
    ("ends.\nand then", "ends.\nand then"), ("many \t  blanks", "many blanks"), ("x\ry", "x y"), ("", ""), (None, ""), ("dash -\nkept", "dash -\nkept"),
]
REPEATS = [
    (4, "run\nA\nrun\nB\nRUN \nC\n  run", "A\nB\nC"), (4, "run\nA\nrun\nrun", "run\nA\nrun\nrun"), (2, "run\nA\nrun\nB", "A\nB"), (2, "ab\nab\nab", "ab\nab\nab"),
    (2, "x y\nX  Y\nz", "z"), (2, "l" * 101 + "\n" + "l" * 101, "l" * 101 + "\n" + "l" * 101), (2, "l" * 100 + "\n" + "l" * 100, ""), (4, "", ""), (4, "one\n\ntwo", "one\n\ntwo"),
]
PREFILTER = [
    ("Kept.\n12\nKept too.", "Kept.\nKept too."), ("Kept.\nPage 7\nMore.", "Kept.\nMore."), ("12345\nKept.", "12345\nKept."), ("Kept.\nhttps://a.b/c\nMore.", "Kept.\nMore."),
    ("Kept.\nWWW.A.B\nMore.", "Kept.\nMore."), ("See https://a.b for it.", "See https://a.b for it."), ("Copyright 2020\nKept.", "Kept."), ("Copyrighted\nKept.", "Copyrighted\nKept."),
    ("(C)2020\nKept.", "Kept."), ("(C) 2020\nKept.", "(C) 2020\nKept."), ("ISBN 978-3\nKept.", "Kept."), ("y" * 120 + " ISBN 978-3", "y" * 120 + " ISBN 978-3"),
    ("A.\n\n\n\n\nB.", "A.\n\nB."), ("Head\nA.\nHead\nB.\nHead\nC.\nHead", "A.\nB.\nC."), (None, ""),
]


def test_ocr_cleaning(spark):
    """Inputs and what is to come of them, written by hand."""
    got = lambda rows, column: [r.v for r in spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").select("i", column.alias("v")).orderBy("i").collect()]
    assert got([a for a, _ in OCR], T.clean_ocr(F.col("t"))) == [b for _, b in OCR]
    for times in (2, 4):
        rows = [(a, b) for n, a, b in REPEATS if n == times]
        assert got([a for a, _ in rows], T.drop_repeated_lines(F.col("t"), times)) == [b for _, b in rows]
    assert got([a for a, _ in PREFILTER], T.prefilter(F.col("t"))) == [b for _, b in PREFILTER]


def test_light_clean(samples):
    got = dict(zip(SAMPLES, run(samples, T.light_clean(F.col("t")))))
    assert got[SAMPLES[16]] == "keep this"
    assert got["a\tb  c\n\n\n\nd"] == "a\tb  c\n\nd"


def key(t):
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9À-ɏ一-鿿\s]", " ", t.lower())).strip()


def test_keys(samples):
    check(samples, T.dedup_key(F.col("t")), key)
    check(samples, T.key_hash(F.col("t")), lambda t: hashlib.sha1(key(t).encode()).hexdigest())
    check(samples, T.prefix_key(F.col("t"), 20), lambda t: key(t[:20]))
    check(samples, T.squeezed_key(F.col("t"), 20), lambda t: re.sub(r"\s+", " ", t.strip().lower())[:20])
    check(samples, T.ascii_key(F.col("t")), lambda t: re.sub(r"[^a-z0-9]+", " ", t.lower()).strip())
    assert "" not in [k for t, k in zip(SAMPLES, run(samples, T.dedup_key(F.col("t"), keep_all_scripts=True))) if t and t.startswith("සිං")]


def test_choices(samples):
    def f(t):
        if m := re.search(r"\\boxed\{([ABCD])\}", t, re.I):
            return m[1].upper()
        first = t.strip().splitlines()[0] if t.strip() else ""
        m = re.search(r"\b([ABCD])\b", first, re.I) or re.search(r"\b([ABCD])\b", t, re.I)
        return m[1].upper() if m else ""

    check(samples, T.choice_of(F.col("t")), f)


def test_json_payload(samples):
    got = dict(zip(SAMPLES, run(samples, T.json_payload(F.col("t")))))
    assert got['```json\n{"a": 1}\n```'] == '{"a": 1}' and got['text {"a": [1, 2]} more'] == '{"a": [1, 2]}'
    assert got["[1, 2]"] is None and got["{"] is None and got[None] is None


def test_names(spark):
    row = lambda col: spark.range(1).select(col.alias("v")).first().v
    l = F.lit  # noqa: E741
    assert row(T.subject_of(l("__lib_book_Oral Medicine _ Radiology_ Title.txt"))) == "Oral Medicine _ Radiology"
    assert row(T.subject_of(l("__lib_book_Surgery_ A_ B.md"))) == "Surgery" and row(T.subject_of(l("x.txt"))) == "Unknown"
    assert row(T.safe_name(l("g"), l('a<b>: "c"  d'))) == "g__a_b__ _c_ d.txt" and row(T.safe_stem(l("a b/ü"))) == "a_b__"
    keys = [row(T.natural_key(l(x))) for x in ("img2", "IMG10", "img1b", "img1")]
    assert sorted(keys) == [keys[3], keys[2], keys[0], keys[1]]
    assert row(T.first_filled(l("  "), l("b"))) == "" and row(T.first_filled(l(None).cast("string"), l(" b "))) == "b"
    assert row(T.source_prefix(l("a:b:c"))) == "a" and row(T.compact(l("one two three"), 9)) == "one two" and row(T.capitalised(l("yES"))) == "Yes"
    assert row(T.inverted_abstract(F.create_map(l("b"), F.array(l(1), l(3)), l("a"), F.array(l(0)), l("c"), F.array(l(3))))) == "a b c"
    assert row(T.labelled_context(F.array(l("x"), l(""), l("y"), l("z")), F.array(l("A"), l("B"), l("")))) == "A: x\ny"
    options = F.array(*map(l, ("w", "x", "y", "z")))
    assert row(T.mcq_question(l("Q?"), options)) == "Q?\n\nA. w\nB. x\nC. y\nD. z"
    assert row(T.mcq_answer(options, l(2), l("why"))) == "C. y\n\nExplanation: why" and row(T.mcq_answer(options, l(4), l(""))) is None
    assert row(T.mcq_question(l("Q"), F.array(l("a"), l("")))) is None


LATIN = re.compile(r"[A-Za-zÀ-ÿ]+")


def test_measures(samples):
    def density(t):
        n = len(LATIN.findall(t))
        return 1.0 if n < 20 else len(re.findall(r"\b\d{2,4}\b", t)) / n

    def diversity(t):
        w = [x.lower() for x in LATIN.findall(t)]
        return 0.0 if len(w) < 30 else len(set(w)) / len(w)

    def score(t):
        w, n = t.split(), max(1, len(t))
        if len(w) < 8:
            return 0.0
        s, k = len(w) / max(1, len(re.findall(r"[.!?]\s", t))), sum(map(len, w)) / len(w)
        a, p = sum(x.isalpha() for x in t) / n, sum(not x.isalnum() and not x.isspace() for x in t) / n
        d = len({x.lower() for x in w}) / len(w)
        out = 0.30 * (6 <= s <= 60) or 0.15 * (3 <= s <= 90)
        out += 0.20 * (3.5 <= k <= 7.5) or 0.10 * (3 <= k <= 9)
        out += 0.20 * (a > 0.6) or 0.10 * (a > 0.45)
        out += 0.15 * (p < 0.10) or 0.05 * (p < 0.18)
        out += 0.15 * (d > 0.5) or 0.08 * (d > 0.35)
        return round(out, 3)

    filled = F.coalesce(F.col("t"), F.lit(""))
    check(samples, P.page_reference_density(filled), density)
    check(samples, P.vocabulary_diversity(filled), diversity)
    check(samples, B.quality(filled), score)


def test_repeated_line_share(samples):
    def f(t):
        lines = [x for x in (" ".join(y.split()).lower() for y in t.splitlines()) if 5 <= len(x) <= 120]
        k = Counter(lines)
        return round(sum(v for v in k.values() if v >= 3) / len(lines), 4) if lines else 0.0

    check(samples, P.repeated_line_share(F.col("t")), f)


def test_filters(spark):
    row = lambda col: spark.range(1).select(col.alias("v")).first().v
    l = F.lit  # noqa: E741
    assert row(P.relevant(l("x"), l("A Tooth hurts"))) and row(P.relevant(l("gingivae"))) and not row(P.relevant(l("nothing"), l(None).cast("string")))
    assert row(P.whole_word_hits(l("gingiva and tooth, teeth"))) == 2 and row(P.headings_relevant(F.array(l("Oral Health")))) and not row(P.headings_relevant(F.array(l("Heart"))))
    assert row(P.meta_question(l("What does the chapter say?"))) and not row(P.meta_question(l("What is enamel?")))
    assert row(P.grounding(l("the enamel is hard tissue"), l("Enamel, a tissue"))) == 2 / 3 and row(P.grounding(l("the"), l("x"))) == 0
    assert row(P.divergence(l("red green"), l("red blue"))) == 1 - 1 / 3 and row(P.divergence(l(""), l("x"))) is None
    long = "enamel dentin pulp cement tissue " * 4
    args = lambda q, a, r: P.question_fault(l(q), l(a), l(r), l(long))
    other = "nothing of this kind was ever mentioned anywhere by anyone at all, really nothing whatever"
    assert row(args("short", long, other)) == "q_length" and row(args("What does the text say about it all?", long, other)) == "meta_question"
    assert row(args("Which tissue covers a whole crown?", "x", other)) == "chosen_length" and row(args("Which tissue covers a whole crown?", other, long)) == "grounding"
    assert row(args("Which tissue covers a whole crown?", long, long)) == "rejected_too_similar" and row(args("Which tissue covers a whole crown?", long, other)) == "ok"
    assert row(P.cleaning_warnings(l("x" * 100), l(""))) == ["empty", "very_low_retention"]
    assert row(P.cleaning_warnings_simple(l("x" * 10), l("Sure, here it is: x"))) == ["unexpected_growth", "assistant_preface_detected"]
    assert row(P.chunk_warnings(l("x" * 10), l("x" * 7))) == ["length_ratio_0.70"] and row(P.chunk_warnings(l("x"), l(""))) == ["empty_output"]
    assert row(P.preparation_warnings(l("x" * 10), l("![i](u)"))) == ["residual_markdown", "very_short"]


ODD_TEXTS = ["", " ", "a", " a\t\tb \n", "x\x85y　　z", " a b\xa0", "one two  three\r\n four\r\rfive", "\x1c\x1d", "Äb ç-d, e! 漢字 Ə ", "\U0001d4d0 \U0001f600  q"]


def test_white_space_as_python_has_it(spark):
    """Trimming, squeezing, counting and splitting, where most white space is one plain space and where it is not."""
    from marlstone.functions import expr as E

    c = F.col("t")
    for r in spark.createDataFrame([(t,) for t in ODD_TEXTS], "t string").select("t", E.strip(c), E.rstrip(c), E.squeeze(c), E.words(c), E.word_count(c), E.split_lines(c)).collect():
        t = r[0]
        assert list(r)[1:] == [t.strip(), t.rstrip(), " ".join(t.split()), t.split(), len(t.split()), t.splitlines()]


def test_dedup_key_of_odd_texts(spark):
    import re

    c = F.col("t")
    for r in spark.createDataFrame([(t,) for t in ODD_TEXTS], "t string").select("t", T.dedup_key(c), T.squeezed_key(c, 5)).collect():
        assert r[1] == " ".join(re.sub("[^a-z0-9À-ɏ一-鿿\\s\x1c-\x1f\x85]", " ", r[0].lower()).split())
        assert r[2] == " ".join(r[0].lower().split())[:5]


def test_characters_that_normal_form_leaves(spark):
    import re
    import unicodedata

    from marlstone.functions.text import NOT_NORMAL

    kept = [chr(x) for x in range(0x10000) if not 0xD800 <= x < 0xE000 and not re.match(NOT_NORMAL, chr(x))]
    assert len(kept) > 20_000 and unicodedata.normalize("NFKC", "".join(kept)) == "".join(kept)
    texts = ["plain", "Äé漢", "ﬁ x²", "é", "", None] * 300
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.nfkc(F.col("t"))).collect()]
    assert got == [t and unicodedata.normalize("NFKC", t) for t in texts]


@pytest.mark.parametrize("work", ["relevant", "light_clean", "clean_book", "prefilter"])
def test_work_on_text_is_a_few_passes(spark, work):
    """A megabyte of lines: the patterns of a list were tried one by one at every character, lines were trimmed for each
    rule anew, and that took from 5 to 17 seconds a core."""
    import time

    f = {"relevant": P.relevant, "light_clean": T.light_clean, "clean_book": lambda c: T.clean_book(c, False), "prefilter": T.prefilter}[work]
    line = "Verlauf und Ergebnis der langen Reihe, wie sie im Buch steht; nichts davon ist neu.\n"
    df = spark.createDataFrame([(line.replace("neu", f"neu {i}") * 300,) for i in range(80)], "t string").repartition(1).cache()
    assert df.count() == 80
    f_of = lambda n: df.limit(n).select(F.max(F.hash(f(F.col("t"))))).collect()
    f_of(10)
    began = time.perf_counter()
    f_of(40)
    assert time.perf_counter() - began < 3

"""Queries over the driver's tables, one for each operator that they can exercise, and the same in DuckDB's SQL.

Both sides spell out Unicode classes, cast counts to 64 bits and take random choices from sha1, so that they
agree to the value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import domain as D
from ..functions import predicates as P
from ..functions import text as T
from ..functions.expr import let, n_chars, spread, strip, text_of, unfold, word_count, words
from ..operators import blocks as B
from ..operators import chunking as C
from ..operators import models as M
from ..operators import reports as R
from ..operators import rows as O
from ..shipping import bounded_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The classes of functions.expr for RE2.
WS = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"[\p{L}\p{N}_]"
#: Macros that oracles begin with; DuckDB has no session for them, so they are text replaced in the SQL.
_MACROS = {
    "STRIP": rf"regexp_replace({{0}}, '^[{WS}]+|[{WS}]+$', '', 'g')",
    "SQUEEZE": rf"regexp_replace(regexp_replace({{0}}, '[{WS}]+', ' ', 'g'), '^[{WS}]+|[{WS}]+$', '', 'g')",
    "NWORDS": rf"len(regexp_extract_all({{0}}, '[^{WS}]+'))",
    "WORDS": rf"regexp_extract_all({{0}}, '[^{WS}]+')",
    "KEY": rf"regexp_replace(regexp_replace(regexp_replace(lower({{0}}), '[^a-z0-9À-ɏ一-鿿{WS}]', ' ', 'g'), '[{WS}]+', ' ', 'g'), '^[{WS}]+|[{WS}]+$', '', 'g')",
    "COUNT": "len(regexp_extract_all({0}, '{1}'))",
    "LINES": r"(CASE WHEN regexp_replace({0}, '\r\n?|[\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]', chr(10), 'g') LIKE '%' || chr(10) OR {0} = '' THEN string_split(regexp_replace({0}, '\r\n?|[\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]', chr(10), 'g'), chr(10))[:-2] ELSE string_split(regexp_replace({0}, '\r\n?|[\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]', chr(10), 'g'), chr(10)) END)",
}


def _expand(sql: str) -> str:
    """Macros of the form @NAME(argument;; argument), innermost first."""
    while True:
        at = sql.rfind("@")
        if at < 0:
            return sql
        open_ = sql.index("(", at)
        depth, end = 0, open_
        for end in range(open_, len(sql)):
            depth += (sql[end] == "(") - (sql[end] == ")")
            if not depth:
                break
        body = _MACROS[sql[at + 1 : open_]]
        for i, a in enumerate(sql[open_ + 1 : end].split(";;")):
            body = body.replace(f"{{{i}}}", a.strip())
        sql = sql[:at] + body + sql[end + 1 :]


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = _expand(sql)
        return f

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Text functions


@query(r"""
SELECT doc_id, sha1(@STRIP(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'))) AS cleaned
FROM documents
""")
def clean_text(spark, sf_dir):
    """The oracle leaves out normal form KC, which changes none of these texts."""
    return documents(spark, sf_dir).select("doc_id", F.sha1(T.clean_text(F.col("text"))).alias("cleaned"))


_BOOK = r"^[{0}]*页码[，,。:][{0}]*$|^[{0}]*Bookmark URL:.*$|^[{0}]*\p{Nd}+/\p{Nd}+[{0}]*$|^[{0}]*(?i:page)[{0}]+\p{Nd}+([{0}]+(?i:of)[{0}]+\p{Nd}+)?[{0}]*$|^[{0}]*(http|https|www)[^{0}]+[{0}]*$|^[{0}]*©.*$|^[{0}]*ISBN[{0}-]*\p{Nd}.*$".replace("{0}", WS)


@query(rf"""
WITH t AS (
  SELECT doc_id, regexp_replace(regexp_replace(translate(replace(coalesce(text, ''), '…', '...'), '‘’‚‛“”„‟–—−', repeat(chr(39), 4) || repeat(chr(34), 4) || '---'), '\r\n?', chr(10), 'g'), '({WORD})-\n([a-z])', '\1\2', 'g') AS t FROM documents
), l AS (
  SELECT doc_id, list_filter(list_transform(string_split(t, chr(10)), lambda x: regexp_replace(x, '[{WS}]+$', '')), lambda x: NOT regexp_matches(x, '{_BOOK}')) AS l FROM t
)
SELECT doc_id, len(l)::BIGINT AS n_lines,
  sha1(@STRIP(regexp_replace(array_to_string(list_transform(l, lambda x: regexp_replace(regexp_replace(x, '(\[\p{{Nd}}{{1,4}}(?:[,{WS}-]*\p{{Nd}}{{1,4}})*\])+', '', 'g'), '[ \t]+', ' ', 'g')), chr(10)), '\n{{3,}}', chr(10) || chr(10), 'g'))) AS cleaned
FROM l
""")
def normalise_lines(spark, sf_dir):
    """Book cleaning. The oracle has no ligature repairs and no removal of invisible characters: these texts have
    none."""
    cleaned = T.clean_book(F.col("text"), normal_form=False)
    lines = F.filter(F.split(text_of(F.col("text")), "\n", -1), lambda x: ~F.coalesce(x.rlike(f"\\A(?:{T.REMOVED_LINE})\\z"), F.lit(False)))
    return documents(spark, sf_dir).select("doc_id", F.size(lines).cast("long").alias("n_lines"), F.sha1(cleaned).alias("cleaned"))


_OCR = rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(coalesce(text, ''), chr(65279), ''), '\r\n?', chr(10), 'g'), '({WORD})-\n({WORD})', '\1\2', 'g'), '({WORD})-\n({WORD})', '\1\2', 'g'), '({WORD})\n([a-z])', '\1 \2', 'g'), '({WORD})\n([a-z])', '\1 \2', 'g'), '[ \t]+', ' ', 'g')"
_REPEATED = rf"""
t AS (SELECT doc_id, {_OCR} AS t FROM documents),
l AS (SELECT doc_id, unnest(@LINES(t)) AS line, generate_subscripts(@LINES(t), 1) AS pos FROM t),
n AS (SELECT *, lower(@SQUEEZE(line)) AS norm FROM l),
c AS (SELECT *, count(*) OVER (PARTITION BY doc_id, norm) AS times FROM n)
"""


@query(rf"""
WITH {_REPEATED}, k AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS kept, count(*) AS n FROM c WHERE NOT (length(norm) BETWEEN 3 AND 100 AND times >= 4) GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_lines, sha1(coalesce(kept, '')) AS kept FROM t LEFT JOIN k USING (doc_id)
""")
def drop_repeated_lines(spark, sf_dir):
    kept = T.drop_repeated_lines(T.clean_ocr(F.col("text")))
    n = F.when(kept == "", F.lit(0)).otherwise(F.size(F.split(kept, "\n", -1)))
    return documents(spark, sf_dir).select("doc_id", n.cast("long").alias("n_lines"), F.sha1(kept).alias("kept"))


@query(rf"""
WITH {_REPEATED}, s AS (SELECT *, @STRIP(line) AS s FROM c WHERE NOT (length(norm) BETWEEN 3 AND 100 AND times >= 4)), k AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS kept FROM s
  WHERE NOT (regexp_matches(s, '^(?i:(page[{WS}]*)?\p{{Nd}}{{1,4}})$') OR regexp_matches(s, '^(?i:(https?://|www\.)[^{WS}]+)$')
    OR regexp_matches(s, '^(?:(?i:copyright)($|[^\p{{L}}\p{{N}}_])|(\([cC]\)|©){WORD})') OR (regexp_matches(s, '(^|[^\p{{L}}\p{{N}}_])ISBN(-1[03])?[{WS}:]*[\p{{Nd}}\-Xx]+') AND length(s) < 120))
  GROUP BY doc_id
)
SELECT doc_id, sha1(@STRIP(regexp_replace(coalesce(kept, ''), '\n{{3,}}', chr(10) || chr(10), 'g'))) AS cleaned FROM t LEFT JOIN k USING (doc_id)
""")
def prefilter_lines(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.sha1(T.prefilter(F.col("text"))).alias("cleaned"))


@query(r"""
WITH l AS (SELECT doc_id, unnest(@LINES(coalesce(text, ''))) AS line FROM documents),
n AS (SELECT doc_id, lower(@SQUEEZE(line)) AS norm FROM l), k AS (SELECT doc_id, norm, count(*) AS n FROM n WHERE length(norm) BETWEEN 5 AND 120 GROUP BY ALL),
f AS (SELECT doc_id, sum(CASE WHEN n >= 3 THEN n ELSE 0 END) / sum(n)::DOUBLE AS f FROM k GROUP BY doc_id)
SELECT doc_id, round_even(coalesce(f, 0.0::DOUBLE), 4) AS fraction FROM documents LEFT JOIN f USING (doc_id)
""")
def repeated_line_fraction(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", P.repeated_line_share(F.col("text")).alias("fraction"))


@query("""SELECT doc_id, @KEY(coalesce(text, '')) = '' AS is_empty, sha1(@KEY(coalesce(text, ''))) AS key_hash, sha1(@KEY(left(coalesce(text, ''), 500))) AS prefix_hash,
  sha1(left(regexp_replace(lower(@STRIP(coalesce(text, ''))), '[\\t-\\r\\x1c-\\x20\\x85\\xa0]+', ' ', 'g'), 500)) AS squeezed_hash FROM documents""")
def dedup_keys(spark, sf_dir):
    c = F.col("text")
    keys = documents(spark, sf_dir).select("doc_id", T.dedup_key(c).alias("key"), T.prefix_key(c).alias("prefix"), T.squeezed_key(c).alias("squeezed"))
    return keys.select("doc_id", (F.col("key") == "").alias("is_empty"), *[F.sha1(k).alias(f"{k}_hash") for k in ("key", "prefix", "squeezed")])


# Filters and measures


def _alternatives(patterns) -> str:
    """Patterns with \\b at both ends as one for RE2, the edges spelled out around all of them."""
    inner = "|".join(p.removeprefix("\\b").removesuffix("\\b").replace("\\w", WORD) for p in patterns)
    return rf"(?i)(^|[^\p{{L}}\p{{N}}_])({inner})($|[^\p{{L}}\p{{N}}_])"


@query(f"""
SELECT doc_id, coalesce(regexp_matches(text, '{_alternatives(D.RELEVANT)}'), false) AS field, coalesce(regexp_matches(text, '{_alternatives((r"\b the\w*\b".replace(" ", ""), r"\bverla\w*\b", r"\bstre\b"))}'), false) AS common FROM documents
""")
def keyword_relevance(spark, sf_dir):
    """The field's patterns, which these texts hardly have, and three that they have."""
    patterns = (r"\bthe\w*\b", r"\bverla\w*\b", r"\bstre\b")
    c = F.col("text")
    return documents(spark, sf_dir).select("doc_id", P.relevant(c).alias("field"), P.relevant(c, patterns=patterns).alias("common"))


def _whole_words(terms) -> str:
    return f"@COUNT(regexp_replace(lower(coalesce(text, '')), '([^\\p{{L}}\\p{{N}}_])', '\\1\\1', 'g');; (^|[^\\p{{L}}\\p{{N}}_])({'|'.join(terms).replace(' ', '  ')})($|[^\\p{{L}}\\p{{N}}_]))::BIGINT"


@query(f"SELECT doc_id, {_whole_words(D.WHOLE_WORDS)} AS field, {_whole_words(('and', 'the', 'in'))} AS common FROM documents")
def keyword_ge2(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", P.whole_word_hits(F.col("text")).alias("field"), P.whole_word_hits(F.col("text"), ("and", "the", "in")).alias("common"))


_LATIN = "@COUNT(text;; [A-Za-zÀ-ÿ]+)"
_DIVERSITY = "CASE WHEN len(regexp_extract_all(lower(text), '[a-zà-ÿ]+')) < 30 THEN 0.0::DOUBLE ELSE len(list_distinct(regexp_extract_all(lower(text), '[a-zà-ÿ]+')))::DOUBLE / len(regexp_extract_all(lower(text), '[a-zà-ÿ]+')) END"
_PAGES = rf"CASE WHEN {_LATIN} < 20 THEN 1.0::DOUBLE ELSE @COUNT(regexp_replace(text, '([^\p{{L}}\p{{N}}_])', '\1\1', 'g');; (^|[^\p{{L}}\p{{N}}_])\p{{Nd}}{{2,4}}($|[^\p{{L}}\p{{N}}_]))::DOUBLE / {_LATIN} END"


@query(f"SELECT doc_id, {_DIVERSITY} AS diversity, {_PAGES} AS page_density FROM documents")
def vocab_and_page_density(spark, sf_dir):
    c = F.col("text")
    return documents(spark, sf_dir).select("doc_id", P.vocabulary_diversity(c).alias("diversity"), P.page_reference_density(c).alias("page_density"))


_QUALITY = rf"""
CASE WHEN nw < 8 THEN 0.0::DOUBLE ELSE (
  CASE WHEN nw / ns BETWEEN 6 AND 60 THEN 30 WHEN nw / ns BETWEEN 3 AND 90 THEN 15 ELSE 0 END
  + CASE WHEN nc / nw BETWEEN 3.5 AND 7.5 THEN 20 WHEN nc / nw BETWEEN 3 AND 9 THEN 10 ELSE 0 END
  + CASE WHEN na / n > 0.6::DOUBLE THEN 20 WHEN na / n > 0.45::DOUBLE THEN 10 ELSE 0 END
  + CASE WHEN np / n < 0.10::DOUBLE THEN 15 WHEN np / n < 0.18::DOUBLE THEN 5 ELSE 0 END
  + CASE WHEN nd / nw > 0.50::DOUBLE THEN 15 WHEN nd / nw > 0.35::DOUBLE THEN 8 ELSE 0 END) / 100.0::DOUBLE END
"""
_MEASURES = rf"""
SELECT doc_id, source, text, greatest(length(text), 1)::DOUBLE AS n, @NWORDS(text)::DOUBLE AS nw, greatest(@COUNT(text;; [.!?][{WS}]), 1)::DOUBLE AS ns, @COUNT(text;; [^{WS}])::DOUBLE AS nc,
  @COUNT(text;; \p{{L}})::DOUBLE AS na, @COUNT(text;; [^\p{{L}}\p{{N}}{WS}])::DOUBLE AS np, len(list_distinct(@WORDS(lower(text))))::DOUBLE AS nd FROM documents
"""


@query(f"WITH m AS ({_MEASURES}) SELECT doc_id, {_QUALITY} AS quality FROM m")
def quality_score(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", B.quality(F.col("text")).alias("quality"))


@query(rf"""
WITH m AS ({_MEASURES}) SELECT doc_id, CASE WHEN length(text) < 200 OR nw < 30 OR na / n < 0.55::DOUBLE OR np / n > 0.25::DOUBLE THEN 0.0::DOUBLE
  WHEN NOT nc / nw BETWEEN 3.2 AND 9 THEN 0.3::DOUBLE ELSE 0.8::DOUBLE END AS quality FROM m
""")
def answer_quality(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", P.answer_quality(F.col("text")).alias("quality"))


@query(rf"""
WITH m AS ({_MEASURES}), q AS (SELECT doc_id, text, {_QUALITY} AS quality FROM m), r AS (
  SELECT doc_id, text, CASE WHEN length(text) < 400 THEN 'short' WHEN quality < 0.75::DOUBLE THEN 'quality' WHEN length(text) < 3000 AND {_PAGES} > 0.10::DOUBLE THEN 'index'
    WHEN {_DIVERSITY} < 0.30::DOUBLE THEN 'diversity' END AS reason FROM q
), d AS (
  SELECT reason, CASE WHEN reason IS NULL AND row_number() OVER (PARTITION BY reason, left(regexp_replace(lower(@STRIP(text)), '[{WS}]+', ' ', 'g'), 500) ORDER BY doc_id) > 1 THEN 'duplicate' ELSE coalesce(reason, 'kept') END AS outcome FROM r
)
SELECT outcome, count(*) AS n FROM d GROUP BY outcome
""")
def postfilter_cascade(spark, sf_dir):
    c = F.col("text")
    rows = documents(spark, sf_dir).select(P.drop_reason(c, B.quality(c)).alias("reason"), F.sha1(T.squeezed_key(c)).alias("key"))
    # Of the rows without a reason, the first of each key stays: how many keys there are says how many do.
    groups = rows.groupBy("reason", F.when(F.col("reason").isNull(), F.col("key")).alias("key")).agg(F.count("*").alias("n"))
    outcome = lambda name, n: F.struct(name.alias("outcome"), n.cast("long").alias("n"))
    split = F.when(F.col("reason").isNull(), F.array(outcome(F.lit("kept"), F.lit(1)), outcome(F.lit("duplicate"), F.col("n") - 1))).otherwise(F.array(outcome(F.col("reason"), F.col("n"))))
    return groups.select(F.explode(split).alias("x")).groupBy("x.outcome").agg(F.sum("x.n").alias("n")).where("n > 0")


_PAIRS = """
WITH p AS (SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 AND u.role = 'user' AND a.role = 'assistant')
"""


def chat_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's turn with the assistant's turn after it."""
    c = table(spark, sf_dir, "conversations")
    u = c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    a = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return u.join(a, ["conv_id", "turn"])


_TOKENS = "list_distinct(list_filter(regexp_extract_all(lower({0}), '[a-zà-ÿ][a-zà-ÿ\\-]+'), lambda w: length(w) > 2 AND w NOT IN ({1})))"


def _tokens(c: str) -> str:
    from ..functions.domain import STOPWORDS

    return _TOKENS.format(c, ", ".join(f"'{w}'" for w in STOPWORDS))


@query(f"""{_PAIRS}, t AS (SELECT conv_id, turn, {_tokens("question")} AS q, {_tokens("answer")} AS a FROM p)
SELECT conv_id, turn, CASE WHEN len(a) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect(a, q))::DOUBLE / len(a) END AS grounding,
  CASE WHEN len(a) > 0 AND len(q) > 0 THEN 1 - len(list_intersect(a, q))::DOUBLE / (len(a) + len(q) - len(list_intersect(a, q))) END AS divergence FROM t""")
def grounding_and_divergence(spark, sf_dir):
    q, a = F.col("question"), F.col("answer")
    return chat_pairs(spark, sf_dir).select("conv_id", "turn", P.grounding(a, q).alias("grounding"), P.divergence(a, q).alias("divergence"))


@query(f"""{_PAIRS}, w AS (SELECT conv_id, turn, question, answer, length(@STRIP(question)) AS lq, length(@STRIP(answer)) AS la, @NWORDS(answer) AS nw FROM p)
SELECT conv_id, turn, lq >= 12 AND la >= 40 AND nw BETWEEN 20 AND 200 AS instruction,
  lq >= 12 AND la >= 40 AND lq >= 20 AND @STRIP(regexp_replace(lower(answer), '[^a-z0-9]+', ' ', 'g')) <> @STRIP(regexp_replace(lower(question), '[^a-z0-9]+', ' ', 'g')) AND nw BETWEEN 20 AND 220 AS preference FROM w""")
def generated_rows(spark, sf_dir):
    q, a = F.col("question"), F.col("answer")
    return chat_pairs(spark, sf_dir).select("conv_id", "turn", P.good_instruction(q, a, 20, 200).alias("instruction"), P.good_preference(q, a, q, 20, 220).alias("preference"))


# Segments and chunks


@query(rf"""
WITH p AS (SELECT page_id, string_split(regexp_replace(html, '<[^>]+>', chr(10), 'g'), chr(10)) AS l FROM pages),
l AS (SELECT page_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM p), b AS (SELECT *, @STRIP(line) = '' AS blank FROM l),
g AS (SELECT *, sum(blank::INTEGER) OVER (PARTITION BY page_id ORDER BY pos) AS grp FROM b)
SELECT page_id, min(pos)::INTEGER AS line_start, max(pos)::INTEGER AS line_end, sha1(string_agg(line, chr(10) ORDER BY pos)) AS block FROM g WHERE NOT blank GROUP BY page_id, grp
""")
def block_segments(spark, sf_dir):
    text = F.regexp_replace("html", "<[^>]+>", "\n")
    b = unfold(spread(table(spark, sf_dir, "pages")), ["page_id"], B.segment(text), "i", "b")
    return b.select("page_id", "b.line_start", "b.line_end", F.sha1(F.array_join("b.lines", "\n")).alias("block"))


@query(rf"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), s AS (SELECT doc_id, @STRIP(line) AS s FROM l WHERE @STRIP(line) <> ''),
f AS (SELECT doc_id, length(s) AS len, @NWORDS(s) AS words, @COUNT(s;; \p{{Nd}})::DOUBLE / greatest(length(s), 1) AS digits, @COUNT(s;; \p{{L}})::DOUBLE / greatest(length(s), 1) AS alpha,
  @COUNT(s;; \p{{Lu}})::DOUBLE / greatest(@COUNT(s;; \p{{L}}), 1) AS upper, regexp_matches(s, '\p{{Nd}}$') AS ends_digit FROM s)
SELECT doc_id, count(*) AS n, median(len)::DOUBLE AS median_len, round(avg(words), 9) AS mean_words, round(avg((len < 30)::INTEGER), 9) AS short_ratio, round(avg(ends_digit::INTEGER), 9) AS ends_digit_ratio,
  round(avg(digits), 9) AS mean_digit_ratio, round(avg(alpha), 9) AS mean_alpha_ratio, round(avg(upper), 9) AS mean_upper_ratio FROM f GROUP BY doc_id
""")
def block_features(spark, sf_dir):
    lines = F.filter(F.split("text", "\n", -1), lambda x: strip(x) != "")
    f = documents(spark, sf_dir).select("doc_id", B.block_features(lines).alias("f")).where("f.n > 0")
    means = ("mean_words", "short_ratio", "ends_digit_ratio", "mean_digit_ratio", "mean_alpha_ratio", "mean_upper_ratio")
    return f.select("doc_id", "f.n", "f.median_len", *[F.round(F.col(f"f.{m}"), 9).alias(m) for m in means])


@query()
def block_classes(spark, sf_dir):
    """Blocks of the pages with their classes; the classes carry state from block to block."""
    b = unfold(spread(table(spark, sf_dir, "pages")), ["page_id"], B.classified(F.regexp_replace("html", "<[^>]+>", "\n")), "i", "b")
    return b.select("page_id", "b.line_start", "b.line_end", "b.tag", "b.reason", "b.quality")


@query()
def prose_chunks(spark, sf_dir):
    chunks = B.process(documents(spark, sf_dir), target=3000, least=200)["chunks"]
    return chunks.select("book", "chunk_idx", "line_start", "line_end", "n_blocks", "quality", F.sha1("text").alias("chunk"))


@query("""
WITH w AS (SELECT doc_id, @WORDS(coalesce(text, '')) AS w FROM documents), n AS (SELECT *, greatest(0, ceil((len(w) - 800) / 680.0))::BIGINT + 1 AS n FROM w WHERE len(w) > 0),
i AS (SELECT doc_id, w, unnest(range(n)) AS i FROM n)
SELECT doc_id, i AS chunk_index, len(w[i * 680 + 1 : i * 680 + 800])::BIGINT AS word_count, sha1(array_to_string(w[i * 680 + 1 : i * 680 + 800], ' ')) AS chunk FROM i
""")
def chunk_words_sliding(spark, sf_dir):
    c = unfold(documents(spark, sf_dir), ["doc_id"], C.word_windows(F.col("text")), "chunk_index", "c")
    return c.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), word_count(F.col("c")).alias("word_count"), F.sha1("c").alias("chunk"))


def _lines_as_paragraphs(c):
    return F.replace(c, F.lit("\n"), F.lit("\n\n"))


_PARAGRAPHS = "list_filter(list_transform(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)), lambda p: @STRIP(p)), lambda p: p <> '')"


@query(f"""
WITH RECURSIVE p AS (SELECT doc_id, {_PARAGRAPHS} AS p FROM documents), f AS (
  SELECT doc_id, p, 1::BIGINT AS i, 0::BIGINT AS run, @NWORDS(p[1])::BIGINT AS len FROM p WHERE len(p) > 0
  UNION ALL
  SELECT doc_id, p, i + 1, CASE WHEN len + @NWORDS(p[i + 1]) > 60 THEN run + 1 ELSE run END, CASE WHEN len + @NWORDS(p[i + 1]) > 60 THEN @NWORDS(p[i + 1]) ELSE len + @NWORDS(p[i + 1]) END FROM f WHERE i < len(p)
)
SELECT doc_id, run AS chunk_index, sha1(string_agg(p[i], chr(10) || chr(10) ORDER BY i)) AS chunk FROM f GROUP BY doc_id, run
""")
def chunk_greedy_words(spark, sf_dir):
    """Lines stand for paragraphs: these texts have no blank lines."""
    c = unfold(documents(spark, sf_dir), ["doc_id"], C.paragraphs_by_words(_lines_as_paragraphs(F.col("text")), 60), "i", "c")
    return c.select("doc_id", F.col("i").cast("long").alias("chunk_index"), F.sha1("c").alias("chunk"))


@query(f"""
WITH RECURSIVE p AS (SELECT doc_id, {_PARAGRAPHS} AS p FROM documents), f AS (
  SELECT doc_id, p, 1::BIGINT AS i, 0::BIGINT AS run, length(p[1])::BIGINT AS len FROM p WHERE len(p) > 0
  UNION ALL
  SELECT doc_id, p, i + 1, CASE WHEN len + length(p[i + 1]) + 2 > 3000 AND len >= 300 THEN run + 1 ELSE run END,
    CASE WHEN len + length(p[i + 1]) + 2 > 3000 AND len >= 300 THEN length(p[i + 1]) ELSE len + length(p[i + 1]) + 2 END FROM f WHERE i < len(p)
), c AS (SELECT doc_id, run, string_agg(p[i], chr(10) || chr(10) ORDER BY i) AS c FROM f GROUP BY doc_id, run)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY run) - 1)::BIGINT AS chunk_index, sha1(c) AS chunk FROM c WHERE length(c) >= 300
""")
def chunk_sections(spark, sf_dir):
    c = unfold(documents(spark, sf_dir), ["doc_id"], C.sections(_lines_as_paragraphs(F.col("text"))), "i", "c")
    return c.select("doc_id", F.col("i").cast("long").alias("chunk_index"), F.sha1("c").alias("chunk"))


@query()
def chunk_greedy_chars(spark, sf_dir):
    c = unfold(documents(spark, sf_dir), ["doc_id"], C.paragraphs_by_chars(_lines_as_paragraphs(F.col("text")), 700), "i", "c")
    return c.select("doc_id", F.col("i").cast("long").alias("chunk_index"), F.char_length("c").cast("long").alias("chars"), F.sha1("c").alias("chunk"))


@query("""
WITH w AS (SELECT doc_id, list_append(@WORDS(text), '</s>') AS w FROM documents), u AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM w),
n AS (SELECT token, row_number() OVER (ORDER BY doc_id, pos) - 1 AS i FROM u)
SELECT (i // 512)::BIGINT AS block, sha1(string_agg(token, ' ' ORDER BY i)) AS tokens FROM n GROUP BY i // 512 HAVING count(*) = 512
""")
def pack_tokens(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", F.array_append(words(F.col("text")), F.lit("</s>")).alias("w"))
    return C.pack_tokens(d, "doc_id", "w", 512).select("block", F.sha1(F.array_join("tokens", " ")).alias("tokens"))


@query("""
WITH RECURSIVE r AS (SELECT source, doc_id, @STRIP(text) AS t, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents WHERE @STRIP(coalesce(text, '')) <> ''),
f AS (
  SELECT source, n, t, 0::BIGINT AS idx, length(t)::BIGINT + 1 AS size FROM r WHERE n = 1
  UNION ALL
  SELECT r.source, r.n, r.t, CASE WHEN f.size >= 5000 THEN f.idx + 1 ELSE f.idx END, CASE WHEN f.size >= 5000 THEN length(r.t) + 1 ELSE f.size + length(r.t) + 1 END FROM f JOIN r ON r.source IS NOT DISTINCT FROM f.source AND r.n = f.n + 1
)
SELECT source, idx AS chunk_idx, count(*) AS n_rows, sha1(string_agg(t, ' ' ORDER BY n)) AS chunk FROM f GROUP BY source, idx
""")
def running_concat(spark, sf_dir):
    c = C.running_concat(documents(spark, sf_dir).select("source", "doc_id", "text"), "source", "doc_id", target=5000)
    return c.select("source", "chunk_idx", "n_rows", F.sha1("text").alias("chunk"))


# Joins and deduplication


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text")
def dedup_exact(spark, sf_dir):
    return documents(spark, sf_dir).groupBy(F.sha1("text").alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).drop("h")


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY sha1(@KEY(text)) ORDER BY doc_id) = 1")
def dedup_norm(spark, sf_dir):
    return O.first_wins(documents(spark, sf_dir), T.key_hash(F.col("text")), "doc_id").select("doc_id", "source")


@query("""SELECT doc_id, source FROM documents WHERE length(@STRIP(text)) >= 50 QUALIFY row_number() OVER (PARTITION BY sha1(@KEY(left(@STRIP(text), 500))) ORDER BY doc_id) = 1""")
def dedup_prefix_first_wins(spark, sf_dir):
    rows = O.coerce_cpt(documents(spark, sf_dir).withColumn("ord", F.col("doc_id")))
    return O.first_wins(rows, F.sha1(T.prefix_key(F.col("text"))), "ord").select(F.col("ord").alias("doc_id"), "source")


@query("SELECT doc_id FROM documents WHERE sha1(@KEY(text)) NOT IN (SELECT sha1(@KEY(text)) FROM documents WHERE source = 'src0')")
def anti_join_seen(spark, sf_dir):
    d = documents(spark, sf_dir)
    return O.unseen(d, d.where("source = 'src0'"), T.key_hash(F.col("text")), T.key_hash(F.col("text"))).select("doc_id")


@query("SELECT d.doc_id, d.source, l.quality, coalesce(CASE WHEN l.toxic = 1 THEN 'toxic' END, d.lang) AS label FROM documents d LEFT JOIN labels l USING (doc_id)")
def overlay_labels(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", "source", F.col("lang").alias("label"))
    l = table(spark, sf_dir, "labels")
    new = l.select("doc_id", F.when(F.col("toxic") == 1, "toxic").alias("label"))
    return O.overlay(d, new, "doc_id", "label").join(l.select("doc_id", "quality"), "doc_id", "left").select("doc_id", "source", "quality", "label")


@query("""
WITH t AS (SELECT conv_id, min(turn) FILTER (role = 'user') AS u, min(turn) FILTER (role = 'assistant') AS a FROM conversations GROUP BY conv_id),
f AS (SELECT t.conv_id, @STRIP((SELECT min(text) FROM conversations c WHERE c.conv_id = t.conv_id AND c.turn = t.u AND c.role = 'user')) AS question,
  @STRIP((SELECT min(text) FROM conversations c WHERE c.conv_id = t.conv_id AND c.turn = t.a AND c.role = 'assistant')) AS answer FROM t)
SELECT * FROM f WHERE question <> '' AND answer <> ''
""")
def chat_first_turns(spark, sf_dir):
    from ..sources.records import first_message

    null = F.lit(None).cast("string")
    message = F.struct("turn", "text", F.col("role").alias("role"), null.alias("from"), F.col("text").alias("content"), null.alias("value"))
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(message)).alias("m"))
    return c.select("conv_id", first_message(F.col("m"), ("user",)).alias("question"), first_message(F.col("m"), ("assistant",)).alias("answer")).where("question <> '' and answer <> ''")


@query(f"""{_PAIRS}, s AS (SELECT conv_id, turn, @STRIP(coalesce(question, '')) AS question, @STRIP(coalesce(answer, '')) AS answer FROM p)
SELECT conv_id * 1000 + turn AS ord, question, answer, 'chat:' || conv_id AS source, 'Dentistry' AS topic FROM s WHERE length(question) >= 10 AND length(answer) >= 20
QUALIFY row_number() OVER (PARTITION BY sha1(@KEY(question)) ORDER BY conv_id * 1000 + turn) = 1""")
def sft_from_chat(spark, sf_dir):
    rows = chat_pairs(spark, sf_dir).select("question", "answer", F.concat(F.lit("chat:"), F.col("conv_id").cast("string")).alias("source"), (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"))
    return O.first_wins(O.coerce_sft(rows), T.key_hash(F.col("question")), "ord").select("ord", "question", "answer", "source", "topic")


@query(f"""{_PAIRS}, k AS (SELECT conv_id, turn, question AS prompt, answer AS chosen, reverse(answer) AS rejected FROM p)
SELECT conv_id, turn, length(@STRIP(chosen))::BIGINT AS chosen_chars FROM k WHERE length(@STRIP(prompt)) >= 10 AND length(@STRIP(chosen)) >= 20 AND length(@STRIP(rejected)) >= 20""")
def valid_dpo(spark, sf_dir):
    rows = chat_pairs(spark, sf_dir).select(F.struct("conv_id", "turn").alias("ord"), F.col("question").alias("prompt"), F.col("answer").alias("chosen"), F.reverse("answer").alias("rejected"))
    return O.coerce_dpo(rows).select("ord.conv_id", "ord.turn", n_chars(F.col("chosen")).alias("chosen_chars"))


# Splits, samples and schedules


@query("""WITH n AS (SELECT greatest(1, floor(count(*) * 0.05))::BIGINT AS n FROM documents)
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY sha1('42:' || doc_id)) <= (SELECT n FROM n) THEN 'val' ELSE 'train' END AS split FROM documents""")
def split_train_val(spark, sf_dir):
    return O.split_train_val(documents(spark, sf_dir).select("doc_id"), "doc_id")


@query("""WITH s AS (SELECT source, row_number() OVER (ORDER BY sha1('42:' || source)) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT source FROM documents))
SELECT doc_id, source, CASE WHEN r <= least(n - 1, greatest(1, round_even(n * 0.1, 0))) THEN 'val' ELSE 'train' END AS split FROM documents JOIN s USING (source)""")
def split_by_source(spark, sf_dir):
    return O.split_by_group(documents(spark, sf_dir).select("doc_id", "source"), "source", 0.1)


@query("""WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha1('42:' || doc_id)) AS r, count(*) OVER (PARTITION BY source) AS n FROM documents)
SELECT doc_id, source, CASE WHEN n >= 3 AND r <= least(greatest(1, round_even(n * 0.08::DOUBLE, 0)), 3, n - 1) THEN 'val' ELSE 'train' END AS split FROM r""")
def split_stratified(spark, sf_dir):
    return O.split_stratified(documents(spark, sf_dir).select("doc_id", "source"), "source", "doc_id", most=3)


@query("SELECT doc_id FROM documents ORDER BY sha1('42:' || doc_id) LIMIT 50")
def uniform_sample(spark, sf_dir):
    return O.sample(documents(spark, sf_dir).select("doc_id"), "doc_id", 50)


@query("WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () // 20 AS step FROM documents) SELECT doc_id FROM n WHERE i % step = 0 AND i < step * 20")
def sample_every_nth(spark, sf_dir):
    return O.every_nth(documents(spark, sf_dir).select("doc_id"), "doc_id", 20)


@query("""WITH c AS (SELECT doc_id, CASE WHEN source = 'src0' THEN 2 + (('0x' || substr(sha1('42:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < 0.5)::INTEGER ELSE 1 END AS n FROM documents)
SELECT doc_id, unnest(range(n))::INTEGER AS copy FROM c""")
def oversample(spark, sf_dir):
    return O.oversample(documents(spark, sf_dir).select("doc_id", "source"), "source", "src0", 2.5, "doc_id").select("doc_id", "copy")


@query("""WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha1('42:' || source || ':' || doc_id)) - 1 AS turn FROM documents)
SELECT doc_id, turn, sha1('42:' || source || ':' || turn) AS place FROM r""")
def round_robin(spark, sf_dir):
    return O.round_robin(documents(spark, sf_dir).select("doc_id", "source"), "source", "doc_id").select("doc_id", "turn", "place")


@query("""WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, @NWORDS(text) AS w FROM documents)
SELECT doc_id, CASE WHEN i % 20 < 8 THEN 'clinical_student' WHEN i % 20 < 13 THEN 'patient_friendly' WHEN i % 20 < 17 THEN 'exam_reasoning' WHEN i % 20 < 19 THEN 'differential_comparison' ELSE 'safety_referral' END AS style,
  greatest(1, least(6, round_even(w / 250.0::DOUBLE, 0)))::INTEGER AS target FROM n""")
def task_styles(spark, sf_dir):
    d = documents(spark, sf_dir)
    ids = O.numbered(d.select("doc_id"), "doc_id", "i")
    return d.select("doc_id", "text").join(ids, "doc_id").select("doc_id", O.task_style(F.col("i")).alias("style"), O.targets(word_count(F.col("text")), 250, 1, 6).alias("target"))


# Reports


@query("""SELECT source, count(*) AS n, sum(length(text))::BIGINT AS chars, sum(@NWORDS(text))::BIGINT AS words, sum(length(text))::DOUBLE / count(*) AS mean_chars, sum(length(text)) / 4.0::DOUBLE AS est_tokens, grouping(source)::BIGINT AS is_total
FROM documents GROUP BY ROLLUP (source)""")
def corpus_stats(spark, sf_dir):
    return R.corpus_stats(documents(spark, sf_dir), "source")


@query("SELECT source, count(*) AS n, min(doc_id) AS first_seen FROM documents GROUP BY source ORDER BY n DESC, first_seen LIMIT 5")
def topk_sources(spark, sf_dir):
    return R.top_k(documents(spark, sf_dir), "source", 5, "doc_id")


@query("SELECT lang, source, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents GROUP BY ROLLUP (lang, source)")
def lang_rollup(spark, sf_dir):
    return documents(spark, sf_dir).select("lang", "source", n_chars(F.col("text")).alias("c")).rollup("lang", "source").agg(F.count("*").alias("n"), F.sum("c").alias("chars"))


_KEYS = _PAIRS.strip() + ", k AS (SELECT sha1(@KEY(question)) AS q, sha1(left(@KEY(answer), 300)) AS a, 'chat' || (conv_id % 3) AS source FROM p WHERE question <> '' AND answer <> '')"


def _keys(spark, sf_dir):
    """Whole questions; of answers the first 300 characters of their keys, as the report compares them."""
    return R.pair_keys(chat_pairs(spark, sf_dir).withColumn("source", F.concat(F.lit("chat"), (F.col("conv_id") % 3).cast("string"))))


@query(f"""{_KEYS}, c AS (SELECT q, a, count(*) AS n FROM k GROUP BY q, a), g AS (SELECT q, sum(n) AS n, count(*) AS answers, sum(n - 1) AS extra FROM c GROUP BY q)
SELECT sum(n)::BIGINT AS n_rows, count(*) AS distinct_questions, sum(n - 1)::BIGINT AS repeated_question_extras, sum(answers)::BIGINT AS distinct_pairs, sum(extra)::BIGINT AS duplicate_pair_extras,
  count(*) FILTER (answers > 1) AS contradictions, round(sum(n - 1) * 100.0::DOUBLE / sum(n), 2) AS duplication_rate_pct, round(sum(extra) * 100.0::DOUBLE / sum(n), 2) AS pair_duplication_rate_pct FROM g""")
def dup_report(spark, sf_dir):
    return R.duplicate_report(_keys(spark, sf_dir))


@query(f"""{_KEYS}, g AS (SELECT count(*) AS n FROM k GROUP BY q)
SELECT CASE WHEN n = 1 THEN '1' WHEN n = 2 THEN '2' WHEN n <= 5 THEN '3-5' WHEN n <= 10 THEN '6-10' ELSE '>10' END AS bucket, count(*) AS questions FROM g GROUP BY 1""")
def multiplicity_buckets(spark, sf_dir):
    return R.multiplicities(_keys(spark, sf_dir))


@query(f"{_KEYS} SELECT q, count(DISTINCT a) AS answers, count(DISTINCT source) AS sources FROM k GROUP BY q HAVING count(DISTINCT a) > 1")
def contradictions(spark, sf_dir):
    return R.contradictions(_keys(spark, sf_dir))


_RATIO = "length(t2)::DOUBLE / greatest(length(text), 1)"


@query(rf"""
WITH c AS (SELECT doc_id, text, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN left(text, length(text) // 3) WHEN doc_id % 5 = 2 THEN left(text, length(text) // 2) || '<SKIP>' WHEN doc_id % 5 = 3 THEN 'Here is the cleaned ' || text || text ELSE '' END AS t2 FROM documents),
l AS (SELECT doc_id, unnest(@LINES(coalesce(t2, ''))) AS line FROM c), k AS (SELECT doc_id, lower(@SQUEEZE(line)) AS norm, count(*) AS n FROM l GROUP BY ALL HAVING length(lower(@SQUEEZE(line))) BETWEEN 5 AND 120),
f AS (SELECT doc_id, sum(CASE WHEN n >= 3 THEN n ELSE 0 END) / sum(n)::DOUBLE AS f FROM k GROUP BY doc_id), w AS (
  SELECT list_filter([CASE WHEN t2 IS NULL THEN 'missing_cleaned' END, CASE WHEN @STRIP(t2) = '' THEN 'empty' END, CASE WHEN {_RATIO} < 0.35::DOUBLE THEN 'very_low_retention' WHEN {_RATIO} < 0.55::DOUBLE THEN 'low_retention_review' END,
    CASE WHEN {_RATIO} > 1.08::DOUBLE THEN 'unexpected_growth' END, CASE WHEN t2 IS NOT NULL AND round_even(coalesce(f, 0), 4) > 0.08::DOUBLE THEN 'repeated_layout_leftover' END,
    CASE WHEN contains(left(lower(t2), 1000), 'here is the cleaned') THEN 'assistant_or_prompt_leak' END, CASE WHEN contains(t2, '<SKIP>') THEN 'skip_token_leak' END], lambda x: x IS NOT NULL) AS w FROM c LEFT JOIN f USING (doc_id)
)
SELECT unnest(w) AS warning, count(*) AS n FROM w GROUP BY 1
""")
def cleaning_warnings(spark, sf_dir):
    d = documents(spark, sf_dir)
    half = lambda k: F.expr(f"left(text, char_length(text) div {k})")
    m = F.col("doc_id") % 5
    cleaned = F.when(m == 1, half(3)).when(m == 2, F.concat(half(2), F.lit("<SKIP>"))).when(m == 3, F.concat(F.lit("Here is the cleaned "), F.col("text"), F.col("text"))).otherwise(F.lit(""))
    report = R.cleaning_report(d, d.where(m != 0).select("doc_id", cleaned.alias("text")), "doc_id")
    return R.warning_histogram(report, F.col("warnings"))


@query("SELECT count(*) AS seen, count(*) FILTER (length(text) >= 2000) AS written, count(*) FILTER (length(text) < 2000) AS skipped_too_short, sum(length(text)) FILTER (length(text) >= 2000)::BIGINT AS total_chars FROM documents")
def preparation_summary(spark, sf_dir):
    return R.preparation_summary(documents(spark, sf_dir))


@query("""SELECT lang, count(*) AS n, count(quality) AS labelled, round(avg(quality), 9) AS good, round(avg(toxic), 9) AS toxic FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""")
def label_join_report(spark, sf_dir):
    j = documents(spark, sf_dir).select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return j.groupBy("lang").agg(F.count("*").alias("n"), F.count("quality").alias("labelled"), F.round(F.avg("quality"), 9).alias("good"), F.round(F.avg("toxic"), 9).alias("toxic"))


@query("""
WITH b AS (SELECT doc_id, (quality = CASE WHEN length(text) > 1000 THEN 1 ELSE 0 END) AS b, (quality = CASE WHEN lang = 'en' THEN 1 ELSE 0 END) AS c FROM documents JOIN labels USING (doc_id)),
t AS (SELECT count(*) FILTER (NOT b AND c) AS improvements, count(*) FILTER (b AND NOT c) AS regressions, count(*) FILTER (b) AS baseline_correct, count(*) FILTER (b) / count(*)::DOUBLE AS baseline_accuracy,
  count(*) FILTER (c) AS candidate_correct, count(*) FILTER (c) / count(*)::DOUBLE AS candidate_accuracy FROM b)
SELECT *, improvements - regressions AS net_improvement, candidate_accuracy - baseline_accuracy AS accuracy_delta FROM t
""")
def accuracy_compare(spark, sf_dir):
    j = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    run = lambda guess: j.select(F.col("doc_id").alias("id"), (F.col("quality") == F.when(guess, 1).otherwise(0)).alias("correct"), F.lit(0).alias("ord"))
    return R.compare_accuracy(run(n_chars(F.col("text")) > 1000), run(F.col("lang") == "en"), "ord")


_AGAIN = """(len(s) > 3 AND len(list_filter(list_distinct(list_filter(s, lambda x: x <> '')), lambda x: len(list_filter(s, lambda y: y = x)) > 2)) > 0)
  OR (len(w) > 20 AND len(list_filter(range(0, len(w) - 10), lambda i: contains(array_to_string(w[i + 11:], ' '), array_to_string(w[i + 1:i + 10], ' ')))) > 0)"""


@query(f"""{_PAIRS}, t AS (SELECT length(question) AS b, length(answer) AS c, string_split(question, '. ') AS s, @WORDS(question) AS w, string_split(answer, '. ') AS s2, @WORDS(answer) AS w2 FROM p),
r AS (SELECT b, c, ({_AGAIN}) AS rb, s2 AS s, w2 AS w FROM t)
SELECT count(*) AS questions, avg(b)::DOUBLE AS mean_length_baseline, avg(c)::DOUBLE AS mean_length_candidate, count(*) FILTER (rb) AS repetitions_baseline, count(*) FILTER ({_AGAIN}) AS repetitions_candidate FROM r""")
def answers_compare(spark, sf_dir):
    pairs = chat_pairs(spark, sf_dir).select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "question", "answer", F.lit(0).alias("ord"))
    return R.compare_answers(pairs.select("id", "ord", F.col("question").alias("prediction")), pairs.select("id", "ord", F.col("answer").alias("prediction")), "ord")


_ALONE = r"(?i)(?:^|[^\p{L}\p{N}_])([abcd])(?:$|[^\p{L}\p{N}_])"


@query(f"""SELECT doc_id, upper(coalesce(nullif(regexp_extract(regexp_extract(@STRIP(coalesce(text, '')), '^([^\\r\\n\\x0b\\x0c\\x1c-\\x1e\\x85]*)', 1), '{_ALONE}', 1), ''), nullif(regexp_extract(text, '{_ALONE}', 1), ''), '')) AS letter FROM documents""")
def choice_extraction(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.choice_of(F.col("text")).alias("letter"))


# Events: windows over time, and nested properties


@query("""SELECT event_id, user_id, count(*) OVER w AS trailing, round(sum(value) OVER w, 6) AS total FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY epoch(date_trunc('second', ts))::BIGINT RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW)""")
def rate_window(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("s", F.unix_timestamp(F.col("ts").cast("timestamp")))
    used = M.usage_in_window(e, "user_id", "s", "value", 3600)
    return used.select("event_id", "user_id", F.col("requests").alias("trailing"), F.round("tokens_used", 6).alias("total"))


@query("SELECT epoch(date_trunc('hour', ts))::BIGINT AS hour, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_counts(spark, sf_dir):
    from ..streaming.ingest import tumbling

    return tumbling(table(spark, sf_dir, "events"), "ts", "event_type").select(F.unix_timestamp("start").alias("hour"), "event_type", "n")


@query("SELECT event_id, list_sort(json_keys(props)) AS keys, len(json_keys(props))::INTEGER AS n FROM events WHERE props IS NOT NULL AND json_valid(props)")
def json_props(spark, sf_dir):
    e = table(spark, sf_dir, "events").where(F.try_parse_json("props").isNotNull())
    return e.select("event_id", F.array_sort(F.json_object_keys("props")).alias("keys"), F.size(F.json_object_keys("props")).alias("n"))


@query("""WITH w AS (SELECT doc_id, @WORDS(text) AS w FROM documents), u AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM w)
SELECT doc_id, sha1(string_agg(word, ' ' ORDER BY pos)) AS text FROM u GROUP BY doc_id""")
def inverted_abstracts(spark, sf_dir):
    """Texts turned into maps from words to positions, and back."""
    def places(w):
        """The map within the row: positions sorted by word, one entry a word."""
        ordered = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))

        def grouped(o):
            starts = F.filter(F.sequence(F.lit(0), F.size(o) - 1), lambda i: (i == 0) | (F.get(o, i)["w"] != F.get(o, F.greatest(i - 1, F.lit(0)))["w"]))
            ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(o)))
            return F.map_from_entries(F.zip_with(starts, ends, lambda a, b: F.struct(F.get(o, a)["w"].alias("key"), F.transform(F.slice(o, a + 1, b - a), lambda x: x["i"]).alias("value"))))

        return let(ordered, grouped)

    maps = documents(spark, sf_dir).select("doc_id", words(F.col("text")).alias("w")).where(F.size("w") > 0).select("doc_id", places(F.col("w")).alias("m"))
    return maps.select("doc_id", F.sha1(T.inverted_abstract(F.col("m"))).alias("text"))


# Pages, cleaning damage, schedules and profiles


@query()
def html_to_text(spark, sf_dir):
    from ..sources.markup import html_text

    return table(spark, sf_dir, "pages").select("page_id", html_text(F.col("html")).alias("text")).select("page_id", F.sha1("text").alias("text"), n_chars(F.col("text")).alias("chars"))


@query(r"""SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title, regexp_extract(url, '^https?://([^/]+)', 1) AS host, len(regexp_extract_all(html, '<a\s'))::BIGINT AS links FROM pages""")
def page_title_url(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1).alias("title"), F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), F.regexp_count("html", F.lit("<a\\s")).cast("long").alias("links"))


@query("""WITH c AS (SELECT doc_id, length(text) AS n, CASE WHEN doc_id % 10 = 0 THEN least(length(text), 40) ELSE length(text) END AS k FROM documents)
SELECT doc_id AS name, k::DOUBLE / greatest(n, 1) AS ratio, n::BIGINT AS chars FROM c WHERE k::DOUBLE / greatest(n, 1) < 0.05::DOUBLE""")
def restore_destroyed(spark, sf_dir):
    raw = documents(spark, sf_dir).select(F.col("doc_id").alias("name"), "text")
    cleaned = raw.withColumn("text", F.when(F.col("name") % 10 == 0, F.left("text", F.lit(40))).otherwise(F.col("text")))
    return O.restore_destroyed(raw, cleaned).select("name", "ratio", n_chars(F.col("text")).alias("chars"))


@query("""WITH n AS (SELECT least(count(*), greatest(100, floor(count(*) * 0.01)))::BIGINT AS n FROM documents)
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY sha1('42:' || doc_id)) <= (SELECT n FROM n) THEN 'val' ELSE 'train' END AS split FROM documents""")
def carve_validation(spark, sf_dir):
    from ..sources.files import carve

    return carve(documents(spark, sf_dir).select("doc_id"), "doc_id")


@query("""WITH d AS (SELECT doc_id, lang, CASE WHEN source = 'src0' THEN 'core' ELSE 'selective' END AS grp FROM documents),
one AS (SELECT doc_id, 1 AS stage, row_number() OVER (PARTITION BY lang ORDER BY sha1('42:' || lang || ':' || doc_id)) - 1 AS turn FROM d WHERE grp = 'core'),
m AS (SELECT doc_id, lang, unnest(range(CASE WHEN grp = 'core' THEN 2 ELSE 1 END)) AS copy FROM d),
two AS (SELECT doc_id, 2 AS stage, row_number() OVER (PARTITION BY lang ORDER BY sha1('42+7:' || lang || ':' || doc_id || '#' || copy)) - 1 AS turn FROM m)
SELECT stage, epoch, turn, doc_id FROM one, (SELECT unnest([1, 2]) AS epoch) UNION ALL SELECT stage, 1, turn, doc_id FROM two""")
def training_schedule(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", "lang", F.when(F.col("source") == "src0", "core").otherwise("selective").alias("grp"))
    return O.schedule(d, "grp", "lang", "doc_id", core_epochs=2, mixed_epochs=1, weight=2.0).select("stage", "epoch", "turn", "doc_id")


@query(f"""{_PAIRS}, w AS (SELECT conv_id, @NWORDS(question) AS q, @NWORDS(answer) AS a FROM p), t AS (SELECT conv_id, count(*) AS n FROM w GROUP BY conv_id)
SELECT count(*) AS samples, avg(q)::DOUBLE AS mean_question_words, avg(a)::DOUBLE AS mean_answer_words, count(DISTINCT conv_id) AS topics, count(DISTINCT conv_id % 3) AS sources,
  (SELECT max(n) FROM t) * 100.0::DOUBLE / count(*) AS top_topic_pct FROM w""")
def dataset_profile(spark, sf_dir):
    rows = chat_pairs(spark, sf_dir).select("question", "answer", F.col("conv_id").cast("string").alias("topic"), (F.col("conv_id") % 3).cast("string").alias("source"))
    return R.dataset_profile(rows)


# Names and keys, light cleaning, further rule sets


@query(rf"""SELECT page_id, left(regexp_replace(url, '[^A-Za-z0-9._-]', '_', 'g'), 120) AS stem, left(@SQUEEZE(regexp_replace('g__' || url, '[<>:"/\\|?*\x00-\x1f]', '_', 'g')), 230) || '.txt' AS name,
  array_to_string(list_transform(regexp_extract_all(lower(url), '\p{{Nd}}+|\P{{Nd}}+'), lambda x: CASE WHEN regexp_matches(x, '^\p{{Nd}}') THEN lpad(x, greatest(length(x), 12)::INTEGER, '0') ELSE x END), '') AS natural,
  string_split(url, ':')[1] AS prefix FROM pages""")
def name_keys(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", T.safe_stem(u).alias("stem"), T.safe_name(F.lit("g"), u).alias("name"), T.natural_key(u).alias("natural"), T.source_prefix(u).alias("prefix"))


@query(rf"""WITH t AS (SELECT doc_id, @STRIP(regexp_replace(regexp_replace(coalesce(text, ''), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')) AS t FROM documents)
SELECT doc_id, CASE WHEN length(t) <= 300 THEN t WHEN contains(left(t, 300), ' ') THEN @STRIP(regexp_extract(left(t, 300), '(?s)^(.*) ', 1)) ELSE @STRIP(left(t, 300)) END AS short FROM t""")
def compact_texts(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.compact(F.col("text"), 300).alias("short"))


@query("SELECT doc_id, sha1(@STRIP(regexp_replace(@SQUEEZE(coalesce(text, '')), 'Click to expand\\.\\.\\.', '', 'g'))) AS body FROM documents")
def forum_texts(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.sha1(T.forum_text(F.col("text"))).alias("body"))


_NOISE = rf"""(regexp_matches(s, '^\p{{Nd}}{{1,4}}$') OR regexp_matches(s, '^https?://[^{WS}]+$') OR (regexp_matches(s, '(?i)(^|[^\p{{L}}\p{{N}}_])ISBN[{WS}\-:]*[\p{{Nd}}\-X]+') AND length(s) < 80)
  OR regexp_matches(s, '(?i)^(©|\(c\)|Copyright)[{WS}]+\p{{Nd}}{{4}}')
  OR (regexp_matches(s, '^[A-Z][a-zA-Z''\-]+([{WS}]+[A-Z]\.?){{0,3}}(.*[^\p{{L}}\p{{N}}_])(19|20)\p{{Nd}}{{2}}([^\p{{L}}\p{{N}}_].*)?[;:].*\p{{Nd}}+[-\p{{Nd}}]*\.?$') AND length(s) < 200))"""


@query(rf"""WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents), k AS (
  SELECT doc_id, list_transform(list_filter(l, lambda x: @STRIP(x) = '' OR NOT {_NOISE.replace("(s,", "(@STRIP(x),").replace("length(s)", "length(@STRIP(x))")}), lambda x: CASE WHEN @STRIP(x) = '' THEN '' ELSE x END) AS k FROM l)
SELECT doc_id, len(k)::BIGINT AS n_lines, sha1(@STRIP(regexp_replace(array_to_string(k, chr(10)), '\n{{3,}}', chr(10) || chr(10), 'g'))) AS cleaned FROM k""")
def light_clean_lines(spark, sf_dir):
    c = F.col("text")
    kept = documents(spark, sf_dir).select("doc_id", T.light_lines(c).alias("l"))
    return kept.select("doc_id", F.size("l").cast("long").alias("n_lines"), F.sha1(T.light_joined(F.col("l"))).alias("cleaned"))


_DAMAGE = "CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN left(text, length(text) // 2) WHEN 2 THEN 'Sure, here: ' || text || text WHEN 3 THEN '![i](u) ' || left(text, length(text) // 8) ELSE text || ' As an AI' END"
_SHARE = "length(t2)::DOUBLE / greatest(length(text), 1)"


@query(f"""WITH c AS (SELECT doc_id, coalesce(text, '') AS text, {_DAMAGE} AS t2 FROM documents WHERE text IS NOT NULL), r AS (SELECT *, {_SHARE} AS r FROM c)
SELECT doc_id, array_to_string(list_filter([CASE WHEN round_even(r, 4) < 0.7::DOUBLE THEN 'low_retention' END, CASE WHEN round_even(r, 4) > 1.1::DOUBLE THEN 'unexpected_growth' END, CASE WHEN @STRIP(t2) = '' THEN 'empty_output' END,
    CASE WHEN starts_with(lower(@STRIP(t2)), 'sure') THEN 'assistant_preface_detected' END], lambda x: x IS NOT NULL), ',') AS simple,
  CASE WHEN t2 = '' THEN 'empty_output' ELSE array_to_string(list_filter([CASE WHEN NOT r BETWEEN 0.8::DOUBLE AND 1.2::DOUBLE THEN 'length_ratio' END, CASE WHEN starts_with(lower(@STRIP(t2)), 'sure') OR starts_with(lower(@STRIP(t2)), 'here') THEN 'assistant_preface_detected' END,
    CASE WHEN contains(t2, 'As an AI') THEN 'assistant_disclaimer_detected' END], lambda x: x IS NOT NULL), ',') END AS chunk,
  CASE WHEN t2 = '' THEN 'empty' ELSE array_to_string(list_filter([CASE WHEN regexp_matches(t2, '```|<!--|!\\[') THEN 'residual_markdown' END, CASE WHEN length(t2) < 200 THEN 'very_short' END, CASE WHEN r < 0.2::DOUBLE THEN 'low_retained_ratio' END], lambda x: x IS NOT NULL), ',') END AS preparation FROM r""")
def retention_rule_sets(spark, sf_dir):
    """The other three rule sets, on texts damaged in five ways; the ratio in a chunk's warning is left out."""
    m, t = F.col("doc_id") % 5, F.col("text")
    part = lambda k: F.expr(f"left(text, char_length(text) div {k})")
    damaged = F.when(m == 0, F.lit("")).when(m == 1, part(2)).when(m == 2, F.concat(F.lit("Sure, here: "), t, t)).when(m == 3, F.concat(F.lit("![i](u) "), part(8))).otherwise(F.concat(t, F.lit(" As an AI")))
    d = documents(spark, sf_dir).where("text is not null").select("doc_id", "text", damaged.alias("t2"))
    of = lambda f: F.array_join(f(F.col("text"), F.col("t2")), ",")
    return d.select("doc_id", of(P.cleaning_warnings_simple).alias("simple"), F.regexp_replace(of(P.chunk_warnings), "length_ratio_[0-9.]+", "length_ratio").alias("chunk"), of(P.preparation_warnings).alias("preparation"))


# Merges, benchmark, reports on questions, graphs


@query("SELECT doc_id FROM documents WHERE sha1(@KEY(text)) NOT IN (SELECT sha1(@KEY(text)) FROM benchmark WHERE text IS NOT NULL)")
def anti_join_benchmark(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").where("text is not null")
    return O.unseen(documents(spark, sf_dir), b, T.key_hash(F.col("text")), T.key_hash(F.col("text"))).select("doc_id")


@query("""WITH b AS (SELECT item_id, unnest(string_split(text, chr(10))) AS line FROM benchmark), d AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
k AS (SELECT DISTINCT item_id, sha1(@KEY(line)) AS k FROM b WHERE @NWORDS(line) >= 8), t AS (SELECT DISTINCT doc_id, sha1(@KEY(line)) AS k FROM d WHERE @NWORDS(line) >= 8)
SELECT item_id, count(*) AS documents FROM (SELECT DISTINCT item_id, doc_id FROM k JOIN t USING (k)) GROUP BY item_id""")
def benchmark_contamination(spark, sf_dir):
    """Documents that hold a line of a benchmark item, of eight words and more, up to its key."""

    def keys(df, id_col):
        long = F.filter(F.split("text", "\n", -1), lambda x: word_count(x) >= 8)
        return unfold(df.where("text is not null"), [id_col], F.array_distinct(F.transform(long, T.key_hash)), "i", "k").select(id_col, "k")

    met = keys(table(spark, sf_dir, "benchmark"), "item_id").join(keys(documents(spark, sf_dir), "doc_id"), "k")
    return met.select("item_id", "doc_id").distinct().groupBy("item_id").agg(F.count("*").alias("documents"))


@query(f"""{_PAIRS}, s AS (SELECT (conv_id % 3 > 0)::INTEGER AS src_rank, conv_id * 1000 + turn AS ord, @STRIP(question) AS question FROM p WHERE length(@STRIP(question)) >= 10 AND length(@STRIP(answer)) >= 20),
q AS (SELECT src_rank, ord, sha1(@KEY(question)) AS k FROM s QUALIFY row_number() OVER (PARTITION BY sha1(@KEY(question)) ORDER BY src_rank, ord) = 1),
d AS (SELECT (source IS DISTINCT FROM 'src0')::INTEGER AS src_rank, doc_id AS ord, @STRIP(text) AS text FROM documents WHERE length(@STRIP(text)) >= 50),
t AS (SELECT src_rank, ord, sha1(@KEY(left(text, 500))) AS k FROM d QUALIFY row_number() OVER (PARTITION BY sha1(@KEY(left(text, 500))) ORDER BY src_rank, ord) = 1),
m AS (SELECT 'sft' AS shape, src_rank, ord FROM q UNION ALL SELECT 'cpt', src_rank, ord FROM t WHERE k NOT IN (SELECT k FROM q)),
n AS (SELECT shape, greatest(1, floor(count(*) * 0.05))::BIGINT AS n FROM m GROUP BY shape)
SELECT m.shape, m.src_rank, m.ord, CASE WHEN row_number() OVER (PARTITION BY m.shape ORDER BY sha1('42:' || m.ord)) <= n.n THEN 'val' ELSE 'train' END AS split FROM m JOIN n USING (shape)""")
def final_merge(spark, sf_dir):
    """Coerce every source, unite them by rank, keep the first of each key over both shapes, split."""
    pairs = chat_pairs(spark, sf_dir).select("conv_id", "question", "answer", (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"))
    sft = O.coerce_sft(O.union_ranked(pairs.where("conv_id % 3 = 0"), pairs.where("conv_id % 3 > 0")))
    d = documents(spark, sf_dir).select("text", "source", F.col("doc_id").alias("ord"))
    cpt = O.coerce_cpt(O.union_ranked(d.where("source = 'src0'"), d.where("source is null or source <> 'src0'")))
    shapes = zip(("sft", "cpt"), O.dedup_across_shapes(sft, cpt))
    a, b = (O.split_train_val(rows.select(F.lit(shape).alias("shape"), "src_rank", "ord"), "ord") for shape, rows in shapes)
    return a.unionByName(b)


@query(f"{_PAIRS} SELECT conv_id, turn, sha1(@STRIP(regexp_replace(regexp_replace(question, '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'))) AS q FROM p WHERE length(@STRIP(question)) BETWEEN 5 AND 6000 AND length(@STRIP(answer)) BETWEEN 5 AND 30000")
def bounded_pairs(spark, sf_dir):
    b = O.bounded_sft(F.col("question"), F.col("answer"), F.lit("chat"), F.lit(None).cast("string"))
    rows = chat_pairs(spark, sf_dir).select("conv_id", "turn", b.alias("b")).where("b is not null")
    return rows.select("conv_id", "turn", F.sha1("b.question").alias("q"))


@query(f"""{_PAIRS}, q AS (SELECT lower(question) AS low, question FROM p)
SELECT CASE WHEN starts_with(question, 'exam_reasoning') THEN 'exam_reasoning' WHEN contains(low, 'explain') OR contains(low, 'describe') THEN 'explanation' WHEN contains(low, 'what') OR contains(low, 'how') THEN 'factual'
  WHEN contains(low, 'compare') OR contains(low, 'differ') THEN 'comparison' ELSE 'other' END AS kind, count(*) AS n FROM q GROUP BY 1""")
def question_types(spark, sf_dir):
    return chat_pairs(spark, sf_dir).groupBy(R.question_type(F.col("question")).alias("kind")).agg(F.count("*").alias("n"))


@query("""WITH b AS (SELECT doc_id, (quality = CASE WHEN length(text) > 1000 THEN 1 ELSE 0 END) AS c FROM documents JOIN labels USING (doc_id))
SELECT count(c) AS scored, count(*) FILTER (c) AS correct, round(count(*) FILTER (c) / count(c)::DOUBLE, 4) AS accuracy FROM b""")
def label_accuracy(spark, sf_dir):
    j = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    return R.accuracy(j.select((F.col("quality") == F.when(n_chars(F.col("text")) > 1000, 1).otherwise(0)).alias("correct")))


@query("""SELECT count(*) AS "rows", count(*) FILTER (NOT coalesce(json_valid(props), false)) AS invalid, count(*) FILTER (json_valid(props) AND NOT json_exists(props, '$.k')) AS missing_keys, 0::BIGINT AS flagged,
  avg((props->>'$.k')::DOUBLE) AS mean_score, min((props->>'$.k')::DOUBLE) AS least_score, max((props->>'$.k')::DOUBLE) AS greatest_score FROM events""")
def annotation_summary(spark, sf_dir):
    return R.annotation_report(table(spark, sf_dir, "events"), "props", ("k",), "k", "flags").drop("examples")


@query("""WITH RECURSIVE e AS (SELECT r_name AS parent, n_name AS child FROM region JOIN nation ON r_regionkey = n_regionkey UNION ALL SELECT n_name, 'c' || c_custkey FROM nation JOIN customer ON n_nationkey = c_nationkey),
w AS (SELECT 'ASIA' AS category, 0 AS depth UNION ALL SELECT child, depth + 1 FROM w JOIN e ON e.parent = w.category WHERE depth < 2)
SELECT category, min(depth)::INTEGER AS depth FROM w GROUP BY category""")
def category_walk(spark, sf_dir):
    from ..sources.paged import walk_categories

    r, n, c = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    first = r.join(n, r["r_regionkey"] == n["n_regionkey"]).select(F.col("r_name").alias("parent"), F.col("n_name").alias("child"))
    second = n.join(c, n["n_nationkey"] == c["c_nationkey"]).select(F.col("n_name").alias("parent"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("child"))
    return walk_categories(first.unionByName(second), ["ASIA"], 2)


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def documents_not_done(spark, sf_dir):
    from ..sources.paged import not_done

    return not_done(documents(spark, sf_dir).select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("""WITH n AS (SELECT doc_id, @NWORDS(coalesce(text, ''))::BIGINT AS n FROM documents), t AS (SELECT count(*) AS documents, sum(n)::BIGINT AS tokens FROM n)
SELECT documents, tokens, least(tokens // 512, 100)::BIGINT AS sequences, least(tokens // 512, 100)::BIGINT * 512 AS used_tokens, tokens - least(tokens // 512, 100)::BIGINT * 512 AS dropped_tokens FROM t""")
def packing_summary(spark, sf_dir):
    return C.packing_summary(documents(spark, sf_dir).select(words(text_of(F.col("text"))).alias("w")), "w", 512, 100)


@query("""WITH w AS (SELECT doc_id, list_append(@WORDS(text), '</s>') AS w FROM documents), u AS (SELECT sha1('7:' || doc_id) AS o, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM w),
n AS (SELECT token, row_number() OVER (ORDER BY o, pos) - 1 AS i FROM u)
SELECT (i // 256)::BIGINT AS block, sha1(string_agg(token, ' ' ORDER BY i)) AS tokens FROM n WHERE i < 256 * 500 GROUP BY i // 256 HAVING count(*) = 256""")
def pack_tokens_shuffled(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", F.array_append(words(F.col("text")), F.lit("</s>")).alias("w"))
    return C.pack_tokens(d, "doc_id", "w", 256, shuffle="7", max_sequences=500).select("block", F.sha1(F.array_join("tokens", " ")).alias("tokens"))


@query(f"""{_PAIRS}, t AS (SELECT conv_id, turn, @STRIP(question) AS q, @STRIP(answer) AS c, question || ' ' || answer AS src FROM p), m AS (SELECT *, {_tokens("c")} AS a, {_tokens("src")} AS s, {_tokens("q")} AS r FROM t)
SELECT conv_id, turn, CASE WHEN NOT length(q) BETWEEN 25 AND 800 THEN 'q_length' WHEN regexp_matches(q, '{_alternatives((D.META_QUESTIONS,))}') THEN 'meta_question' WHEN NOT length(c) BETWEEN 80 AND 3000 THEN 'chosen_length' WHEN NOT length(q) BETWEEN 80 AND 3000 THEN 'rejected_length'
  WHEN (CASE WHEN len(a) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect(a, s))::DOUBLE / len(a) END) < 0.4::DOUBLE THEN 'grounding'
  WHEN NOT coalesce(CASE WHEN len(a) > 0 AND len(r) > 0 THEN 1 - len(list_intersect(a, r))::DOUBLE / (len(a) + len(r) - len(list_intersect(a, r))) END >= 0.3::DOUBLE, false) THEN 'rejected_too_similar'
  WHEN lower(c) = lower(q) THEN 'identical' ELSE 'ok' END AS fault, regexp_matches(q, '{_alternatives((D.META_QUESTIONS,))}') AS meta FROM m""")
def question_faults(spark, sf_dir):
    q, a = F.col("question"), F.col("answer")
    return chat_pairs(spark, sf_dir).select("conv_id", "turn", P.question_fault(q, a, q, F.concat(q, F.lit(" "), a)).alias("fault"), P.meta_question(strip(q)).alias("meta"))


@query(f"""WITH t AS (SELECT doc_id, @COUNT(regexp_replace(coalesce(text, ''), '([^\\p{{L}}\\p{{N}}_])', '\\1\\1', 'g');; {_alternatives((D.FRONT_MATTER.replace(' ', '  '),))}) AS f, @COUNT(coalesce(text, '');; [A-Za-zÀ-ÿ][A-Za-zÀ-ÿ\\-]+) AS w FROM documents)
SELECT doc_id, doc_id % 10 >= 5 AND f::DOUBLE / greatest(w, 1) <= 0.012::DOUBLE AS worth, f::DOUBLE / greatest(w, 1) AS density FROM t""")
def front_matter(spark, sf_dir):
    c = F.col("text")
    return documents(spark, sf_dir).select("doc_id", P.worth_questions(c, (F.col("doc_id") % 10).cast("int")).alias("worth"), P.front_matter_density(c).alias("density"))


@query(f"SELECT lang, source, ({' OR '.join(f'contains(lower(h), {chr(39)}{x}{chr(39)})' for x in D.HEADINGS)}) AS relevant FROM (SELECT lang, source, string_agg(DISTINCT left(text, 40), ' ' ORDER BY left(text, 40)) AS h FROM documents GROUP BY ALL)")
def heading_relevance(spark, sf_dir):
    """Headings: the first 40 characters of a group's texts."""
    h = documents(spark, sf_dir).groupBy("lang", "source").agg(F.array_sort(F.collect_set(F.left("text", F.lit(40)))).alias("h"))
    return h.select("lang", "source", P.headings_relevant(F.col("h")).alias("relevant"))


@query("SELECT doc_id, list_sort(list_filter(['text', 'lang', 'source'], lambda k: CASE k WHEN 'text' THEN coalesce(text, '') = '' WHEN 'lang' THEN lang IS NULL ELSE source IS NULL END)) AS missing FROM documents WHERE source IN ('src0', 'src1', 'src2')")
def listed_and_missing(spark, sf_dir):
    """Rows of listed sources, and which required fields they lack."""
    listed = spark.createDataFrame([("src0",), ("src1",), ("src2",)], "source string")
    rows = O.listed(documents(spark, sf_dir), listed, "source")
    present = F.array_compact(F.array(F.when(text_of(F.col("text")) != "", F.lit("text")), F.when(F.col("lang").isNotNull(), F.lit("lang")), F.when(F.col("source").isNotNull(), F.lit("source"))))
    return rows.select("doc_id", F.array_sort(O.missing(("text", "lang", "source"), present)).alias("missing"))


@query("SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL")
def distinct_ids(spark, sf_dir):
    return O.distinct_ids(table(spark, sf_dir, "events"), "user_id")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def counts_by_key(spark, sf_dir):
    return R.counts(table(spark, sf_dir, "events"), "event_type")


# Fingerprint of the whole: the flagship


@query(rf"""
WITH m AS ({_MEASURES}), q AS (SELECT *, {_QUALITY} AS quality FROM m WHERE length(@STRIP(text)) >= 50), d AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY sha1(@KEY(left(@STRIP(text), 500))) ORDER BY doc_id) = 1)
SELECT source, count(*) AS n, round(avg(quality), 9) AS mean_quality, count(*) FILTER (quality >= 0.75::DOUBLE) AS good FROM d GROUP BY source
""")
def curated_sources(spark, sf_dir):
    """Coerce, keep the first of each prefix, score, and count by source."""
    rows = O.coerce_cpt(documents(spark, sf_dir).withColumn("ord", F.col("doc_id")))
    kept = O.first_wins(rows, F.sha1(T.prefix_key(F.col("text"))), "ord").select("source", B.quality(F.col("text")).alias("quality"))
    return kept.groupBy("source").agg(F.count("*").alias("n"), F.round(F.avg("quality"), 9).alias("mean_quality"), F.count_if(F.col("quality") >= 0.75).alias("good"))

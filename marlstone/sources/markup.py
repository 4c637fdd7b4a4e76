"""Markup as text: HTML, Markdown, XML articles and dialogues. Parsers that Spark lacks run on Arrow batches."""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from ..functions.expr import SPACE, WORD, squeeze, strip, text_of

# Elements whose text is not content.
SKIPPED = frozenset("script style noscript header footer nav aside".split())


def _batched(f: Callable[[str], object], kind, arrow: pa.DataType):
    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([f(t or "") for t in texts.to_pylist()], arrow)

    return run


class _Text(HTMLParser):
    def __init__(self):
        super().__init__()
        self.parts, self.depth = [], 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in SKIPPED

    def handle_endtag(self, tag):
        self.depth -= tag in SKIPPED and self.depth > 0

    def handle_data(self, data):
        if not self.depth:
            self.parts.append(data)


def text_of_html(page: str) -> str:
    """A page's text, a line for each piece: single spaces, no blank lines."""
    parser = _Text()
    parser.feed(page)
    lines = re.sub(r"[ \t]+", " ", "\n".join(parser.parts)).splitlines()
    return "\n".join(x for x in map(str.strip, lines) if x)


def html_text(c: Column) -> Column:
    return _batched(text_of_html, StringType(), pa.string())(c)


# The shapes of lines that are not text, and of headings and items.
_FENCE = re.compile(r"\s*```")
_TABLE = re.compile(r"\s*\|.*\|\s*$")
_RULE = re.compile(r"\s*\|?\s*-{2,}(\s*\|\s*-{2,})+\s*\|?\s*$")
_FIGURE = re.compile(r"\s*(figure|fig\.|table)\b", re.I)
_HEADING = re.compile(r"\s*#{1,6}\s+(.*)$")
_ITEM = re.compile(r"\s*[-*+]\s+(?:\[[ xX]\]\s+)?(.*)$")
# Phrases of legal lines, and marks taken off a line with what stays of them, in this order.
LEGAL = ("terms and conditions", "all rights reserved", "copyright")
INLINE = ((r"!\[.*?\]\(.*?\)", ""), (r"\[(.*?)\]\((.*?)\)", r"\1"), (r"<[^>]+>", ""))
EMPHASIS = ((r"^\s*>\s+", ""), (r"\*\*(.*?)\*\*", r"\1"), (r"__(.*?)__", r"\1"), (r"\*(.*?)\*", r"\1"), (r"_(.*?)_", r"\1"))


def _is_table(line: str) -> bool:
    return bool(_RULE.match(line) or _TABLE.match(line) and line.count("|") >= 2)


def text_of_markdown(text: str, keep_figures: bool = False) -> str:
    """Paragraphs of a Markdown text. Code, comments, legal lines, tables and captions go; headings and items are
    paragraphs of their own; marks are taken off."""
    paragraphs: list[list[str]] = [[]]
    in_code = False
    for line in text.splitlines():
        if _FENCE.match(line):
            in_code = not in_code
            continue
        bare = line.strip()
        if in_code:
            continue
        if not bare:
            paragraphs.append([])
            continue
        low = bare.lower()
        if (bare.startswith("<!--") and bare.endswith("-->")) or any(p in low for p in LEGAL) or _is_table(bare) or (not keep_figures and _FIGURE.match(bare)):
            continue
        for pattern, to in INLINE:
            line = re.sub(pattern, to, line)
        line = re.sub(r"https?://\S+|www\.\S+", "", html.unescape(line))
        if m := _HEADING.match(line):
            if title := m[1].strip():
                paragraphs += [[title], []]
            continue
        if m := _ITEM.match(line):
            if item := m[1].strip():
                # What came just before goes on into the item's paragraph, which ends with it.
                paragraphs[-1].append(item)
                paragraphs.append([])
            continue
        for pattern, to in EMPHASIS:
            line = re.sub(pattern, to, line)
        line = re.sub(r"\s+", " ", line).strip()
        if line and not line.isdigit():
            paragraphs[-1].append(line)
    return "\n\n".join(" ".join(p) for p in paragraphs if p).strip()


def markdown_text(c: Column, keep_figures: bool = False) -> Column:
    return _batched(lambda t: text_of_markdown(t, keep_figures), StringType(), pa.string())(c)


# What stands before a turn, and how clinicians' names begin or what they hold.
SPEAKER = f"(?<!{WORD})([A-Z][A-Za-z0-9_.' \\-]{{1,40}}):{SPACE}"
CLINICAL_STARTS, CLINICAL_PARTS = ("dr ", "dr.", "doctor "), ("dds", "dmd")


def dialogue_turns(c: Column) -> Column:
    """array<struct<speaker, text>>: a dialogue split at "Name: " marks, without empty turns; a text without a mark is
    one turn without a speaker, an empty one none."""
    names, texts = F.regexp_extract_all(text_of(c), F.lit(SPEAKER), F.lit(1)), F.split(text_of(c), SPEAKER, -1)
    turn = lambda name, text: F.struct(strip(name).alias("speaker"), strip(text).alias("text"))
    turns = F.zip_with(names, F.slice(texts, 2, F.greatest(F.size(texts) - 1, F.lit(1))), turn)
    none = F.array().cast("array<struct<speaker:string,text:string>>")
    return F.when(text_of(c) == "", none).when(F.size(names) > 0, F.filter(turns, lambda t: t["text"] != "")).otherwise(F.array(turn(F.lit(""), c)))


def is_clinician(name: Column) -> Column:
    n, any_of = F.lower(name), lambda tests: F.exists(F.array(*tests), lambda t: t)
    return any_of([n.startswith(x) for x in CLINICAL_STARTS] + [F.contains(n, F.lit(x)) for x in CLINICAL_PARTS])


def dialogue_question_answer(title: Column, turns: Column) -> Column:
    """struct<question, first, answer> of turns: the title and first turn; all of the clinicians' replies, else the first
    reply of another speaker; null without one."""
    first = F.get(turns, F.lit(0))
    replies = F.filter(F.slice(turns, 2, F.greatest(F.size(turns), F.lit(1))), lambda t: (t["speaker"] != "") & (t["speaker"] != first["speaker"]))
    clinical = F.filter(replies, lambda t: is_clinician(t["speaker"]))
    plain = lambda c: F.translate(c, "�’‘", "'''")
    answer = F.when(F.size(clinical) > 0, F.array_join(F.transform(clinical, lambda t: t["text"]), "\n\n")).otherwise(F.get(replies, F.lit(0))["text"])
    question = strip(F.concat_ws("\n\n", F.nullif(strip(text_of(title)), F.lit("")), first["text"]))
    return F.when(F.size(replies) > 0, F.struct(plain(question).alias("question"), first["text"].alias("first"), plain(strip(answer)).alias("answer")))


# Sections of articles that are not text.
NOT_TEXT = ("ref", "references", "ack", "acknowledgments", "supplementary-material", "back", "fn")


def article_passages(passages: Column) -> Column:
    """The text of array<struct<text, section_type>>: without references and the like, and pieces of 50 characters
    or fewer; null if nothing is left."""
    kept = F.filter(passages, lambda p: ~F.lower(text_of(p["section_type"])).isin(*NOT_TEXT) & (F.char_length(strip(text_of(p["text"]))) > 50))
    return F.nullif(F.array_join(F.transform(kept, lambda p: strip(p["text"])), "\n\n"), F.lit(""))


#: An article in XML, as the rows of a scan with that tag, or as from_xml() reads a column.
ARTICLE_SCHEMA = (
    "MedlineCitation struct<PMID: string, Article: struct<ArticleTitle: string, Abstract: struct<AbstractText: array<struct<_VALUE: string, _Label: string>>>, "
    "Journal: struct<Title: string, JournalIssue: struct<PubDate: struct<Year: string, MedlineDate: string>>>, PublicationTypeList: struct<PublicationType: array<string>>>, "
    "MeshHeadingList: struct<MeshHeading: array<struct<DescriptorName: string>>>>"
)


def parse_articles(df: DataFrame, xml_col: str) -> DataFrame:
    """pmid, title, abstract, journal, year, mesh, pub_types of a column with one article's XML in each row;
    those without an id, or that cannot be parsed, are left out."""
    a = F.from_xml(F.col(xml_col), ARTICLE_SCHEMA, {"mode": "PERMISSIVE"})
    m = df.select(a.alias("a")).select("a.MedlineCitation")
    art = F.col("MedlineCitation.Article")
    parts = F.filter(art["Abstract"]["AbstractText"], lambda p: strip(text_of(p["_VALUE"])) != "")
    labelled = F.transform(parts, lambda p: F.concat(F.when(text_of(p["_Label"]) != "", F.concat(p["_Label"], F.lit(": "))).otherwise(F.lit("")), strip(p["_VALUE"])))
    date = art["Journal"]["JournalIssue"]["PubDate"]
    none = F.array().cast("array<string>")
    return m.select(
        strip(text_of(F.col("MedlineCitation.PMID"))).alias("pmid"), squeeze(text_of(art["ArticleTitle"])).alias("title"), F.coalesce(F.array_join(labelled, "\n"), F.lit("")).alias("abstract"),
        strip(text_of(art["Journal"]["Title"])).alias("journal"), F.coalesce(F.nullif(strip(text_of(date["Year"])), F.lit("")), F.left(strip(text_of(date["MedlineDate"])), F.lit(4))).alias("year"),
        F.coalesce(F.transform(F.col("MedlineCitation.MeshHeadingList.MeshHeading"), lambda h: strip(text_of(h["DescriptorName"]))), none).alias("mesh"),
        F.coalesce(F.transform(art["PublicationTypeList"]["PublicationType"], lambda t: strip(text_of(t))), none).alias("pub_types"),
    ).where("pmid <> ''")


# How the sections of a descriptor record begin.
RECORD_SECTIONS = (
    "Subheadings:", "Tree Number", "See Also", "Entry Term:", "Year introduced", "All MeSH Categories", "Allowable Qualifiers", "Pharm Action",
    "Public MeSH Note", "Online Note", "History Note", "Date of Entry", "Unique ID", "Annotation:",
)


def descriptor_of(text: str) -> dict | None:
    """heading, scope_note, tree_numbers, entry_terms of a descriptor record; None without a heading."""
    lines = text.splitlines()
    heads = ((i, s.split(": ", 1)[1].strip()) for i, s in enumerate(map(str.strip, lines)) if s[:1].isdigit() and ": " in s)
    at, heading = next(((i, h) for i, h in heads if h and not h.endswith(")")), (0, ""))
    if not heading:
        return None
    scope = []
    for line in lines[at + 1 :]:
        if not line.strip() or line.startswith(RECORD_SECTIONS):
            break
        scope.append(line.strip())
    after = lambda line: line.partition(":")[2].strip()
    trees = [n.strip() for line in lines if line.startswith("Tree Number") for n in after(line).split(",")]
    terms = [after(line) for line in lines if line.startswith("Entry Term:")]
    return {"heading": heading, "scope_note": " ".join(scope), "tree_numbers": [t for t in trees if t], "entry_terms": [t for t in terms if t]}


def descriptors(c: Column) -> Column:
    strings = pa.list_(pa.string())
    kind = StructType().add("heading", "string").add("scope_note", "string").add("tree_numbers", ArrayType(StringType())).add("entry_terms", ArrayType(StringType()))
    return _batched(descriptor_of, kind, pa.struct([("heading", pa.string()), ("scope_note", pa.string()), ("tree_numbers", strings), ("entry_terms", strings)]))(c)


# The form of an instruction text.
INSTRUCTION = r"(?s)\A\s*Instruction:\s*/\s*(.*?)\s*/\s*Response:\s*/\s*(.*?)\s*(?:<eos>)?\s*\z"


def instruction_pair(c: Column) -> Column:
    """struct<question, answer> of an instruction text, by its form, else by its only mark; null if either is
    empty."""
    t = strip(text_of(c))
    trimmed = lambda x: F.regexp_replace(x, r"\A[ /:\n]+|[ /:\n]+\z", "")
    no_end = lambda x: strip(F.regexp_replace(x, r"<eos>\z", ""))
    q1, a1 = F.regexp_extract(t, INSTRUCTION, 1), no_end(F.regexp_extract(t, INSTRUCTION, 2))
    at = F.instr(t, "Response:")
    q2 = trimmed(F.replace(F.left(t, at - 1), F.lit("Instruction:"), F.lit("")))
    a2 = no_end(trimmed(F.substr(t, at + len("Response:"))))
    pair = lambda q, a: F.when((q != "") & (a != ""), F.struct(strip(q).alias("question"), a.alias("answer")))
    return F.when(t.rlike(INSTRUCTION), pair(q1, a1)).when(at > 0, pair(q2, a2))

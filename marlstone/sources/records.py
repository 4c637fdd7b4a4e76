"""Published row shapes as question, text and article rows: composites of the functions and filters. Names of
sources are arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.expr import n_chars, strip, text_of
from ..functions.predicates import headings_relevant, relevant, whole_word_hits
from ..operators.rows import bounded_sft, template_choice
from .markup import dialogue_question_answer, dialogue_turns, instruction_pair


def _rows(df: DataFrame, question: Column, answer: Column, source: str, topic: Column) -> DataFrame:
    """The bounded rows among them."""
    row = bounded_sft(question, answer, F.lit(source), topic)
    return df.select(row.alias("r")).where("r is not null").select("r.*")


def field(df: DataFrame, *names: str) -> Column:
    """The first of these columns, as far as df has them, that is filled."""
    return T.first_filled(*[F.col(n).cast("string") for n in names if n in df.columns] or [F.lit(None).cast("string")])


def multiple_choice(df: DataFrame, source: str, subject: str = "dental") -> DataFrame:
    """Rows of question, opa to opd, cop, exp, subject_name, topic_name."""
    df = df.where(F.lower(strip(text_of(F.col("subject_name")))) == subject)
    options = F.array("opa", "opb", "opc", "opd")
    answer = T.mcq_answer(options, F.col("cop").try_cast("int"), F.col("exp"))
    q = T.mcq_question(F.col("question"), options)
    return _rows(df.where(q.isNotNull() & answer.isNotNull()), q, answer, source, F.col("topic_name"))


def exam(df: DataFrame, source: str, language: str) -> DataFrame:
    """Rows of qtext, ra, answers (aid, atext), category: the option whose id is ra is right; the last, if several
    are. Relevant rows only."""
    options = F.transform("answers", lambda a: strip(text_of(a["atext"])))
    right = F.filter(F.transform("answers", lambda a, i: F.when(a["aid"].try_cast("int") == F.col("ra").try_cast("int"), i)), lambda i: i.isNotNull())
    index = F.try_element_at(right, F.lit(-1))
    letters = F.split(F.lit("A B C D E F G H"), " ")
    lettered = F.transform(F.slice(options, 1, 8), lambda o, i: F.concat(F.get(letters, i), F.lit(". "), o))
    q = F.concat(strip(F.col("qtext")), F.lit("\n\n"), F.array_join(lettered, "\n"))
    a = F.when(F.get(options, index) != "", F.concat(F.get(letters, index), F.lit(". "), F.get(options, index)))
    found = df.where((strip(text_of(F.col("qtext"))) != "") & index.isNotNull() & a.isNotNull()).where(relevant(F.col("qtext"), F.array_join(options, "\n")))
    topic = F.concat(F.lit(f"Dentistry ({language.upper()}/"), text_of(F.col("category")), F.lit(")"))
    return _rows(found, q, a, source, topic)


# The names under which rows of small sets keep questions and answers, in order.
QUESTION_NAMES = ("question", "instruction", "prompt", "input", "Question")
ANSWER_NAMES = ("answer", "output", "response", "Answer", "completion")


def question_answer(df: DataFrame, source: str, topic: str) -> DataFrame:
    """Rows of any of the names, else the first user's and the first assistant's message."""
    q, a = field(df, *QUESTION_NAMES), field(df, *ANSWER_NAMES)
    if messages := [c for c in ("messages", "conversations") if c in df.columns]:
        q, a = (F.when(x != "", x).otherwise(first_message(F.col(messages[0]), who)) for x, who in ((q, ("user", "human")), (a, ("assistant", "gpt", "model"))))
    return _rows(df.where((q != "") & (a != "")), q, a, source, F.lit(topic))


def first_message(messages: Column, who: tuple[str, ...]) -> Column:
    """The text of the first message of these roles in an array of role, from, content, value."""
    first = F.get(F.filter(messages, lambda m: F.coalesce(F.nullif(m["role"], F.lit("")), m["from"]).isin(*who)), F.lit(0))
    return T.first_filled(first["content"], first["value"])


def consultations(df: DataFrame, source: str, topic: str = "Dental Consultation") -> DataFrame:
    q, a = field(df, "input", "question", "instruction"), field(df, "output", "answer", "response")
    return _rows(df.where(relevant(q, a)), q, a, source, F.lit(topic))


def forum(df: DataFrame, source: str, topic: str = "Dental Consultation") -> DataFrame:
    """Rows of title, dialogue: both question and answer must be relevant, the answer 40 characters at least."""
    turned = df.select("title", dialogue_turns(F.col("dialogue")).alias("turns"))
    pairs = turned.select("title", dialogue_question_answer(F.col("title"), F.col("turns")).alias("p")).where("p is not null").select("title", "p.*")
    pairs = pairs.where((n_chars(F.col("answer")) >= 40) & relevant(F.col("title"), F.col("first")) & relevant(F.col("answer")))
    return _rows(pairs, F.col("question"), F.col("answer"), source, F.lit(topic))


def instructions(df: DataFrame, source: str, topic: str) -> DataFrame:
    pairs = df.select(instruction_pair(field(df, "text", "Text")).alias("p")).where("p is not null").select("p.*")
    return _rows(pairs, F.col("question"), F.col("answer"), source, F.lit(topic))


def research_questions(df: DataFrame, source: str, topic: str = "Dental Research QA") -> DataFrame:
    """Rows of question, context (contexts, labels, meshes), final_decision, long_answer."""
    context = T.labelled_context(F.col("context.contexts"), F.col("context.labels"))
    q, long_, final = strip(text_of(F.col("question"))), strip(text_of(F.col("long_answer"))), F.lower(strip(text_of(F.col("final_decision"))))
    asked = F.concat(q, F.when(context != "", F.concat(F.lit("\n\nContext:\n"), F.left(context, F.lit(6000)))).otherwise(F.lit("")))
    answer = F.when((long_ != "") & (final != ""), F.concat(T.capitalised(final), F.lit(". "), long_)).when(long_ != "", long_).when(final != "", T.capitalised(final))
    found = df.where((q != "") & answer.isNotNull() & (headings_relevant(F.col("context.meshes")) | relevant(q, context, long_)))
    return _rows(found, asked, answer, source, F.lit(topic))


def validated_questions(df: DataFrame, source: str, topic_col: str) -> tuple[DataFrame, DataFrame]:
    """Question rows of 15 and 30 characters at least that are not marked incorrect, and texts "Q: A:" of 100."""
    rows = df.where(text_of(F.col("validity")) != "incorrect").select(strip(text_of(F.col("question"))).alias("question"), strip(text_of(F.col("answer"))).alias("answer"), F.lit(source).alias("source"), F.col(topic_col).alias("topic"))
    sft = rows.where((n_chars(F.col("question")) >= 15) & (n_chars(F.col("answer")) >= 30))
    text = F.concat(F.lit("Q: "), F.col("question"), F.lit("\nA: "), F.col("answer"))
    return sft, rows.select(text.alias("text"), "source").where(n_chars(F.col("text")) >= 100)


def described_rows(df: DataFrame, source: str) -> DataFrame:
    """Every row's string columns as lines "name: value", of values longer than 5 characters; 100 at least."""
    names = [n for n, kind in df.dtypes if kind == "string"]
    text = F.concat_ws("\n", *[F.when(n_chars(F.col(n)) > 5, F.concat(F.lit(f"{n}: "), F.col(n))) for n in names])
    return df.select(text.alias("text"), F.lit(source).alias("source")).where(n_chars(F.col("text")) >= 100)


def keyed_options(df: DataFrame, source: str) -> DataFrame:
    """Rows of question, answer (a key), options (a map), explanation: at least two words of the field in all."""
    chosen = F.coalesce(F.try_element_at("options", F.col("answer")), F.col("answer"))
    a = F.concat_ws("\n\n", chosen, F.nullif(text_of(F.col("explanation")), F.lit("")))
    return _rows(df.where(whole_word_hits(F.concat_ws(" ", "question", chosen, "explanation")) >= 2), F.col("question"), a, source, F.lit("Dentistry"))


def trial_text(df: DataFrame) -> DataFrame:
    """text, source of trials (nested protocolSection): sections behind headings, 300 characters at least."""
    p = F.col("protocolSection")
    filled = lambda c: F.nullif(c, F.lit(""))
    title = F.coalesce(filled(p["identificationModule"]["officialTitle"]), filled(p["identificationModule"]["briefTitle"]))
    part = lambda head, c: F.when(text_of(c) != "", F.concat(F.lit(head), c))
    action = lambda i: F.concat(F.lit("- "), text_of(F.coalesce(filled(i["name"]), i["type"])), F.when(text_of(i["description"]) != "", F.concat(F.lit(": "), i["description"])).otherwise(F.lit("")))
    out = p["outcomesModule"]
    text = F.concat_ws(
        "\n\n", part("Title: ", title), part("Conditions: ", F.array_join(p["conditionsModule"]["conditions"], ", ")), part("Summary: ", p["descriptionModule"]["briefSummary"]),
        part("Detailed Description: ", p["descriptionModule"]["detailedDescription"]), part("Interventions:\n", F.array_join(F.transform(p["armsInterventionsModule"]["interventions"], action), "\n")),
        part("Eligibility Criteria:\n", p["eligibilityModule"]["eligibilityCriteria"]), part("Primary Outcomes:\n", outcomes(out["primaryOutcomes"])), part("Secondary Outcomes:\n", outcomes(out["secondaryOutcomes"])),
    )
    rows = df.select(strip(text).alias("text"), F.concat(F.lit("ctgov:"), text_of(p["identificationModule"]["nctId"])).alias("source"))
    return rows.where(n_chars(F.col("text")) >= 300)


def outcomes(c: Column) -> Column:
    def line(o: Column) -> Column:
        more = F.when(text_of(o["description"]) != "", F.concat(F.lit(": "), o["description"])).otherwise(F.lit(""))
        time = F.when(text_of(o["timeFrame"]) != "", F.concat(F.lit(" (timeframe: "), o["timeFrame"], F.lit(")"))).otherwise(F.lit(""))
        return F.concat(F.rtrim(F.concat(F.lit("- "), text_of(o["measure"]))), more, time)

    return F.array_join(F.transform(c, line), "\n")


def trial_questions(df: DataFrame, templates: dict[str, list[str]], topic: str = "Clinical Research") -> DataFrame:
    """Up to four questions of each trial: brief, eligibility, outcomes, methods. templates: for each of these,
    questions with {t} for the title and {c} for conditions; a trial always gets the same one."""
    p = F.col("protocolSection")
    filled = lambda c: F.nullif(c, F.lit(""))
    title = F.coalesce(filled(p["identificationModule"]["officialTitle"]), filled(p["identificationModule"]["briefTitle"]))
    nct = text_of(p["identificationModule"]["nctId"])
    seed = F.coalesce(filled(nct), title)
    detail = text_of(p["descriptionModule"]["detailedDescription"])
    conditions = F.array_join(F.slice(F.coalesce(p["conditionsModule"]["conditions"], F.array().cast("array<string>")), 1, 4), ", ")
    answers = {
        "brief": (text_of(p["descriptionModule"]["briefSummary"]), 80), "eligibility": (text_of(p["eligibilityModule"]["eligibilityCriteria"]), 80),
        "outcomes": (text_of(outcomes(p["outcomesModule"]["primaryOutcomes"])), 50), "methods": (F.when(conditions != "", detail).otherwise(F.lit("")), 80),
    }
    items = []
    for name, (answer, least) in answers.items():
        q = F.replace(F.replace(template_choice(seed, templates[name], name), F.lit("{t}"), title), F.lit("{c}"), conditions)
        items.append(F.when(n_chars(answer) > least, F.struct(q.alias("question"), answer.alias("answer"))))
    rows = df.where(title.isNotNull()).select(F.concat(F.lit("ctgov:"), nct).alias("source"), F.explode(F.array_compact(F.array(*items))).alias("i"))
    return rows.select("i.question", "i.answer", "source", F.lit(topic).alias("topic"))


def article_rows(df: DataFrame, topic: str = "Dental Research Literature") -> tuple[DataFrame, DataFrame]:
    """Texts (abstracts of 150 characters) and questions (of 200) of parsed articles."""
    title, abstract = strip(text_of(F.col("title"))), strip(text_of(F.col("abstract")))
    journal, year = strip(text_of(F.col("journal"))), strip(text_of(F.col("year")))
    header = F.when((journal != "") | (year != ""), F.rtrim(F.concat(title, F.lit(" ("), journal, F.lit(" "), year, F.lit(")")))).otherwise(title)
    source = F.concat(F.lit("pubmed:"), text_of(F.col("pmid")))
    texts = df.where(n_chars(abstract) >= 150).select(F.concat(header, F.lit("\n\n"), abstract).alias("text"), source.alias("source"))
    q = F.concat(F.lit("Summarise the key findings of the dental research paper titled '"), title, F.lit("'."))
    return texts, df.where((title != "") & (n_chars(abstract) >= 200)).select(q.alias("question"), abstract.alias("answer"), source.alias("source"), F.lit(topic).alias("topic"))


def evaluation_pack(mcq: DataFrame, open_: DataFrame, forums: DataFrame, n: tuple[int, int, int] = (250, 250, 500), seed: str = "42") -> DataFrame:
    """One table of evaluation rows: multiple choice with all four options, correct open questions of 20 and 80
    characters, and forum questions with a doctor's reply, 40 each; so many of each at random."""
    from ..operators.rows import sample

    c = T.forum_text
    choice = mcq.where(F.forall(F.array("opa", "opb", "opc", "opd"), lambda o: c(o) != "") & F.col("cop").try_cast("int").between(0, 3))
    choice = choice.select(F.lit("mcq").alias("task"), c(F.col("question")).alias("question"), F.transform(F.array("opa", "opb", "opc", "opd"), c).alias("options"), F.col("cop").try_cast("int").alias("answer_index"), c(F.col("exp")).alias("reference_answer"))
    none = lambda t: F.lit(None).cast(t)
    plain = lambda df, q, a, task: df.select(F.lit(task).alias("task"), q.alias("question"), none("array<string>").alias("options"), none("int").alias("answer_index"), a.alias("reference_answer"))
    q, a = c(F.col("question")), c(F.col("answer"))
    asked = plain(open_.where((F.col("validity") == "correct") & (n_chars(q) >= 20) & (n_chars(a) >= 80)), q, a, "open_qa")
    reply = F.regexp_extract("dialogue", r"(?s)\bDr\.?\s*[A-Z]\w*:\s*(.*?)(?=\s+[A-Z][\w.]*:\s|\z)", 1)
    q, a = c(F.col("title")), c(reply)
    told = plain(forums.where((n_chars(q) >= 40) & (n_chars(a) >= 40)), q, a, "forum_qa")
    out = None
    for part, k in zip((choice, asked, told), n):
        chosen = sample(part.withColumn("id", F.sha1(F.concat_ws("|", "task", "question", "reference_answer"))), "id", k, seed)
        out = chosen if out is None else out.unionByName(chosen)
    return out.withColumn("answer_label", F.get(F.array(*[F.lit(x) for x in "ABCD"]), F.col("answer_index")))

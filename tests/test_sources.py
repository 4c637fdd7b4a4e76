import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from marlstone.operators import models as M
from marlstone.sources import files, markup, paged, records, sinks
from marlstone.streaming import ingest


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_json_lines(spark, tmp_path):
    p = write(tmp_path / "a.jsonl", '{"q": "one"}\n\n{bad\n{"q": "two", "z": 1}\n[1]\n')
    assert sorted(r.q for r in files.read_jsonl(spark, p, "q string").collect() if r.q) == ["one", "two"]
    with pytest.raises(Exception):
        files.read_jsonl_strict(spark, p, "q string").collect()
    rows = {r.line_number: (r.row.q if r.row else None, r.error) for r in files.read_jsonl_numbered(spark, p, "q string").collect()}
    assert rows == {1: ("one", None), 3: (None, "{bad"), 4: ("two", None), 5: (None, "[1]")}
    r = write(tmp_path / "r.jsonl", '{"text": "t1"}\n{"text": " "}\n{"text": "t2", "id": "x", "group": "g"}\n')
    assert sorted((x.text, x.source, x.group, x.subject) for x in files.read_records(spark, r, "d").collect()) == [("t1", "r_00000000", "d", "Unknown"), ("t2", "x", "g", "Unknown")]
    a = write(tmp_path / "arr" / "a.json", '[{"q": "x"}, {"q": "y"}]')
    write(tmp_path / "arr" / "b.json", '{"q": "no"}')
    assert sorted(x.q for x in files.read_json_arrays(spark, a.rsplit("/", 1)[0], "q string").collect()) == ["x", "y"]


def test_texts(spark, tmp_path):
    write(tmp_path / "x" / "b.txt", b"ok\xff!")
    write(tmp_path / "x" / "A.txt", "é".encode())
    got = {r.name: r.text for r in files.read_texts(spark, str(tmp_path / "x")).collect()}
    assert got == {"b": "ok\ufffd!", "A": "é"}
    assert {r.text for r in files.read_texts(spark, str(tmp_path / "x"), "ignore").collect()} == {"ok!", "é"}
    assert [r.name for r in files.pick_files(files.read_texts(spark, str(tmp_path / "x")), "a", 1).collect()] == ["A"]


def test_layouts(spark, tmp_path):
    write(tmp_path / "core_cpt_text" / "a.txt", "raw")
    write(tmp_path / "core_cpt_text_cleaned" / "a.txt", "clean")
    write(tmp_path / "selective_cpt_text" / "b.txt", "sel")
    rows = files.read_layout(spark, str(tmp_path)).collect()
    assert sorted((r.name, r.text, r.group) for r in rows) == [("a", "clean", "core"), ("b", "sel", "selective")]
    deep = tmp_path / "deep"
    write(deep / "g" / "c.txt", "x")
    assert [(r.name, r.group) for r in files.read_layout(spark, str(deep)).collect()] == [("c", "g")]
    write(deep / "d.txt", "y")
    assert [(r.name, r.group) for r in files.read_layout(spark, str(deep)).collect()] == [("d", "mixed")]
    spark.range(3).write.parquet(str(tmp_path / "p"))
    assert files.read_first(spark, str(tmp_path / "none"), str(tmp_path / "p")).count() == 3
    with pytest.raises(FileNotFoundError):
        files.read_first(spark, str(tmp_path / "none"))


def test_images(spark):
    df = spark.createDataFrame([("/x/b1/i10.png",), ("/x/b1/i2.png",), ("/x/b2/a.png",)], "path string")
    assert sorted((r.book, r.image, r.image_index, r.image_count) for r in files.image_records(df).collect()) == [("b1", "i10.png", 2, 2), ("b1", "i2.png", 1, 2), ("b2", "a.png", 1, 1)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("é", None), ("b", "x")], "a string, b string")
    assert sinks.write_jsonl(df, str(tmp_path / "o")) == 2 and sinks.write_jsonl(df, str(tmp_path / "e"), escape=True) == 2
    lines = "".join(p.read_text() for p in (tmp_path / "e").glob("part*"))
    assert "\\u00E9" in lines or "\\u00e9" in lines
    assert '"b":null' in "".join(p.read_text() for p in (tmp_path / "o").glob("part*"))
    made = sinks.publish({"sft": df.withColumn("split", F.when(F.col("a") == "b", "val").otherwise("train"))}, str(tmp_path / "pub"))
    assert spark.read.parquet(made["sft/validation"]).count() == 1


MARKDOWN = """# Title with [link](http://x.y)

- [x] done item
- plain item
| a | b |
|---|---|
```
code
```
![img](i.png)
Figure 1: caption
Some **bold** and _soft_ text &amp; more
continues here.
42
> quoted https://u.r/l end
All rights reserved.
"""


def test_markup(spark):
    row = lambda c: spark.range(1).select(c.alias("v")).first().v
    text = markup.text_of_markdown(MARKDOWN)
    assert text == "Title with link\n\ndone item\n\nplain item\n\nSome bold and soft text & more continues here. quoted end"
    assert "Figure 1: caption" in markup.text_of_markdown(MARKDOWN, keep_figures=True)
    assert row(markup.markdown_text(F.lit(MARKDOWN))) == text
    assert row(markup.html_text(F.lit("<nav>no</nav><p>One  two</p>\n<script>x</script><b>three</b>"))) == "One two\nthree"
    turns = F.lit("Ann: My tooth hurts\nDr. Bob: See me soon\nCarl: no\nDr. Bob: Really")
    pair = lambda t, c: spark.range(1).select(markup.dialogue_turns(c).alias("t")).select(markup.dialogue_question_answer(F.lit(t), F.col("t")).alias("v")).first().v
    got = pair("Help", turns)
    assert (got.question, got.answer) == ("Help\n\nMy tooth hurts", "See me soon\n\nReally")
    assert pair("t", F.lit("no marks")) is None
    p = row(markup.instruction_pair(F.lit("Instruction: / Q one / Response: / A two <eos>")))
    assert (p.question, p.answer) == ("Q one", "A two")
    p = row(markup.instruction_pair(F.lit("Instruction: Q: Response: A<eos>")))
    assert (p.question, p.answer) == ("Q", "A") and row(markup.instruction_pair(F.lit("nothing"))) is None
    d = row(markup.descriptors(F.lit("1: Tooth\nhard parts\nof the mouth\n\nTree Number(s): A14, C07\nEntry Term: Teeth\n")))
    assert (d.heading, d.scope_note, d.tree_numbers, d.entry_terms) == ("Tooth", "hard parts of the mouth", ["A14", "C07"], ["Teeth"])
    passages = F.array(*[F.struct(F.lit(t * 60).alias("text"), F.lit(s).alias("section_type")) for t, s in (("a", "INTRO"), ("b", "REF"))])
    assert row(markup.article_passages(passages)) == "a" * 60


XML = """<PubmedArticle><MedlineCitation><PMID>7</PMID><Article><ArticleTitle>A  title</ArticleTitle><Abstract><AbstractText Label="AIM">Do it.</AbstractText><AbstractText>Done.</AbstractText></Abstract>
<Journal><Title>J</Title><JournalIssue><PubDate><MedlineDate>1999 Jan</MedlineDate></PubDate></JournalIssue></Journal></Article><MeshHeadingList><MeshHeading><DescriptorName>Tooth</DescriptorName></MeshHeading></MeshHeadingList></MedlineCitation></PubmedArticle>"""


def test_articles(spark):
    rows = markup.parse_articles(spark.createDataFrame([(XML,), ("<PubmedArticle></PubmedArticle>",)], "x string"), "x").collect()
    assert [tuple(r) for r in rows] == [("7", "A title", "AIM: Do it.\nDone.", "J", "1999", ["Tooth"], [])]
    long = spark.createDataFrame([("7", "T", "a" * 200, "J", "1999"), ("8", "T", "a" * 149, "", "")], "pmid string, title string, abstract string, journal string, year string")
    texts, questions = records.article_rows(long)
    assert [r.text[:10] for r in texts.collect()] == ["T (J 1999)"] and questions.count() == 1


def test_records(spark):
    mcq = spark.createDataFrame([("Q one?", "a", "b", "c", "d", 1, "why", "Dental ", "T"), ("Q", "a", "", "c", "d", 1, "", "Dental", "T"), ("Q two?", "a", "b", "c", "d", 9, "", "dental", None), ("Q", "a", "b", "c", "d", 1, "", "Other", "T")],
                                "question string, opa string, opb string, opc string, opd string, cop int, exp string, subject_name string, topic_name string")
    assert [(r.answer, r.topic) for r in records.multiple_choice(mcq, "s").collect()] == [("B. b\n\nExplanation: why", "T")]
    exam = spark.createDataFrame([("Which tooth?", "2", [(1, "molar"), (2, "canine")], "cat"), ("Which?", "x", [(1, "a")], "cat")], "qtext string, ra string, answers array<struct<aid:int,atext:string>>, category string")
    assert [(r.answer, r.topic) for r in records.exam(exam, "s", "en").collect()] == [("B. canine", "Dentistry (EN/cat)")]
    chat = spark.createDataFrame([(None, [("system", None, "s", None), (None, "human", None, "my question"), ("assistant", None, "the answer", None)])], "question string, messages array<struct<role:string,from:string,content:string,value:string>>")
    assert [(r.question, r.answer) for r in records.question_answer(chat, "s", "t").collect()] == [("my question", "the answer")]
    qa = spark.createDataFrame([("Do teeth hurt?", (["x", "y"], ["A"], ["Tooth"]), "YES", "They do.")], "question string, context struct<contexts:array<string>,labels:array<string>,meshes:array<string>>, final_decision string, long_answer string")
    assert [(r.question, r.answer) for r in records.research_questions(qa, "s").collect()] == [("Do teeth hurt?\n\nContext:\nA: x", "Yes. They do.")]
    forum = spark.createDataFrame([("Tooth", "Ann: My tooth hurts\nDr. Bob: " + "your tooth is fine " * 4)], "title string, dialogue string")
    assert records.forum(forum, "s").count() == 1
    sft, cpt = records.validated_questions(spark.createDataFrame([("q" * 15, "a" * 90, "correct", "d"), ("q" * 15, "a" * 30, "incorrect", "d")], "question string, answer string, validity string, disease string"), "s", "disease")
    assert (sft.count(), cpt.count()) == (1, 1)
    assert records.described_rows(spark.createDataFrame([("c" * 100, 1, "no")], "code string, n int, d string"), "s").first().text == "code: " + "c" * 100
    keyed = spark.createDataFrame([("tooth and molar?", "A", {"A": "canine"}, None)], "question string, answer string, options map<string,string>, explanation string")
    assert records.keyed_options(keyed, "s").first().answer == "canine"


def test_trials(spark, tmp_path):
    trial = {"protocolSection": {"identificationModule": {"nctId": "N1", "briefTitle": "T"}, "descriptionModule": {"briefSummary": "b" * 100, "detailedDescription": "d" * 200}, "conditionsModule": {"conditions": ["c1", "c2"]},
             "armsInterventionsModule": {"interventions": [{"name": "i", "type": "t", "description": "x"}]}, "eligibilityModule": {"eligibilityCriteria": "e"}, "outcomesModule": {"primaryOutcomes": [{"measure": "m", "description": "dd", "timeFrame": "1y"}], "secondaryOutcomes": []}}}
    o = "array<struct<measure:string,description:string,timeFrame:string>>"
    schema = f"protocolSection struct<identificationModule:struct<nctId:string,officialTitle:string,briefTitle:string>,descriptionModule:struct<briefSummary:string,detailedDescription:string>,conditionsModule:struct<conditions:array<string>>,armsInterventionsModule:struct<interventions:array<struct<name:string,type:string,description:string>>>,eligibilityModule:struct<eligibilityCriteria:string>,outcomesModule:struct<primaryOutcomes:{o},secondaryOutcomes:{o}>>"
    df = files.read_jsonl(spark, write(tmp_path / "t.jsonl", json.dumps(trial)), schema)
    text = records.trial_text(df).first()
    assert text.source == "ctgov:N1" and "Interventions:\n- i: x" in text.text and "- m: dd (timeframe: 1y)" in text.text and "Secondary" not in text.text
    templates = {k: [k + " {t}", k + " of {t} for {c}"] for k in ("brief", "eligibility", "outcomes", "methods")}
    got = records.trial_questions(df, templates).collect()
    assert {r.question.split()[0] for r in got} == {"brief", "methods"}


def test_evaluation_pack(spark):
    mcq = spark.createDataFrame([(f"q{i}", "a", "b", "c", "d", i % 4, "e") for i in range(10)], "question string, opa string, opb string, opc string, opd string, cop int, exp string")
    open_ = spark.createDataFrame([("q" * 20, "a" * 80, "correct"), ("q" * 20, "a" * 80, "wrong")], "question string, answer string, validity string")
    forum = spark.createDataFrame([("t" * 40, "Dr M: " + "r" * 40)], "title string, dialogue string")
    rows = records.evaluation_pack(mcq, open_, forum, (4, 5, 5)).collect()
    assert sorted(r.task for r in rows) == ["forum_qa"] + ["mcq"] * 4 + ["open_qa"] and all(r.answer_label == "ABCD"[r.answer_index] for r in rows if r.task == "mcq")


def test_ranges_and_pages(spark):
    per_day = lambda a, b: (b - a).days + 1
    got = list(paged.split_ranges(date(2020, 1, 1), date(2020, 1, 31), per_day, most=5))
    assert sum(n for *_, n in got) == 31 and max(n for *_, n in got) <= 5 and all(a[1].toordinal() + 1 == b[0].toordinal() for a, b in zip(got, got[1:]))
    assert list(paged.split_ranges(date(2020, 1, 1), date(2020, 1, 2), lambda a, b: 0)) == []
    rows = paged.read_pages(spark, "pages_test", [0, 10, 20], lambda token: ((token + i,) for i in range(3)), "n int")
    assert sorted(r.n for r in rows.collect()) == [0, 1, 2, 10, 11, 12, 20, 21, 22]
    edges = spark.createDataFrame([("r", "a"), ("a", "b"), ("b", "r"), ("b", "c"), ("r", "c"), ("c", "d")], "parent string, child string")
    assert {r.category: r.depth for r in paged.walk_categories(edges, ["r"], 2).collect()} == {"r": 0, "a": 1, "c": 1, "b": 2, "d": 2}


def test_models(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "id int, t string")
    got = M.ask(df, F.col("t"), lambda: M.Echo("> ")).collect()
    assert {(r.id, r.answer) for r in got} == {(1, "> x"), (2, "> x"), (3, "> y")}
    cache = M.ask(df.limit(1), F.col("t"), lambda: M.Echo("old ")).select("key", "answer")
    assert {r.answer for r in M.ask(df, F.col("t"), lambda: M.Echo("new "), cache=cache).collect()} == {"old x", "new y"}
    good = "Teeth are made of enamel and dentin and pulp tissue. " * 6
    rows = spark.createDataFrame([(None,), ("<SKIP>",), ("short",), (good,)], "a string").select(M.cleaned_chunk(F.col("a")).alias("c")).collect()
    assert [r.c.status for r in rows] == ["err", "skip", "low_quality", "ok"]
    parts = spark.createDataFrame([("b", 1, "two", "2"), ("b", 0, "one", None), ("b", 2, "three", "")], "book string, i int, o string, a string")
    text = lambda how: M.reassemble(parts, "book", "i", "o", "a", how).first().text
    assert (text("keep"), text("light"), text("fail")) == ("one\n\n2", "one\n\n2", None)
    b = M.batched_prompts(df, "id", F.col("t"), "Tag:", size=2, slices=1)
    assert sorted(len(r.members) for r in b.collect()) == [1, 2]
    tags = M.tagged(spark.createDataFrame([([1, 2, 3], 'sure: ["A", "nope"]'), ([4], None)], "members array<int>, answer string"), ["A"]).collect()
    assert {r.id: r.topic for r in tags} == {1: "A", 2: "Dentistry", 3: "Dentistry", 4: "Dentistry"}
    answer = json.dumps({"items": [{"question": "q", "chosen": "c", "rejected": "r", "topic": "T"}]})
    items = M.generated_items(spark.createDataFrame([(1, answer, "src")], "k int, a string, s string"), ["k"], "a", "s", ["T"]).collect()
    assert [(r.k, r.item_idx, r.topic, r.verdict) for r in items] == [(1, 0, "T", "q_length")]


def test_limits():
    clock = [0.0]

    class Fails:
        def answer(self, prompt, system):
            return None

    sleep = lambda s: clock.__setitem__(0, clock[0] + s)
    m = M.Limited([M.Echo()], requests=2, now=lambda: clock[0], sleep=sleep)
    assert [m.answer("p", "") for _ in range(3)] == ["p"] * 3 and clock[0] >= 60
    assert M.Limited([Fails(), M.Echo()], now=lambda: clock[0], sleep=sleep).answer("p", "") == "p"
    assert M.Limited([Fails()], tries=2, now=lambda: clock[0], sleep=sleep).answer("p", "") is None


def test_streams(spark, tmp_path, sf_dir):
    src, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    write(src / "a.json", '{"k": "1", "t": "x"}\n{"k": "1", "t": "again"}\n{bad\n')
    run = lambda: ingest.ingest(spark, str(src), "k string, t string", "k", out, check).awaitTermination()
    run()
    assert spark.read.parquet(out).count() == 1
    write(src / "b.json", '{"k": "1", "t": "y"}\n{"k": "2", "t": "z"}\n')
    run()
    run()
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == ["1", "2"]
    events = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).parquet(f"{sf_dir}/events*.parquet")
    q = ingest.tumbling(events, "ts", "event_type").writeStream.format("memory").queryName("tumbled").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select sum(n) from tumbled").first()[0] == spark.read.parquet(f"{sf_dir}/events.parquet").count()

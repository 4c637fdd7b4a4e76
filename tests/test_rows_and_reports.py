import hashlib
import math

import pytest
from pyspark.sql import functions as F

from marlstone.operators import reports as R
from marlstone.operators import rows as O


@pytest.fixture(scope="module")
def ids(spark):
    return spark.range(500).withColumn("g", (F.col("id") % 7).cast("string"))


@pytest.mark.parametrize("n", [0, 1, 2, 19, 20, 21, 300])
def test_split_counts(spark, n):
    rows = O.split_train_val(spark.range(n), "id").collect()
    assert len(rows) == n and sum(r.split == "val" for r in rows) == (max(1, int(n * 0.05)) if n else 0)


@pytest.mark.parametrize("n", [1, 50, 333, 999])
def test_the_lowest_are_as_many_as_asked_for(spark, n):
    """Distinct keys, one key that all rows share, and rows that are equal in all."""
    rows = spark.range(1000)
    assert O.take_lowest(rows, O.draw("s", F.col("id")), n, 1000).where("taken").count() == n
    want = sorted(range(1000), key=lambda i: hashlib.sha1(f"s:{i}".encode()).hexdigest())[:n]
    assert sorted(r.id for r in O.take_lowest(rows, O.draw("s", F.col("id")), n, 1000).where("taken").collect()) == sorted(want)
    assert O.take_lowest(rows, O.draw("s", F.lit("same")), n, 1000).where("taken").count() == n
    with pytest.raises(ValueError):
        O.take_lowest(rows.select(F.lit(1).alias("k")), O.draw("s", F.col("k")), n, 1000)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_ranks_in_slices(spark, kind):
    rows = spark.range(700).select(((F.col("id") * 37) % 701).cast(kind).alias("o"))
    got = O.numbered(rows, "o", rows=64)
    values = sorted(r.o for r in rows.collect())
    assert {r.o: r.n for r in got.collect()} == {v: i for i, v in enumerate(values)}
    assert sorted(r.o for r in O.every_nth(rows, "o", 5, 64).collect()) == sorted(values[i * 140] for i in range(5))


def test_no_task_holds_a_whole_table(spark):
    """Ranks, splits, turns and packing plan no exchange to a single partition but for sums and limits."""
    from marlstone.operators import chunking as C

    df = spark.range(5000).select("id", (F.col("id") % 3).cast("string").alias("g"), F.array(F.col("id")).alias("t"))
    plans = [O.numbered(df, "id", rows=500), O.every_nth(df, "id", 7, 500), O.split_train_val(df, "id"), O.round_robin(df, "g", "id"), C.pack_tokens(df, "id", "t", 16, 500), O.split_by_group(df, "g", 0.3)]
    for p in plans:
        assert "SinglePartition" not in p._jdf.queryExecution().toString()


def test_splits_are_stable_and_whole(ids):
    a = {r.id: r.split for r in O.split_train_val(ids, "id").collect()}
    assert a == {r.id: r.split for r in O.split_train_val(ids.repartition(7), "id").collect()}
    rows = O.split_by_group(ids, "g", 0.3).collect()
    val = {r.g for r in rows if r.split == "val"}
    assert len(val) == 2 and not val & {r.g for r in rows if r.split == "train"}
    assert {r.split for r in O.split_by_group(ids.where("g = '1'"), "g", 0.3).collect()} == {"train"}


def test_stratified(spark):
    df = spark.createDataFrame([(f"{s}{i}", s) for s, n in (("a", 2), ("b", 3), ("c", 100)) for i in range(n)], "k string, s string")
    count = lambda **k: {r.s: r.n for r in O.split_stratified(df, "s", "k", **k).where("split = 'val'").groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert count() == {"b": 1, "c": 1} and count(most=0) == {"b": 1, "c": 8} and count(share=0.0) == {}


def test_samples(ids):
    assert O.sample(ids, "id", 10).count() == 10 and O.every_nth(ids, "id", 7).count() == 7
    assert sorted(r.id for r in O.every_nth(ids, "id", 5).collect()) == [0, 100, 200, 300, 400] and O.every_nth(ids, "id", 501).count() == 0


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")], "ord int, v string, k string")
    assert sorted(r.v for r in O.first_wins(df, F.col("k"), "ord").collect()) == ["a", "c"] and sorted(r.v for r in O.last_wins(df, F.col("k"), "ord").collect()) == ["b", "c"]
    assert O.first_wins(df, F.col("k"), "ord").columns == df.columns


def test_coercion(spark):
    df = spark.createDataFrame([(None, "a long prompt", "a response of twenty chars", " ", None), ("  ", "hidden by blanks", "a response of twenty chars", "s", "t")], "question string, prompt string, answer string, source string, topic string")
    rows = O.coerce_sft(df).collect()
    assert [(r.question, r.source, r.topic) for r in rows] == [("a long prompt", "", "Dentistry")]
    assert O.coerce_cpt(spark.createDataFrame([("x" * 49,), ("y" * 50,)], "text string")).count() == 1


def test_one_key_space(spark):
    q = spark.createDataFrame([(0, 0, "What is it?"), (0, 1, "what IS it")], "src_rank int, ord int, question string")
    t = spark.createDataFrame([(0, 0, "What is it!"), (0, 1, "Another text")], "src_rank int, ord int, text string")
    a, b = O.dedup_across_shapes(q, t)
    assert (a.count(), [r.text for r in b.collect()]) == (1, ["Another text"])


def test_overlays(spark):
    mk = lambda rows: spark.createDataFrame(rows, "name string, text string")
    out = O.core_then_selective(mk([("a", "raw"), ("b", "raw b")]), mk([("a", "clean"), ("z", "none")]), mk([("b", "sel"), ("c", "sel c")]))
    assert sorted((r.name, r.text, r.group) for r in out.collect()) == [("a", "clean", "core"), ("b", "raw b", "core"), ("c", "sel c", "selective")]
    lost = O.restore_destroyed(mk([("a", "x" * 100), ("b", "x" * 100)]), mk([("a", "x" * 4), ("b", "x" * 5)])).collect()
    assert [(r.name, r.ratio) for r in lost] == [("a", 0.04)]


def test_schedules(spark):
    df = spark.createDataFrame([(f"d{i}", "core" if i % 2 else "sel", f"s{i % 3}") for i in range(12)], "k string, g string, s string")
    turns = O.round_robin(df, "s", "k").collect()
    assert sorted(r.turn for r in turns) == [i for i in range(4) for _ in range(3)] and len({(r.turn, r.place) for r in turns}) == 12
    rows = O.schedule(df, "g", "s", "k", core_epochs=2, mixed_epochs=1, weight=2.0).collect()
    assert sum(r.stage == 1 for r in rows) == 12 and sum(r.stage == 2 for r in rows) == 18
    copies = O.oversample(df, "g", "core", 2.5, "k").groupBy("g").count().collect()
    assert {r.g: r["count"] for r in copies}["sel"] == 6 and 12 <= {r.g: r["count"] for r in copies}["core"] <= 18
    assert spark.range(1).select(O.template_choice(F.lit("e"), ["a"]).alias("v")).first().v == "a"


def test_reports(spark):
    df = spark.createDataFrame([("q1", "a", "s"), ("Q1!", "b", "s"), ("q2", "a", None), ("q2", "a", "t"), ("", "x", "s")], "question string, answer string, source string")
    k = R.pair_keys(df)
    r = R.duplicate_report(k).first()
    assert (r.n_rows, r.distinct_questions, r.repeated_question_extras, r.distinct_pairs, r.duplicate_pair_extras, r.contradictions, r.duplication_rate_pct) == (4, 2, 2, 3, 1, 1, 50.0)
    assert {x.bucket: x.questions for x in R.multiplicities(k).collect()} == {"2": 2} and R.contradictions(k).count() == 1
    assert R.duplicate_report(k.where("false")).first().duplication_rate_pct == 0


def test_accuracy(spark):
    mk = lambda rows: spark.createDataFrame(rows, "id int, correct boolean, ord int")
    r = R.compare_accuracy(mk([(1, False, 0), (2, True, 0), (3, True, 0), (3, False, 1)]), mk([(1, True, 0), (2, False, 0), (3, True, 0), (4, True, 0)]), "ord").first()
    assert (r.improvements, r.regressions, r.net_improvement, r.baseline_correct, r.candidate_accuracy) == (2, 1, 1, 2, 0.75)
    a = R.accuracy(mk([(1, None, 0), (2, True, 0), (3, False, 0)])).first()
    assert (a.scored, a.correct, a.accuracy) == (2, 1, 0.5) and R.accuracy(mk([])).first().accuracy is None


def test_repetition(spark):
    """Written by hand: the text and whether it repeats itself."""
    ten = " ".join(f"w{i}" for i in range(10))
    cases = [
        ("", False), ("a. a. a. b", True), ("a. a. a", False), ("a. b. a. c", False), (". . . . ", False), (ten + " x " + ten, True),
        (ten + " x y " + " ".join(f"v{i}" for i in range(12)), False), ("one " * 21, True), ("one " * 20, False), ("w " + ten[:-1] + " q " + ten, True),
        # The ten words as text: the first may end a longer word, the last begin one, but not those within.
        (ten + " x m" + ten + "n", True), (ten + " x " + ten.replace("w4", "w44"), False), (ten + " x " + ten.replace("w0", "v0"), False), (ten + " " + ten + " x", True), (ten.replace("w9", "w8") + " y " + ten, False),
        (" ".join(f"{i % 12}" for i in range(60)), True), (" ".join(f"{i}" for i in range(4000)), False), ("é ü " * 15, True),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    assert [r.v for r in df.select("i", R.has_repetition(F.col("t")).alias("v")).orderBy("i").collect()] == [v for _, v in cases]
    b = lambda x, y: df.limit(1).select(R.better_answer(F.lit(x), F.lit(y)).alias("v")).first().v
    assert b("x", "x" * 300) == "candidate" and b("a\nb", "ab") == "baseline" and b("", "") == "tie"


def test_small_reports(spark):
    df = spark.createDataFrame([("x" * 2000,), ("y",), (None,)], "text string")
    assert tuple(R.preparation_summary(df).first()) == (3, 1, 2, 2000)
    assert math.isinf(spark.range(1).select(R.perplexity(F.lit(1e6)).alias("v")).first().v)
    a = spark.createDataFrame([('{"k":1,"score":4,"flags":["x"]}',), ('{"score":2}',), ("bad",)], "a string")
    r = R.annotation_report(a, "a", ("k", "score"), "score", "flags").first()
    assert (r.rows, r.invalid, r.missing_keys, r.flagged, r.mean_score, r.examples) == (3, 1, 1, 1, 3.0, ["bad"])
    top = R.top_k(spark.createDataFrame([(0, "b"), (1, "a"), (2, "a"), (3, "c")], "o int, k string"), "k", 2, "o").collect()
    assert [(r.k, r.n) for r in top] == [("a", 2), ("b", 1)]

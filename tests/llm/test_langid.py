import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from marlstone.llm import langid
from marlstone.llm.queries import held_out


def test_counts_equal_brute_force():
    def grams(text):
        out, space = [" "], True
        for c in text.lower():
            if c.isalpha():
                out.append(c)
                space = False
            elif not space or out == [" "]:
                out.append(" ")
                space = True
        return Counter(("".join(out[i : i + n]) for n in (2, 3) for i in range(len(out) - n + 1)))

    for text in ("Hello, wörld! 12 ab", "x", "漢字 and ß"):
        c = langid.counts(text)
        assert c.sum() == sum(grams(text).values())
        assert 0 < np.count_nonzero(c) <= len(grams(text))
    for text in ("", "12 !? 3", "\n"):
        assert langid.counts(text) is None


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = "Lorem ipsum dolor sit amet " * 50
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "_PIECE", 100)
    assert np.allclose(langid.counts(text), whole)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.fit(docs, ~held_out("doc_id", 3, 1), train_rows=300)
    assert sorted(set(model.languages)) == ["de", "en", "es", "fr"] and len(model.languages) == 16
    rows = langid.identify(docs.where(held_out("doc_id", 3, 1)), model).select("lang", "lang_pred", "score", "rejected", "text").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    assert sum(r.rejected for r in rows) / len(rows) < 0.005
    r = rows[0]
    assert (r.lang_pred, r.score, r.rejected) == model.predict(r.text)


def test_far_texts_are_rejected(docs):
    model = langid.fit(docs, F.lit(True))
    name, cosine, rejected = model.predict("汉语是世界上使用人数最多的语言之一" * 20)
    assert rejected and 0 <= cosine < 0.2 and name in model.languages


def test_odd_rows(odd, empty, docs):
    model = langid.fit(docs, F.lit(True))
    rows = langid.identify(odd, model).select("doc_id", "text", "lang_pred", "score", "rejected").collect()
    assert len(rows) == 12
    for r in rows:
        none = r.text is None or not any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == none and (not none or (r.score == 0 and r.rejected))
    assert langid.identify(empty, model).collect() == []
    nothing = langid.fit(empty, F.lit(True))
    assert {r.lang_pred for r in langid.identify(odd, nothing).collect()} == {"und"}


def test_every_language_is_learned(spark):
    """However many there are; the rows of each are fewer then."""
    r = np.random.default_rng(9)
    rows = []
    for k in range(410):
        letters = r.choice(list("abcdefghijklmnopqrstuvwxyzäöüßéèñçøåæœþðłšžčřůő"), 12, replace=False)
        lexicon = ["".join(r.choice(letters, 5)) for _ in range(12)]
        rows += [(10 * k + i, " ".join(r.choice(lexicon, 40)), f"l{k:03}") for i in range(1 + (k < 400))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, F.lit(True), most_rows=410)
    assert set(model.languages) == {lang for _, _, lang in rows}
    rare = [(text, lang) for _, text, lang in rows if lang >= "l400"]
    assert all(model.predict(text)[::2] == (lang, False) for text, lang in rare)


def plain_model(rows, k=4):
    """{language: (centroids as {coordinate: value}, floor)} and the weights, by loops over plain dictionaries."""
    counts = [(lang, {int(i): float(c[i]) for i in np.flatnonzero(c)}) for lang, text in rows if (c := langid.counts(text)) is not None]
    df = Counter(i for _, c in counts for i in c)
    idf = {i: math.log((1 + len(counts)) / (1 + df[i])) + 1 for i in range(langid.DIMS)}
    unit = lambda v: {i: x / n for i, x in v.items()} if (n := math.sqrt(sum(x * x for x in v.values()))) else v
    dot = lambda a, b: sum(x * b.get(i, 0.0) for i, x in a.items())
    out = {}
    for lang in sorted({name for name, _ in counts}):
        x = [unit({i: n * idf[i] for i, n in c.items()}) for name, c in counts if name == lang]
        mean = {i: sum(v.get(i, 0.0) for v in x) for v in x for i in v}
        c = [max(x, key=lambda v: dot(v, mean))]
        while len(c) < min(k, len(x)):
            c.append(min(x, key=lambda v: max(dot(v, y) for y in c)))
        for _ in range(12):
            own = [max(range(len(c)), key=lambda j: dot(v, c[j])) for v in x]
            for j in range(len(c)):
                mine = [v for v, o in zip(x, own) if o == j]
                c[j] = unit({i: sum(v.get(i, 0.0) for v in mine) for v in mine for i in v}) if mine else c[j]
        near = sorted(max(dot(v, y) for y in c) for v in x)
        at = 0.01 * (len(near) - 1)
        low = near[int(at)] + (near[min(len(near) - 1, int(at) + 1)] - near[int(at)]) * (at - int(at))
        out[lang] = c, 0.6 * low
    return out, idf


def test_model_and_predictions_equal_brute_force(spark, docs):
    """Centroids, floors, languages, cosines and rejections of a whole small table."""
    rows = [r for r in docs.collect() if r.doc_id is not None][:90]
    learned = sorted((r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.lang is not None), key=lambda r: r.doc_id)
    df = spark.createDataFrame(rows, docs.schema)
    ordered = df.where(~held_out("doc_id", 3, 1) & F.col("lang").isNotNull()).orderBy(F.xxhash64("doc_id")).select("lang", "text").collect()
    assert len(ordered) == len(learned)
    plain, idf = plain_model([(r.lang, r.text or "") for r in ordered])
    model = langid.fit(df, ~held_out("doc_id", 3, 1))
    assert model.languages == [lang for lang, (c, _) in plain.items() for _ in c]
    assert np.allclose(model.idf, [idf[i] for i in range(langid.DIMS)])
    flat = [(lang, v, floor) for lang, (c, floor) in plain.items() for v in c]
    for j, (_, v, floor) in enumerate(flat):
        assert abs(model.floors[j] - floor) < 1e-4 and np.allclose(model.centroids[:, j], [v.get(i, 0.0) for i in range(langid.DIMS)], atol=1e-4)
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    for r in rows:
        c = langid.counts(r.text or "")
        if c is None:
            assert got[r.doc_id].lang_pred == "und"
            continue
        v = {int(i): c[i] * idf[int(i)] for i in np.flatnonzero(c)}
        norm = math.sqrt(sum(x * x for x in v.values()))
        cosines = [sum(x * y.get(i, 0.0) for i, x in v.items()) / norm for _, y, _ in flat]
        best = max(range(len(flat)), key=lambda j: cosines[j])
        n = len(v)
        assert abs(got[r.doc_id].score - cosines[best]) < 1e-4 and got[r.doc_id].lang_pred == flat[best][0]
        if abs(cosines[best] - flat[best][2] * (n / (n + 200)) ** 0.5) > 1e-3:
            assert got[r.doc_id].rejected == (cosines[best] < flat[best][2] * (n / (n + 200)) ** 0.5)


def test_repeated_rows_teach_once(spark, docs):
    some = docs.limit(40)
    a, b = langid.fit(some, F.lit(True)), langid.fit(some.unionByName(some).unionByName(some), F.lit(True))
    assert a.languages == b.languages and np.allclose(a.centroids, b.centroids) and np.allclose(a.idf, b.idf)

from collections import Counter

import pytest

import corpus_pipeline as cp
from marlstone.llm import toxicity
from marlstone.llm.queries import language_model, toxicity_model

from .test_jaccard import brute as classes
from .test_mixing import brute as mixed
from .test_packing import whole


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in cp.STAGES:
        before, docs = docs, stage(spark, docs, sf_dir).cache()
        out.append((before.collect(), docs.collect(), docs.columns))
    return out


def test_each_stage_equals_brute_force(spark, sf_dir, stages):
    model = toxicity_model(spark, sf_dir)
    dense, features = model.dense(), toxicity.Features()
    toxic = lambda t: model.bias + dense[features.distinct(t or "")].sum() >= 0
    rows, kept, columns = stages[0]
    assert columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(kept) == sorted(r for r in rows if not toxic(r.text)) and len(kept) < len(rows)
    rows, kept, columns = stages[1]
    m = language_model(spark, sf_dir)
    assert sorted(kept) == sorted(r for r in rows if not m.predict(r.text)[2])
    rows, kept, _ = stages[2]
    rows = sorted(rows)
    firsts = {first for first, _ in classes([(r.doc_id, r.text) for r in rows])}
    assert sorted(kept) == [r for i, r in enumerate(rows) if i in firsts] and len(kept) < len(rows)
    rows, kept, _ = stages[3]
    want = {doc_id: copies for doc_id, *_, copies in mixed(rows) if copies}
    assert Counter(r.doc_id for r in kept) == want
    rows, packed, _ = stages[4]
    assert len(packed) >= len(rows)
    from marlstone.llm.packing import LENGTHS

    whole(packed, rows, LENGTHS)


def test_run_equals_the_stages(spark, sf_dir, stages):
    key = lambda r: (r.doc_id, r.piece, r.length)
    assert sorted(map(key, cp.run(spark, sf_dir).collect())) == sorted(map(key, stages[-1][1]))


def test_odd_rows(spark, sf_dir, odd, empty):
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, odd, sf_dir).columns == odd.columns
        assert stage(spark, empty, sf_dir).collect() == []

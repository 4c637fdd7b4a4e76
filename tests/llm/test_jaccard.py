import random
from itertools import combinations

import numpy as np
import pytest

from marlstone.llm import jaccard as jc
from marlstone.llm.components import components

from .conftest import words


def brute(rows, threshold=0.8):
    """{row number: (class as its first row, links)} by comparing all pairs."""
    sets = [set(jc.Shingler()(t or "").tolist()) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return [(root(i), links[i]) for i in range(len(rows))]


def same(df, rows):
    """Whether the classes and links of df, with distinct ids, are those of brute force."""
    got = {r.doc_id: r for r in jc.similarity_classes(df).collect()}
    assert len(got) == len(rows)
    for (doc_id, _), (first, links) in zip(rows, brute(rows)):
        assert got[doc_id].n_links == links, doc_id
        assert got[doc_id].class_id == rows[first][0]


def test_equals_brute_force(docs):
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    same(docs, rows)


def copies(n, seed=0):
    """Near copies of one text, at all distances, and unrelated texts that share a passage."""
    r = random.Random(seed)
    base, passage, rows = words(1, 120).split(), words(2, 30), []
    for i in range(n):
        text = list(base)
        for _ in range(r.randrange(9)):
            text[r.randrange(len(text))] = f"edit{r.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    rows += [(n + i, words(100 + i, 150) + " " + passage) for i in range(n)]
    return rows


@pytest.mark.parametrize("small,block", [(64, 192), (6, 20)])
def test_large_groups_of_near_copies(spark, monkeypatch, small, block):
    monkeypatch.setattr(jc, "SMALL", small)
    monkeypatch.setattr(jc, "BLOCK", block)
    rows = copies(120)
    same(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def shares(a, b, runs, depth):
    """Whether two sets have a path of so many choices in common."""
    ends = jc.first_ends(runs)
    for _ in range(depth):
        ends = np.intersect1d(jc.chosen(a, ends, 0.8), jc.chosen(b, ends, 0.8))
    return bool(len(ends))


def test_recall_of_the_paths():
    """Pairs at the threshold share a first choice, and a third one, as often as the runs are counted on."""
    r, hits = random.Random(5), {1: 0, 3: 0}
    for _ in range(150):
        common = r.sample(range(2**32), 160)
        a, b = (np.array(sorted(common + r.sample(range(2**32), 20)), dtype=np.uint32) for _ in range(2))
        for depth in hits:
            hits[depth] += shares(a, b, jc.runs_for(0.99), depth)
    assert hits[1] >= 148 and hits[3] >= 145


def test_recall_of_contained_sets():
    """Text appended or cut off: the smaller set is part of the larger one, at the threshold."""
    r, hits, runs = random.Random(8), 0, jc.runs_for(0.99)
    for _ in range(1500):
        b = np.array(r.sample(range(2**32), 100), dtype=np.uint32)
        hits += shares(np.sort(b[:80]), np.sort(b), runs, 3)
    assert hits / 1500 >= 0.985


def groups_of(df, monkeypatch):
    """The sizes of the groups that are verified, greatest first."""
    seen, real = [], jc.components
    monkeypatch.setattr(jc, "components", lambda e: seen.append(real(e)) or seen[-1])
    rows = jc.similarity_classes(df).collect()
    return rows, sorted((r["count"] for r in seen[0].groupBy("component").count().collect()), reverse=True)


def test_a_shared_passage_makes_no_group(spark, monkeypatch):
    """800 unrelated texts with one passage of 60 words: a Jaccard of about 0.2, in one bucket at times."""
    passage = words(2, 60)
    rows = [(i, words(1000 + i, 100, 10**6) + " " + passage) for i in range(800)]
    rows, sizes = groups_of(spark.createDataFrame(rows, "doc_id long, text string"), monkeypatch)
    assert len(rows) == 800 and all(r.class_size == 1 and r.n_links == 0 for r in rows)
    assert sum(sizes) <= 8


def test_many_near_copies(spark):
    """5,000 texts with one word of their own each, and their exact link counts."""
    base = words(4, 60).split()
    rows = [(i, " ".join([*base[:-1], f"own{i}"])) for i in range(5000)]
    got = jc.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 5000 and {(r.class_id, r.class_size, r.n_links) for r in got} == {(0, 5000, 4999)}


def test_sketches_estimate():
    r = random.Random(6)
    common = r.sample(range(2**32), 800)
    a, b = (np.array(sorted(common + r.sample(range(2**32), 100)), dtype=np.uint32) for _ in range(2))
    assert abs(jc.sketches_alike(jc.sketch_of(a), jc.sketch_of(b)) - 0.8) < 0.12


def test_common_tokens():
    r = random.Random(7)
    sets = [np.array(sorted(r.sample(range(300), r.randint(1, 200))), dtype=np.uint32) for _ in range(12)]
    both = jc.common_tokens(sets)
    for i, j in combinations(range(12), 2):
        assert both[i, j] == len(set(sets[i].tolist()) & set(sets[j].tolist()))


def test_components(spark):
    r = random.Random(8)
    edges = [(i, i + 1) for i in range(200)] + [(r.randrange(1000, 1400), r.randrange(1000, 1400)) for _ in range(250)] + [(5000, i) for i in range(5001, 5200)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for e in edges for x in e if e[0] != e[1]}


def test_odd_rows(odd, empty):
    rows = jc.similarity_classes(odd).collect()
    assert len(rows) == 12
    assert all(r.n_links == 0 and r.class_size == 1 for r in rows if r.doc_id in (1, 2, 3))
    group = [r for r in rows if r.class_size == 3]
    assert [sorted(r.doc_id for r in group), {r.class_id for r in group}, {r.n_links for r in group}] == [[5, 5, 6], {5}, {2}]
    assert jc.similarity_classes(empty).collect() == []


def test_representatives(odd, empty, docs):
    kept = jc.representatives(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert len(rows) == 10 and sum(r.text == "one two three four five six seven" for r in rows) == 1
    assert jc.representatives(empty).collect() == []
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    firsts = {rows[first][0] for first, _ in brute(rows)}
    assert {r.doc_id for r in jc.representatives(docs).collect()} == firsts


def drifting(n):
    """Each text differs from the one before by one word: a class that only its chain holds together."""
    text, rows = words(11, 60).split(), []
    for i in range(n):
        text[(7 * i) % 60] = f"drift{i}"
        rows.append((10_000 + i, " ".join(text)))
    return rows


@pytest.mark.parametrize("block", [20, 192])
def test_classes_without_links(spark, monkeypatch, block):
    """The classes are those of all pairs, also where a group has several, or none that holds most of it."""
    monkeypatch.setattr(jc, "BLOCK", block)
    monkeypatch.setattr(jc, "MOST_BLOCK", block)
    monkeypatch.setattr(jc, "PIVOTS", 2)
    rows = copies(120) + drifting(90) + [(-1, ""), (-2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    roots, least = [first for first, _ in brute(rows)], {}
    for (doc_id, _), first in zip(rows, roots):
        least[first] = min(doc_id, least.get(first, doc_id))
    firsts = [least[first] for first in roots]
    got = jc.similarity_classes(df, links=False)
    assert "n_links" not in got.columns
    assert {r.doc_id: r.class_id for r in got.collect()} == {rows[i][0]: f for i, f in enumerate(firsts)}
    assert {r.doc_id for r in jc.representatives(df).collect()} == set(firsts)


def test_representatives_of_many_near_copies_move_each_set_once(spark, monkeypatch, tmp_path):
    """Of 3,000 near copies one stays, and not all pairs of them are compared for that."""
    real, at = jc._verify, str(tmp_path)

    def counted(threshold):
        run = real(threshold)

        def count(batches):
            import uuid

            def passed():
                with open(f"{at}/{uuid.uuid4().hex}", "w") as out:
                    for b in batches:
                        print(b.num_rows, file=out)
                        yield b

            yield from run(passed())

        return count

    monkeypatch.setattr(jc, "_verify", counted)
    base = words(4, 60).split()
    rows = [(i, " ".join([*base[:-1], f"own{i}"])) for i in range(3000)]
    assert [r.doc_id for r in jc.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()] == [0]
    assert sum(int(x) for f in tmp_path.iterdir() for x in f.read_text().split()) < 2 * 3000


@pytest.mark.parametrize("most", [8192, 0])
def test_rows_of_some_nodes(spark, monkeypatch, most):
    """By bitmaps, or a join where they would be too many: numbers at the ends of bitmaps and of tasks, repeated ones."""
    monkeypatch.setattr(jc, "MOST_MAPS", most)
    near = [0, 1, 7, 8, 9, 32766, 32767, 32768, 32769, 32770, 65536, 65537, (1 << 33) - 1, 1 << 33, (1 << 33) + 1, 5 << 33, (5 << 33) + 40_000]
    wide = spark.createDataFrame([(n, f"{n}") for n in [*near, *near]], "node long, tokens string")
    for ids in (near[::2], near[1::2], near + near, [], [3, 32771, 2 << 33]):
        got = jc._picker(spark.createDataFrame([(n,) for n in ids], "node long"))(wide)
        assert got.columns == wide.columns
        assert sorted(r.node for r in got.collect()) == sorted(n for n in [*near, *near] if n in ids)


def shuffled(spark):
    """Bytes that all stages so far have written to shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_sets_that_meet_nothing_are_not_moved(spark):
    """Also where no table is small enough for Spark to broadcast it of its own accord, as in large inputs."""
    rows = [(i, words(2000 + i, 3000, 10**6)) for i in range(200)] + [(1000, words(2000, 3000, 10**6))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = jc.save(df, "texts")
        before = shuffled(spark)
        got = jc.similarity_classes(texts).collect()
        moved = shuffled(spark) - before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert len(got) == 201 and sorted(r.doc_id for r in got if r.class_size == 2) == [0, 1000]
    sets = 4 * sum(len(jc.Shingler()(t)) for _, t in rows)
    assert moved < sets / 4


def test_nodes_go_on_from_the_wanted_paths_alone():
    """Of a node's paths most end where they are: the rest of its rows was made to be dropped."""
    import pyarrow as pa

    import marlstone.llm.jaccard as j

    tokens = np.arange(1, 200, dtype=np.uint32)
    paths = j.chosen(tokens, j.first_ends(20), 0.8).view(np.int64)
    batch = pa.record_batch([pa.array([7], pa.int64()), pa.array([tokens.tobytes()]), pa.array([paths.tolist()], pa.list_(pa.int64()))], names=["node", "tokens", "paths"])
    rows = lambda wanted: {tuple(r.values()) for b in j._deeper(0.8, wanted)([batch]) for r in b.to_pylist()}
    every = rows(None)
    wanted = np.array(sorted({b for _, b, _ in every})[:3] + [1], dtype=np.int64)
    assert rows(wanted) == {r for r in every if r[1] in wanted} and 0 < len(rows(wanted)) < len(every)

import hashlib
import re
from collections import defaultdict

from marlstone.llm.mixing import emit, mix, source_targets


def water(sizes):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        w = sum(weight[s] for s in order if s not in full)
        target = {s: 3 * sizes[s] if s in full else rest * weight[s] / w for s in order}
        over = {s for s in order if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def brute(rows):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += size(r.text)
    target, out = water(sizes), []
    for r in rows:
        rate = target[r.source] / sizes[r.source] if sizes[r.source] else 0.0
        u = int(hashlib.md5(f"mix:{'null' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        out.append((r.doc_id, size(r.text), sizes[r.source], target[r.source], int(rate) + (u < rate - int(rate))))
    return out


def near(a, b):
    assert len(a) == len(b)
    key = lambda x: (x[0] is None, x[0] or 0, x[1:3])
    for x, y in zip(sorted(a, key=key), sorted(b, key=key)):
        assert x[:3] == y[:3] and abs(x[3] - y[3]) <= 1e-9 * max(1, y[3]) and x[4] == y[4]


def got(df):
    return [(r.doc_id, r.size, r.source_size, r.target, r.copies) for r in mix(df).collect()]


def test_equals_brute_force(docs):
    near(got(docs), brute(docs.collect()))


def test_odd_rows(odd, empty):
    near(got(odd), brute(odd.collect()))
    assert mix(empty).collect() == []


def test_caps(spark):
    sizes = {"a": 1, "b": 10, "c": 1000, "d": 5, "e": 0, None: 3}
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    rows = {r.source: r.target for r in source_targets(df, "source", "size", (1, 2, 3), 3).collect()}
    want = water(sizes)
    assert all(abs(rows[s] - want[s]) < 1e-9 for s in sizes)
    assert abs(sum(rows.values()) - sum(sizes.values())) < 1e-6


def test_emit(docs):
    mixed = mix(docs)
    rows = emit(mixed).groupBy("doc_id").count().collect()
    copies = {r.doc_id: r.copies for r in mixed.collect() if r.copies}
    assert {r.doc_id: r["count"] for r in rows} == copies

from collections import defaultdict

from marlstone.llm.sharding import histogram_sort_shards
from marlstone.llm.splitters import find_splitters


def check(rows, n_rows, most_row):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert len(rows) == n_rows and set(by) <= set(range(16))
    for shard in by.values():
        assert sorted(r.slot for r in shard) == list(range(len(shard)))
    ideal = sum(r.size for r in rows) / 16
    return max(abs(sum(r.size for r in by.get(s, [])) - ideal) for s in range(16)) <= 0.01 * ideal + most_row


def test_bytes_are_near_equal_and_slots_gapless(docs):
    rows = histogram_sort_shards(docs).select("doc_id", "text", "size", "shard", "slot").collect()
    assert all(r.size == len(r.text.encode()) + 1 for r in rows)
    assert check(rows, docs.count(), max(r.size for r in rows))


def test_reruns_agree_and_small_cells_change_no_law(docs):
    a = {(r.doc_id, r.shard, r.slot) for r in histogram_sort_shards(docs).collect()}
    assert a == {(r.doc_id, r.shard, r.slot) for r in histogram_sort_shards(docs).collect()}
    rows = histogram_sort_shards(docs, cell_bytes=4000).select("doc_id", "text", "size", "shard", "slot").collect()
    assert check(rows, docs.count(), max(r.size for r in rows))


def test_hot_text_is_divided_by_id(spark):
    df = spark.createDataFrame([(i, "same text" if i % 3 else f"other {i}") for i in range(3000)], "doc_id long, text string")
    rows = histogram_sort_shards(df).collect()
    assert check(rows, 3000, 12)


def test_odd_rows(odd, empty):
    rows = histogram_sort_shards(odd).collect()
    assert len(rows) == 12 and {r.size for r in rows if r.text is None or r.text == ""} == {1}
    check(rows, 12, max(r.size for r in rows))
    assert histogram_sort_shards(empty).collect() == []


def test_splitters_equal_brute_force(spark):
    data = [((i * 7919) % 1000 - 500, i % 13, 1 + i % 17) for i in range(2000)] + [(3, i, 5) for i in range(1500)]
    df = spark.createDataFrame(data, "k1 long, k2 long, size long")
    cells = find_splitters(df, [(j / 8, 0.001) for j in range(1, 8)])
    keys = sorted(data)
    for b, below, rows in zip(cells.boundaries, cells.bytes_below, cells.rows_below):
        assert below == sum(s for a, c, s in keys if (a, c) < b) and rows == sum((a, c) < b for a, c, _ in keys)
    assert len(cells.boundaries) == 7
    for j, below in enumerate(cells.bytes_below, 1):
        assert abs(below / cells.total_bytes - j / 8) < 0.01


def test_shards_and_slots_equal_a_sorted_list(docs, spark):
    """Shard and slot are the place in the list sorted by the hash of the text, cut near each sixteenth of all bytes."""
    from pyspark.sql import functions as F

    some = docs.where("text is not null").dropDuplicates(["text"])
    got = histogram_sort_shards(some, cell_bytes=3000).withColumn("h", F.xxhash64("text")).collect()
    order = sorted(got, key=lambda r: r.h)
    assert [(r.shard, r.slot) for r in order] == sorted((r.shard, r.slot) for r in got)
    total, below, cuts = sum(r.size for r in got), 0, {}
    for r in order:
        cuts.setdefault(r.shard, below)
        below += r.size
    most = max(r.size for r in got)
    for j in range(1, 16):
        edge = min((c for s, c in cuts.items() if s >= j), default=total)
        assert abs(edge - j / 16 * total) <= 0.002 / 16 * total + most

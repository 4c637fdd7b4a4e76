import random
from collections import defaultdict

import pytest

from marlstone.llm.mixing import WORD
from marlstone.llm.packing import LENGTHS, pack, plan_bins, sequence_cost


def lay_out(plan):
    """Every item of the plan: bin -> [(start, length)], with the bins' capacity and use."""
    bins, meta, ranks = defaultdict(list), {}, defaultdict(list)
    for p in plan.placements:
        for i in range(p.n):
            b = p.bin + i // p.per_bin
            bins[b].append((p.offset + i % p.per_bin * p.length, p.length))
            assert meta.setdefault(b, (p.capacity, p.used)) == (p.capacity, p.used)
            ranks[p.length].append(p.first + i)
    return bins, meta, ranks


@pytest.mark.parametrize("seed", range(6))
def test_plans_are_whole(seed):
    r = random.Random(seed)
    histogram = defaultdict(int)
    for _ in range(r.choice([1, 30, 3000])):
        histogram[r.choice([r.randint(1, 64), r.randint(1, 8), 64, 7])] += 1
    plan = plan_bins(dict(histogram), (16, 32, 64), lambda n: n + n * n / 100 + 1)
    bins, meta, ranks = lay_out(plan)
    assert {n: len(v) for n, v in ranks.items()} == dict(histogram)
    assert all(sorted(v) == list(range(len(v))) for v in ranks.values())
    assert sorted(bins) == list(range(plan.bins))
    for b, items in bins.items():
        capacity, used = meta[b]
        items.sort()
        assert all(a + n == c for (a, n), (c, _) in zip(items, items[1:]))  # no gap, no overlap
        assert items[0][0] == 0 and sum(items[-1]) == used <= capacity
        assert capacity == min(s for s in (16, 32, 64) if s >= used)
    assert abs(plan.cost - sum(c + c * c / 100 + 1 for c, _ in meta.values())) < 1e-6


def best_fit(lengths, size):
    """Best-fit decreasing, item by item, with one size."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms[rooms.index(min(fit))] -= n
        else:
            rooms.append(size - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(4))
def test_with_one_size_it_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    lengths = [r.randint(1, 50) for _ in range(700)]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    assert plan_bins(histogram, (64,)).bins == best_fit(lengths, 64)


def test_more_sizes_cost_no_more_than_any_alone():
    r = random.Random(3)
    histogram = {n: r.randint(1, 40) for n in range(1, 500)}
    best = plan_bins(histogram, (512, 1024, 2048)).cost
    assert best <= min(plan_bins(histogram, (s,)).cost for s in (512, 1024, 2048))
    assert sequence_cost(1024) > 2 * sequence_cost(512) - 32


def whole(rows, docs, sizes):
    import re

    pieces = defaultdict(list)
    bins = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.first_word, r.length))
        if r.bin is not None:
            bins[r.bin].append(r)
            assert r.capacity in sizes and r.used <= r.capacity
    words = defaultdict(int)
    for d in docs:
        words[d.doc_id] += len(re.findall(WORD, d.text or ""))
    assert {k: sum(x[2] for x in v) for k, v in pieces.items()} == words
    for items in bins.values():
        items.sort(key=lambda r: r.start)
        assert items[0].start == 0 and all(a.start + a.length == b.start for a, b in zip(items, items[1:]))
        assert items[-1].start + items[-1].length == items[0].used


def test_every_word_has_its_place(docs):
    whole(pack(docs).collect(), docs.collect(), LENGTHS)
    rows = pack(docs, sizes=(16, 100)).collect()
    whole(rows, docs.collect(), (16, 100))


def test_frequent_lengths_are_ranked_in_slices(docs, monkeypatch):
    from marlstone.llm import packing

    monkeypatch.setattr(packing, "LEAST_SLICE_ROWS", 3)
    whole(pack(docs, sizes=(8, 16)).collect(), docs.collect(), (8, 16))


def test_odd_rows(odd, empty):
    rows = pack(odd).collect()
    whole(rows, odd.collect(), LENGTHS)
    assert all(r.length == 0 and r.bin is None for r in rows if r.doc_id in (1, 2, 3))
    assert pack(empty).collect() == []


def item_by_item(lengths, sizes, cost):
    """The least cost over all plans, made by placing one item after the other."""
    best = None
    for least in sizes:
        bins = []  # [capacity, used]
        for n in sorted(lengths, reverse=True):
            fit = [b for b in bins if b[0] - b[1] >= n]
            if fit:
                b = min(fit, key=lambda b: b[0] - b[1])
            else:
                shorter = sum(x for x in lengths if x < n)
                b = [min((s for s in sizes if s >= n and s >= least), default=max(sizes), key=lambda s: (cost(s) / min(s, s // n * n + shorter), s)), 0]
                bins.append(b)
            b[1] += n
        total = sum(cost(min(s for s in sizes if s >= used)) for _, used in bins)
        best = total if best is None else min(best, total)
    return best


def cheapest(lengths, sizes, cost):
    """The least cost of any packing, by trying all."""
    best = [sum(cost(min(s for s in sizes if s >= n)) for n in lengths)]

    def place(i, bins):
        if i == len(lengths):
            best[0] = min(best[0], sum(cost(min(s for s in sizes if s >= b)) for b in bins))
            return
        for b in sorted(set(bins)):
            if b + lengths[i] <= max(sizes):
                rest = list(bins)
                rest[rest.index(b)] += lengths[i]
                place(i + 1, rest)
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(8))
def test_several_sizes_equal_item_by_item_and_are_near_the_cheapest(seed):
    r = random.Random(seed)
    sizes, cost = (8, 16, 32), lambda n: n + n * n / 64 + 2
    lengths = [r.randint(1, 32) for _ in range(8)]
    plan = plan_bins({n: lengths.count(n) for n in set(lengths)}, sizes, cost)
    assert abs(plan.cost - item_by_item(lengths, sizes, cost)) < 1e-9
    assert cheapest(lengths, sizes, cost) - 1e-9 <= plan.cost <= 1.25 * cheapest(lengths, sizes, cost)
    many = [r.randint(1, 32) for _ in range(300)]
    assert abs(plan_bins({n: many.count(n) for n in set(many)}, sizes, cost).cost - item_by_item(many, sizes, cost)) < 1e-6

"""The bulk plan against placing items singly, and the placement of real documents."""

import random
import re
from collections import Counter, defaultdict

import pytest

from shelfcast.llm.packing import PackConfig, TrialFill, best_fit, op6_packing, pack, pack_documents, plan_bins


def trial_sizes(lengths, config):
    """Opening by trial fill over the single items that are left; a choice holds while its trial repeats."""
    unclaimed, state = Counter(lengths), {"length": None, "size": None, "repeats": 0}

    def fill(size, length, left):
        taken, free = Counter(), size
        for n in sorted((n for n in unclaimed if n <= length), reverse=True):
            while n <= free and taken[n] < (left if n == length else unclaimed[n]):
                taken[n], free = taken[n] + 1, free - n
        return size - free, +taken

    def opening(length, left):
        if state["length"] != length or not state["repeats"]:
            trials = [(size, *fill(size, length, left)) for size in config.sizes if size >= length]
            size, _, taken = min(trials, key=lambda t: (config.cost(config.reduced(t[1])) / t[1], t[0]))
            repeats = min((left if n == length else unclaimed[n]) // k for n, k in taken.items())
            for n, k in taken.items():
                if n != length:
                    unclaimed[n] -= k * repeats
            state.update(length=length, size=size, repeats=repeats)
        state["repeats"] -= 1
        return state["size"]

    return opening


def place_singly(lengths, config, opening):
    """Best fit decreasing, an item at a time; on equal room the bin that has had it longest."""
    bins, clock, left = [], 0, Counter(lengths)  # [room, since, size]
    for length in sorted(lengths, reverse=True):
        clock += 1
        fitting = [b for b in bins if b[0] >= length]
        if fitting:
            best = min(fitting, key=lambda b: (b[0], b[1]))
        else:
            size = opening(length, left[length])
            best = [size, clock, size]
            bins.append(best)
        best[0], best[1] = best[0] - length, clock
        left[length] -= 1
    return Counter((size - room, config.reduced(size - room)) for room, _, size in bins)


def total_cost(bins, config):
    return sum(config.cost(size) * n for (_, size), n in bins.items())


def fixed_size(size, config):
    return lambda length, left: size if length <= size else min(s for s in config.sizes if s >= length)


def one_by_one(lengths, config):
    """The cheapest of the single placements: by trial, by cost of a full bin, by one size each."""
    rules = [trial_sizes(lengths, config), lambda length, left: config.opened(length),
             *(fixed_size(size, config) for size in config.sizes)]
    return min((place_singly(lengths, config, rule) for rule in rules), key=lambda bins: total_cost(bins, config))


def placed_bins(rows):
    fill, size, spans = Counter(), {}, defaultdict(list)
    for r in rows:
        fill[r.bin_id] += r.tokens
        assert size.setdefault(r.bin_id, r.bin_size) == r.bin_size
        spans[r.bin_id].append((r.bin_offset, r.bin_offset + r.tokens))
    for pieces in spans.values():
        ends = [0, *(e for _, e in sorted(pieces))]
        assert [s for s, _ in sorted(pieces)] == ends[:-1]  # without gaps or overlaps
    return Counter((fill[b], size[b]) for b in fill)


@pytest.mark.parametrize("seed", range(6))
def test_plan_equals_single_placement(spark, seed):
    rnd = random.Random(seed)
    config = PackConfig(sizes=(8, 16, 64), overhead=3.0 + seed)
    lengths = [min(64, max(1, int(rnd.expovariate(1 / 14)))) for _ in range(800)]
    items = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, tokens long")
    rows = pack(items, config).collect()
    assert sorted(r.doc_id for r in rows) == list(range(800))
    assert placed_bins(rows) == one_by_one(lengths, config)


@pytest.mark.parametrize("seed", range(8))
def test_trial_plan_equals_single_placement(seed):
    """The run-wise plan by trial alone, whichever plan is cheapest in the end."""
    rnd = random.Random(seed)
    config = PackConfig(sizes=(8, 16, 64), overhead=float(seed))
    lengths = [rnd.choice([3, 5, 7, 9, 13, 30, 33]) if seed % 2 else rnd.randint(1, 64) for _ in range(300)]
    plan = best_fit(dict(Counter(lengths)), config, TrialFill(dict(Counter(lengths)), config))
    assert plan.cost == total_cost(place_singly(lengths, config, trial_sizes(lengths, config)), config)


def test_sizes_are_chosen_jointly():
    """Shorter sequences are opened where they are cheaper, and no one-size plan is cheaper."""
    config = PackConfig()
    sizes = lambda h: set(plan_bins(h, config).bins[:, 1].tolist())
    assert sizes({1000: 777}) == {4096, 1024}
    assert 2048 in sizes({300: 1250, 700: 1250, 1500: 1250, 2500: 1250})
    # Items of 512 fill a bin of any size, so the overhead decides; without it the smallest wins the tie.
    assert sizes({512: 80}) == {4096} and plan_bins({512: 80}, PackConfig(overhead=0.0)).bins.tolist() == [[0, 512]]
    # Two and a bit do not fit the largest size well, but the middle one.
    assert plan_bins({33: 100}, PackConfig((34, 64), overhead=1.0)).bins.tolist() == [[0, 34]]
    rnd = random.Random(0)
    for _ in range(20):
        histogram = {rnd.randint(1, 4096): rnd.randint(1, 400) for _ in range(rnd.randint(1, 60))}
        rules = [lambda n, left, r=fixed_size(s, config): (r(n, left), -(-left // (r(n, left) // n))) for s in config.sizes]
        assert plan_bins(histogram, config).cost <= min(best_fit(histogram, config, rule).cost for rule in rules)


def test_cost_decides_the_size_that_is_opened():
    assert [PackConfig((8, 64), overhead=0.0).opened(n) for n in (3, 8, 9)] == [8, 8, 64]
    assert [PackConfig((8, 64), overhead=1.0).opened(n) for n in (3, 9)] == [64, 64]
    assert plan_bins({}, PackConfig()).items.shape == (0, 5)
    assert plan_bins({3: 1}, PackConfig((8, 64), overhead=1.0)).bins.tolist() == [[0, 8]]


def test_registered_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = op6_packing(spark, folder).collect()
    texts = spark.read.parquet(f"{folder}/documents.parquet").collect()
    expected = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) + 1 for r in texts}
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.first_token, r.tokens))
    assert {d: sum(t for *_, t in p) for d, p in pieces.items()} == expected
    for p in pieces.values():
        p.sort()
        assert [(n, s) for n, s, _ in p] == [(i, i * 4096) for i in range(len(p))]
    bins = placed_bins(rows)
    assert bins == one_by_one([t for p in pieces.values() for *_, t in p], PackConfig())
    assert sum(f * n for (f, _), n in bins.items()) / sum(s * n for (_, s), n in bins.items()) > 0.97


def test_odd_rows(spark, odd_docs):
    rows = pack_documents(odd_docs).collect()
    tokens = Counter()
    for r in rows:
        tokens[r.doc_id] += r.tokens
    assert tokens == Counter({0: 1, 1: 1, 2: 1, 3: 2, 4: 3, 5: 120_001, 6: 8, 7: 16, 8: 5, None: 6})
    placed_bins(rows)
    assert pack_documents(odd_docs.limit(0)).count() == 0
    none = spark.createDataFrame([(1, None), (2, 0)], "doc_id long, tokens long")
    assert pack(none).count() == 0

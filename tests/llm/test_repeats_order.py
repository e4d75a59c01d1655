"""The index's suffix order by sorted packed keys, and its row lookups without a search."""

import numpy as np

from shelfcast.llm import repeats as rep


def strings_of(seed, n, letters):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, letters, 400, dtype=np.uint8)
    cut = rng.integers(0, 300, n)
    sizes = rng.integers(50, 91, n)
    return np.concatenate([base[a : a + k] for a, k in zip(cut, sizes)]), sizes


def test_suffix_order_equals_sorted_suffixes():
    for letters in (1, 2, 30, 256):
        data, sizes = strings_of(letters, 30, letters)
        ends = np.cumsum(sizes + 1) - 1
        text = np.zeros(len(data) + len(sizes), dtype=np.uint16)
        text[~np.isin(np.arange(len(text)), ends)] = data.astype(np.uint16) + 1
        left = ends[np.searchsorted(ends, np.arange(len(text)))] - np.arange(len(text))
        plain = sorted(range(len(text)), key=lambda i: (text[i : i + left[i]].tolist(), i))
        assert rep.suffix_order(text, left).tolist() == plain


def test_wide_keys_are_ordered_the_same():
    key = np.random.default_rng(3).integers(0, 40, 500)
    for bits in (6, 62):  # packed with their places, and too wide for that
        order, fresh = rep._ordered(key, bits)
        assert (order == np.argsort(key, kind="stable")).all()
        assert fresh.sum() == len(np.unique(key))


def test_an_index_is_streamed_without_a_search_per_byte(monkeypatch):
    data, sizes = strings_of(9, 2000, 40)
    searched, sorted_by = [], []
    search, argsort = np.searchsorted, np.argsort
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *x, **y: (searched.append(np.size(v)), search(a, v, *x, **y))[1])
    monkeypatch.setattr(np, "argsort", lambda a, *x, **y: (sorted_by.append(len(a)), argsort(a, *x, **y))[1])
    rep.lowest_documents(data, sizes, np.arange(len(sizes)))
    assert sum(searched) < len(data) / 10
    assert sum(sorted_by) < len(data)

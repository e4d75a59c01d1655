"""The block index is apart for every item size."""

import numpy as np

from shelfcast.llm import decontaminate as dec


def test_candidates_are_a_small_share_of_the_items_and_lose_none():
    rng = np.random.default_rng(8)
    sizes = rng.integers(12, 52, 1200)
    index = dec.build_index(list(range(1200)), [" ".join(f"w{v}" for v in rng.integers(0, 900, n)) for n in sizes])
    windows = rng.integers(0, 256, (300, dec.BLOCKS)).astype(np.uint8)
    windows[:100] = index.fingerprint[rng.integers(0, 1200, 100)]
    for row in windows[:100]:
        for bit in rng.choice(128, rng.integers(0, 40), replace=False):
            row[bit // 8] ^= 1 << bit % 8
    distance = np.bitwise_count(windows[:, None, :] ^ index.fingerprint[None]).sum(axis=2)
    candidates, found = 0, 0
    for size in index.sizes:
        window, item = dec._candidates(index, windows, int(size))
        assert (index.size[item] == size).all()
        candidates += len(window)
        near = {(w, i) for w, i in np.argwhere((distance <= dec.RADIUS) & (index.size == size))}
        assert near <= set(zip(window, item))
        assert {(w, i): d for w, i, d in zip(*dec._near_items(index, windows, int(size)))} == {k: distance[k] for k in near}
        found += len(near)
    # A window is looked up once, for its own size: candidates per lookup against all items.
    assert candidates / (len(windows) * len(index.sizes)) < 0.05 * len(sizes)
    assert found > 60


def test_items_without_words_leave_an_empty_index():
    index = dec.build_index([1, 2], ["", "..."])
    assert len(index.sizes) == 0 and len(index.cell) == 0

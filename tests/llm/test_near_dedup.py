"""Near-duplicate components against brute force over all pairs."""

import random
import re
from itertools import combinations

import pytest

from shelfcast.llm.near_dedup import near_duplicates, op10_near_dedup


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_force(rows, width, percent):
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in sets:
        for x in s:
            holders.setdefault(x, []).append(i)
    common = {}
    for ids in holders.values():
        for pair in combinations(sorted(set(ids)), 2):
            common[pair] = common.get(pair, 0) + 1
    size = {i: len(s) for i, s in sets}
    for (a, b), n in common.items():
        if 100 * n >= percent * (size[a] + size[b] - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (size[i], root(i), root(i) == i) for i, _ in rows}


def result(frame):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in frame.collect()}


def test_edited_copies_chain_into_components(make_docs):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for length in (12, 40, 120, 400):
        for _ in range(4):
            words = rnd.choices(vocabulary, k=length)
            for _ in range(14):  # a chain: each copy edits the one before
                texts.append(" ".join(words).capitalize())
                words = list(words)
                for _ in range(max(1, length // 60)):
                    words[rnd.randrange(length)] = rnd.choice(vocabulary)
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    found = result(near_duplicates(make_docs(texts), width=3, percent=85, bands=25, rows=5))
    assert found == brute_force(rows, 3, 85)
    assert 16 < sum(kept for _, _, kept in found.values()) < len(texts)


def test_large_group_of_near_copies(make_docs):
    """Copies that differ from a common text in their own places, and exact copies of one."""
    rnd = random.Random(5)
    base = [f"v{i}" for i in range(200)]
    texts = ["unrelated " * 9]
    for i in range(300):
        words = list(base)
        for _ in range(rnd.randrange(1, 9)):
            words[rnd.randrange(200)] = f"x{rnd.randrange(50)}"
        texts.append(" ".join(words))
    texts += [texts[17]] * 100
    found = result(near_duplicates(make_docs(texts), width=3, percent=85, bands=25, rows=5))
    assert found == brute_force(list(enumerate(texts)), 3, 85)


def test_odd_rows(odd_docs):
    found = near_duplicates(odd_docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = sorted(found.collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [(r.doc_id, r.component_id, r.kept) for r in rows] == [
        (0, 0, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 5, True),
        (6, 6, True), (7, 6, False), (7, 6, False), (8, 8, True), (None, None, True),
    ]
    assert [r.n_shingles for r in rows][:5] == [0, 0, 0, 1, 1]
    assert near_duplicates(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("scale", ["sf0.01"])
def test_registered_query_matches_brute_force(spark, scale):
    folder = f"/root/testdata/{scale}"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert result(op10_near_dedup(spark, folder)) == brute_force([tuple(r) for r in docs], 3, 85)

"""Rows that share an id but not their text are linked and kept by their own texts."""

import random
import re
from collections import Counter
from itertools import combinations

import pytest

from shelfcast.llm.near_dedup import drop_near_duplicates, near_duplicates
from test_near_dedup import shingle_set

A = " ".join(f"a{i}" for i in range(100))
B = " ".join(f"b{i}" for i in range(100))


def expected(rows, width, percent):
    """(doc_id, n, component, kept) of each row and the rows that stay, by all pairs."""
    sets = [shingle_set(t, width) for _, t in rows]
    group = list(range(len(rows)))
    for x, y in combinations(range(len(rows)), 2):
        s, t = sets[x], sets[y]
        if s and t and rows[x][0] is not None and rows[y][0] is not None and 100 * len(s & t) >= percent * len(s | t):
            old, new = group[y], group[x]
            group = [new if g == old else g for g in group]
    linked, groups = [], {}
    for k, (doc_id, _) in enumerate(rows):
        alone = doc_id is None or not sets[k]
        members = [rows[j][0] for j in range(len(rows)) if group[j] == group[k]]
        least = doc_id if alone else min(members)
        linked.append((doc_id, len(sets[k]), least, doc_id == least))
        if not alone:
            groups.setdefault(group[k], least)
    return linked, Counter(groups.values())


def test_two_texts_of_one_id(make_docs):
    docs = make_docs([(1, A), (1, B), (2, B + " more"), (3, A + " more")])
    rows = Counter(map(tuple, near_duplicates(docs).collect()))
    assert rows == Counter([(1, 96, 1, True), (1, 96, 1, True), (2, 97, 1, False), (3, 97, 1, False)])
    assert sorted(r.text for r in drop_near_duplicates(docs).collect()) == [A, B]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_repeats_equal_all_pairs(make_docs, seed):
    rnd = random.Random(seed)
    rows = []
    for base in (A, B, A + B, "", "one two", " ".join(f"c{i}" for i in range(60))):
        for _ in range(12):
            words = base.split()
            for _ in range(rnd.randrange(3)):
                if len(words) > 20:
                    words[rnd.randrange(len(words))] = f"x{rnd.randrange(9)}"
            rows.append((rnd.choice([None, *range(8)]), " ".join(words)))
    rows += rows[:9]
    linked, stay = expected(rows, 5, 80)
    docs = make_docs(rows).selectExpr("*", "1 AS text_key", "2 AS component", "3 AS rep")
    assert Counter(map(tuple, near_duplicates(docs).collect())) == Counter(linked)
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    left = left.collect()
    shingled = [r for r in left if r.doc_id is not None and shingle_set(r.text, 5)]
    assert Counter(r.doc_id for r in shingled) == stay
    empty = {(r.doc_id, r.text) for r in left if r.doc_id is not None and not re.search(r"\S", r.text)}
    assert empty == {(i, t) for i, t in rows if i is not None and not t.strip()}
    assert sum(r.doc_id is None for r in left) == sum(i is None for i, _ in rows)

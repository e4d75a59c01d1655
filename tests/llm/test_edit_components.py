"""Unbroken walks, and links that hubs alone would lose."""

import random

import numpy as np

from shelfcast.llm import edit_fingerprint as ef


def long_texts(n, size=60_000):
    rnd = random.Random(12)
    return ["".join(rnd.choices("abcdefghij klmnop", k=size)) for _ in range(n)]


def test_short_texts_walk_alike_and_early_insertions_keep_long_ones_near():
    rnd = random.Random(2)
    short = ["".join(rnd.choices("abcde é😀", k=k)) for k in (0, 1, 2, 300, ef.BLOCK)]
    assert all((x == y).all() for x, y in zip(ef.unbroken_bytes(short), ef.fingerprint_bytes(short)))
    base = long_texts(5)
    edited = [t[:50] + "0123456789" * 3 + t[50:] for t in base]
    unbroken = ef.likeness(*ef.unbroken_bytes(base), *ef.unbroken_bytes(edited))
    restarted = ef.likeness(*ef.fingerprint_bytes(base), *ef.fingerprint_bytes(edited))
    assert np.median(unbroken) > 0.8 and max(restarted) < 0.8
    full = ef.walk_likeness(base + edited, np.arange(5), np.arange(5) + 5)
    assert np.abs(full - unbroken).max() < 0.15


def test_walk_likeness_counts_every_step():
    texts = ["abcabcabd" * 40, "abcabcabd" * 39 + "xyz", "", "abcabcabd" * 40]
    assert ef.walk_likeness(texts, np.array([0, 2, 0]), np.array([3, 2, 2])).tolist() == [1.0, 1.0, 0.0]
    value = ef.walk_likeness(texts, np.array([0]), np.array([1]))[0]
    assert 0.9 < value < 1


def shares(prefix):
    """Prints of one length that agree in the first slots and pairwise in more."""
    return ef.encode(500, np.array(prefix, dtype=np.uint8))


def test_two_near_prints_whose_hubs_are_unlike_are_linked(spark):
    # All share band 0. Hubs are unlike everything; 7 and 8 are alike in all but a few slots of
    # every other band, so band 0 is the only bucket that they share.
    draw = np.random.default_rng(5)
    common = draw.integers(1, 256, ef.BAND_SLOTS)
    prints = {i: np.concatenate([common, draw.integers(1, 256, ef.SLOTS - ef.BAND_SLOTS)]) for i in range(7)}
    twin = prints[6].copy()
    twin[ef.BAND_SLOTS :: ef.BAND_SLOTS] = twin[ef.BAND_SLOTS :: ef.BAND_SLOTS] % 255 + 1
    prints[7] = twin
    frame = spark.createDataFrame([(i, shares(p)) for i, p in prints.items()], "doc_id long, fingerprint string")
    assert {(r.a, r.b) for r in ef.near_links(frame, 0.7).collect()} == {(6, 7)}


def test_components_of_documents(spark, make_docs, odd_docs):
    base = long_texts(3, 20_000)
    texts = [x for t in base for x in (t, t[:50] + "more" + t[50:], t[:9000] + t[9003:], t)]
    found = {r.doc_id: r.component_id for r in ef.edit_components(make_docs(texts)).collect()}
    assert found == {i: i // 4 * 4 for i in range(12)}
    rows = ef.edit_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    same = {r.doc_id: r.component_id for r in rows}
    assert (same[0], same[1], same[6], same[7], same[None]) == (0, 0, 6, 6, None)
    assert ef.edit_components(odd_docs.limit(0)).count() == 0


def test_registered_query_covers_every_document(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = {r.doc_id: r.component_id for r in ef.op4_edit_components(spark, folder).collect()}
    assert found.keys() == docs.keys()
    first = {}
    for i in sorted(docs):
        assert found[i] == found[first.setdefault(docs[i], i)]
        assert found[i] <= i and found[found[i]] == found[i]

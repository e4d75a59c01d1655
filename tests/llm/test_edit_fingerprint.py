"""Fingerprints against a walk done character by character, and the rows of the query."""

import hashlib
import random

import numpy as np
import pytest

from shelfcast.llm import edit_fingerprint as ef
from shelfcast.llm import words as wh


def walk_by_hand(text):
    """The sampled bytes of one text, a step at a time."""
    code = [ord(c) for c in text]
    steps = ef.sampled_steps(np.array([len(text)]))[0]
    shown = {}
    for first in range(0, len(code), ef.BLOCK):
        block, at = code[first : first + ef.BLOCK], 0
        for step in range(2 * len(block)):
            if at < len(block):
                value = 0
                for k in range(ef.GRAM):
                    more = code[first + at + k] + 1 if first + at + k < len(code) else 0
                    value = (value * 0x100000001B3 + more) % 2**64
                shown[first * 2 + step] = int(wh.mix(np.array([value], dtype=np.uint64), 4)[0]) % 255 + 1
                kind = int(wh.mix(np.array([block[at]], dtype=np.uint64), 3)[0]) & 255
                at += int(ef._COINS[step][kind])
            else:
                shown[first * 2 + step] = 0
    return [shown[s] if s >= 0 else 0 for s in steps.tolist()]


def test_walk_equals_a_walk_by_hand():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abcde é😀") for _ in range(n)) for n in (0, 1, 2, 50, 700, ef.BLOCK, ef.BLOCK + 1, 9000)]
    sizes, sampled = ef.fingerprint_bytes(texts)
    assert sizes.tolist() == [len(t) for t in texts]
    assert sampled.tolist() == [walk_by_hand(t) for t in texts]


def test_few_edits_keep_the_fingerprint_near():
    rnd = random.Random(4)
    texts = ["".join(rnd.choices("abcdefghij klmnop", k=3000)) for _ in range(40)]
    own = ef.fingerprint_bytes(texts)

    def near(change):
        return ef.likeness(*own, *ef.fingerprint_bytes([change(t) for t in texts])).mean()

    def deleted(n):
        def change(t):
            for _ in range(n):
                k = rnd.randrange(len(t))
                t = t[:k] + t[k + 1 :]
            return t
        return change

    one, ten = near(deleted(1)), near(deleted(10))
    assert one > 0.95 and one > ten > 0.6
    assert near(lambda t: t) == 1.0
    assert near(lambda t: t[::-1]) < 0.1


def test_sampled_steps_are_spread_and_shared():
    steps = ef.sampled_steps(np.array([1000, 1010, 50_000]))
    assert abs(steps[2].mean() / 100_000 - 0.5) < 0.1 and steps[2].max() < 100_000
    assert (steps[0] == steps[1]).mean() > 0.95


def brute_force(rows):
    rows = sorted(((i, t or "") for i, t in rows))
    out = {}
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        changed = text[: len(text) - len(text) // 4] + following[: len(text) // 4]
        n, b = ef.unbroken_bytes([text, changed, following])
        near = lambda j: ef.likeness(n[:1], b[:1], n[j : j + 1], b[j : j + 1])[0]  # noqa: B023, E731
        out[i] = (i, len(text), hashlib.sha256(changed.encode()).hexdigest(), ef.encode(n[0], b[0]),
                  ef.encode(n[1], b[1]), near(1), near(2))
    return out


@pytest.mark.parametrize("parts", ["1", "7"])
def test_registered_query(spark, parts):
    folder = "/root/testdata/sf0.001"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = ef.op4_edit_fingerprint(spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert {r.doc_id: tuple(r) for r in found} == brute_force(rows)
    assert len(found) == len(rows)
    assert min(r.near_edited for r in found if r.n_chars > 200) > 0.55
    texts = dict(rows)
    prints = {}
    for r in found:
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint


def test_links_join_near_copies(spark, make_docs):
    rnd = random.Random(9)
    base = ["".join(rnd.choices("abcdefghij klmnop", k=1500)) for _ in range(6)]
    texts = []
    for t in base:
        for _ in range(8):
            k = rnd.randrange(1300, 1500)
            texts.append(t[:k] + "#" + t[k + 1 :])
    prints = ef.fingerprint_documents(make_docs(texts))
    links = ef.near_links(prints, 0.8).collect()
    first = {}  # equal fingerprints are one class
    parent = [first.setdefault(r.fingerprint, r.doc_id) for r in sorted(prints.collect(), key=lambda r: r.doc_id)]
    for link in sorted((r.a, r.b) for r in links):
        assert link[0] // 8 == link[1] // 8
        old, new = parent[link[1]], parent[link[0]]
        parent = [new if p == old else p for p in parent]
    assert len(set(parent)) == 6


def test_odd_rows(spark, odd_docs, make_docs):
    found = ef.fingerprint_documents(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {r.doc_id: r for r in found}
    empty = hashlib.sha256(b"").hexdigest()
    assert (by_id[0].n_chars, by_id[0].edited_sha256, by_id[0].near_next) == (0, empty, 1.0)
    assert by_id[6].near_next == 1.0 and by_id[6].fingerprint == by_id[7].fingerprint
    assert ef.fingerprint_documents(odd_docs.limit(0)).count() == 0
    alone = ef.fingerprint_documents(make_docs(["only one here"])).first()
    assert alone.near_next == 1.0
    assert ef.near_links(spark.createDataFrame([], "doc_id long, fingerprint string")).count() == 0


@pytest.mark.parametrize("inserted", [4, 30])
def test_an_early_insertion_keeps_most_long_texts_near(inserted):
    """Two walks meet again after a random time, so some pairs stay apart."""
    rnd = random.Random(21)
    base = ["".join(rnd.choices("abcdefghij klmnop", k=60_000)) for _ in range(24)]
    edited = [t[:50] + ("0123456789" * 3)[:inserted] + t[50:] for t in base]
    near = ef.likeness(*ef.unbroken_bytes(base), *ef.unbroken_bytes(edited))
    restarted = ef.likeness(*ef.fingerprint_bytes(base), *ef.fingerprint_bytes(edited))
    assert np.median(near) > 0.9 > np.median(restarted)


def test_published_fingerprints_are_of_unbroken_walks(spark, make_docs):
    rnd = random.Random(3)
    texts = ["".join(rnd.choices("abcdefghij klmnop", k=k)) for k in (9000, 12_000, 5)]
    found = {r.doc_id: r for r in ef.fingerprint_documents(make_docs(texts)).collect()}
    n, b = ef.unbroken_bytes(texts)
    assert [found[i].fingerprint for i in range(3)] == [ef.encode(k, x) for k, x in zip(n.tolist(), b)]
    assert found[0].near_next == ef.likeness(n[:1], b[:1], n[1:2], b[1:2])[0]


def unbroken_by_hand(text):
    """The sampled bytes of one text by a walk through all of it, a step at a time."""
    code = [ord(c) for c in text]
    steps = ef.sampled_steps(np.array([len(text)]))[0]
    shown, at = {}, 0
    for step in range(2 * len(code)):
        if at == len(code):
            shown[step] = 0
            continue
        value = 0
        for k in range(ef.GRAM):
            value = (value * 0x100000001B3 + (code[at + k] + 1 if at + k < len(code) else 0)) % 2**64
        shown[step] = int(wh.mix(np.array([value], dtype=np.uint64), 4)[0]) % 255 + 1
        turn, row = divmod(step, ef.STEPS)
        salt = int(wh.mix(np.array([turn], dtype=np.uint64), 7)[0]) & 255 if turn else 0
        kind = int(wh.mix(np.array([code[at]], dtype=np.uint64), 3)[0]) & 255
        at += int(ef._COINS[row][kind ^ salt])
    return [shown[s] if s >= 0 else 0 for s in steps.tolist()]


@pytest.mark.parametrize("alone", [0, 3, 128])
def test_unbroken_walk_equals_a_walk_by_hand(monkeypatch, alone):
    monkeypatch.setattr(ef, "_ALONE", alone)
    rnd = random.Random(13)
    texts = ["".join(rnd.choice("abcde é😀") for _ in range(n)) for n in (0, 1, 2, 50, 700, ef.BLOCK, ef.BLOCK + 1, 9000)]
    sizes, sampled = ef.unbroken_bytes(texts)
    assert sizes.tolist() == [len(t) for t in texts]
    assert sampled.tolist() == [unbroken_by_hand(t) for t in texts]

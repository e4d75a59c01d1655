"""Copies, repeated ids and null ids; what reaches a bucket; every shared string is indexed."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from shelfcast.llm import repeats as rep


def kept_of(rows):
    """Kept bytes of every row by brute force; a null id is larger than all others."""
    key = lambda i: (i is None, i or 0)
    first = {}
    for i, text in sorted(rows, key=lambda r: key(r[0])):
        data = text.encode()
        for at in range(len(data) - 49):
            first.setdefault(data[at : at + 50], key(i))
    out = []
    for i, text in rows:
        data = text.encode()
        removed = bytearray(len(data))
        for at in range(len(data) - 49):
            if first[data[at : at + 50]] < key(i):
                removed[at : at + 50] = b"\1" * 50
        out.append((i, bytes(b for b, r in zip(data, removed) if not r)))
    return out


def test_repeated_and_null_ids_are_judged_by_their_own_text(spark, make_docs):
    rnd = random.Random(4)
    a, b, c = ("".join(rnd.choice("abcdefgh ") for _ in range(260)) for _ in range(3))
    rows = [(2, a), (2, b), (2, a), (9, a[:120] + c), (9, b[40:] + a[100:200]), (9, c), (None, c + b), (None, a),
            (None, a), (12, a + b + c), (-5, b[:70]), (10**18, a[30:])]
    rows += [(100 + 4 * k, a[k % 7 :] + b[: 60 + k]) for k in range(60)]
    found = rep.remove_repeats(make_docs(rows)).collect()
    assert Counter((r.doc_id, bytes(r.kept)) for r in found) == Counter(kept_of(rows))
    for r in found:
        assert r.n_bytes - len(r.kept) == sum(y - x for x, y in zip(r.starts, r.stops))


def test_a_chunk_sends_a_string_once():
    rnd = random.Random(6)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(400))

    def sent(n):
        chunk = pa.table({"part": pa.array([3] * n, pa.int64()), "doc_id": pa.array(range(n), pa.int64()), "text": [passage] * n})
        rows = list(rep._sent_rows(chunk, 4))
        return [r for r in rows if r["bucket"] < 0], [r for r in rows if r["bucket"] >= 0]

    (one,), strings = sent(1)
    (many,), again = sent(500)
    assert one["bucket"] == -4 and many["n"] == 500 * one["n"]
    assert [r["strings"] for r in strings] == [r["strings"] for r in again]
    assert sum(len(r["spreads"]) for r in again) < 60 * len(again)


def test_every_string_of_two_documents_goes_through_the_index(monkeypatch):
    """Also one that shares nothing with a different string."""
    indexed = []
    plain = rep.lowest_documents
    monkeypatch.setattr(rep, "lowest_documents", lambda data, sizes, low: indexed.append(len(sizes)) or plain(data, sizes, low))
    text = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8)
    sizes, anchors = np.array([62, 62]), np.array([20, 20])
    found = rep._search_bucket(np.concatenate([text, text]), sizes, anchors, np.array([7, 3]), np.array([7, 3]))
    assert indexed == [1] and [c.tolist() for c in found] == [[0], [0], [13], [3]]
    # One document twice: nothing to remove and nothing to index.
    none = rep._search_bucket(np.concatenate([text, text]), sizes, anchors, np.array([7, 7]), np.array([7, 7]))
    assert indexed == [1] and all(len(c) == 0 for c in none)


def test_plan_reads_each_chunk_from_one_shuffle(spark, make_docs):
    plan = rep.remove_repeats(make_docs([(i, "some words " * i) for i in range(20)]))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in text

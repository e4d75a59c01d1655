"""Removed bytes against brute force over all 50-byte strings; the index against plain search."""

import hashlib
import random

import numpy as np
import pytest

from shelfcast.llm import repeats as rep


def brute_force(rows):
    """Rows of the query for (doc_id, text) pairs with distinct ids."""
    first = {}
    texts = sorted((i, (t or "").encode()) for i, t in rows)
    for i, data in texts:
        for at in range(len(data) - 49):
            first.setdefault(data[at : at + 50], i)
    out = set()
    for i, data in texts:
        removed = bytearray(len(data))
        for at in range(len(data) - 49):
            if first[data[at : at + 50]] < i:
                removed[at : at + 50] = b"\1" * 50
        kept = bytes(b for b, r in zip(data, removed) if not r)
        spans = sum(1 for k, r in enumerate(removed) if r and not (k and removed[k - 1]))
        out.add((i, len(data), sum(removed), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("scale", ["sf0.01"])
def test_registered_query_matches_brute_force(spark, scale):
    folder = f"/root/testdata/{scale}"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = rep.op5_repeats(spark, folder).collect()
    assert len(found) == len(docs)
    assert {tuple(r) for r in found} == brute_force([tuple(r) for r in docs])


def test_repetitive_texts_and_edges(spark, make_docs, tmp_path):
    rnd = random.Random(8)
    base = "".join(rnd.choice("abcdé ") for _ in range(400))
    texts = ["", None, "a" * 49, "a" * 50, "a" * 51, "a" * 300, "ab" * 100, base, base[:49], base[100:150],
             "\0" * 120, "\0" * 60 + base[:55], base[7:57] + base[57:], base[::-1], base + base, "é" * 40]
    for _ in range(60):  # pieces of earlier texts with single changes
        a = rnd.choice([t for t in texts if t])
        cut = rnd.randrange(max(1, len(a) - 30))
        piece = list(a[cut : cut + rnd.randrange(30, 200)])
        piece[rnd.randrange(len(piece))] = rnd.choice("xyz")
        texts.append(rnd.choice(["", "q" * 9]) + "".join(piece) + rnd.choice(["", base[200:260]]))
    order = list(range(len(texts)))
    rnd.shuffle(order)
    rows = [(3 * i - 40, texts[k]) for i, k in enumerate(order)]
    make_docs(rows).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    assert {tuple(r) for r in rep.op5_repeats(spark, str(tmp_path)).collect()} == brute_force(rows)


def test_index_parts_give_the_same(monkeypatch):
    """Small index parts and pieces of a text change nothing."""
    rnd = np.random.default_rng(2)
    data = rnd.integers(97, 100, 9000).astype(np.uint8)
    data[5000:5400] = data[100:500]
    whole = rep.anchored_strings(data)
    monkeypatch.setattr(rep, "_SLICE", 700)
    windows = set()
    for at, piece in rep._pieces(data):
        start, stop, anchor = rep.anchored_strings(piece)
        windows |= {(w + at, c + at) for a, b, c in zip(start, stop, anchor) for w in range(a, b - 49)}
    assert windows == {(w, c) for a, b, c in zip(*whole) for w in range(a, b - 49)}


def test_run_index_matching_statistics():
    """Streamed statistics of foreign strings equal the longest matches found by search."""
    rng = np.random.default_rng(5)
    strings = [bytes(rng.integers(97, 100, n)) for n in rng.integers(60, 90, 40)]
    strings += [strings[3][:70] + b"zz" + strings[4][:10], strings[5]]
    sizes = np.array([len(s) for s in strings])
    low = rng.integers(0, 1000, len(strings))
    index = rep.build_index(np.frombuffer(b"".join(strings), np.uint8), sizes, low)
    assert index.runs < len(index.text)
    patterns = [strings[3][5:60] + b"q" + strings[7][:20], strings[9][20:] + strings[10][:30], b"zzzz", b"zabc" * 9]
    symbols = np.concatenate([np.frombuffer(p, np.uint8).astype(np.uint16) + 1 for p in patterns])
    ends = np.cumsum([len(p) for p in patterns])
    seen = 0
    for string, place, length, row in index.stream(symbols, ends, np.diff(ends, prepend=0)):
        for s, at, n in zip(string, place, length):
            tail = patterns[s][at:]
            longest = max(k for k in range(len(tail) + 1) if any(tail[:k] in t for t in strings))
            assert n == longest
            seen += 1
    assert seen == len(symbols)
    windows = sizes - 49
    lows = rep.lowest_documents(np.frombuffer(b"".join(strings), np.uint8), sizes, low)
    expected = [
        min(d for d, t in zip(low, strings) if s[at : at + 50] in t) for s in strings for at in range(len(s) - 49)
    ]
    assert lows.tolist() == expected and len(lows) == windows.sum()


def test_odd_rows(odd_docs):
    rows = rep.remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].kept == b"" and by_id[0].n_bytes == 0
    assert all(r.starts == [] for r in rows)
    assert bytes(by_id[8].kept).decode() == "zwölf Boxkämpfer 😀 jagen"
    assert rep.remove_repeats(odd_docs.limit(0)).count() == 0

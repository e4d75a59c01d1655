"""Scores equal a recursive model over plain dictionaries that adds up to one in every context."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfcast.llm import katz as kz

FOLDER = "/root/testdata/sf0.01"
END = object()


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), END]


class PlainModel:
    def __init__(self, docs, config):
        self.order = config.order
        self.counts = [Counter() for _ in range(config.order)]
        self.after = {}
        for doc_id, text in docs:
            if held(doc_id):
                continue
            padded = [None] * (self.order - 1) + tokens(text)
            for i in range(self.order - 1, len(padded)):
                for n in range(1, self.order + 1):
                    self.counts[n - 1][tuple(padded[i - n + 1 : i + 1])] += 1
        for c in self.counts:
            for gram in c:
                self.after.setdefault(gram[:-1], []).append(gram)
        self.kept = [kz.fit_discounts(Counter(c.values()), config).kept for c in self.counts]
        self.n = sum(self.counts[0].values())
        self.whole = {h: sum(self.counts[len(h)][g] for g in grams) for h, grams in self.after.items()}
        self.share = [{g: float(k) for g, k in zip(c, f(np.array([*c.values()])))} for c, f in zip(self.counts, self.kept)]
        self.unknown = 1 - sum(self.seen(g) for g in self.after.get((), []))
        self.weights = {}

    def seen(self, gram):
        n = len(gram) - 1
        return self.share[n][gram] * self.counts[n][gram] / self.whole[gram[:-1]]

    def probability(self, gram):
        """Katz, recursively: the discounted share, or the backoff weight times the shorter context's."""
        if self.counts[len(gram) - 1][gram]:
            return self.seen(gram)
        if len(gram) == 1:
            return self.unknown
        context = gram[:-1]
        if context not in self.after:
            return self.probability(gram[1:])
        if context not in self.weights:
            used = sum(self.seen(g) for g in self.after[context])
            lower = sum(self.probability(g[1:]) for g in self.after[context])
            self.weights[context] = (1 - used) / (1 - lower)
        return self.weights[context] * self.probability(gram[1:])

    def score(self, text):
        padded = [None] * (self.order - 1) + tokens(text)
        last = range(self.order - 1, len(padded))
        return sum(math.log10(self.probability(tuple(padded[i - self.order + 1 : i + 1]))) for i in last)

    def base(self, text):
        return sum(
            math.log10((self.counts[0][(t,)] + 1) / (self.n + len(self.counts[0]) + 1)) for t in tokens(text)
        )


def check(rows, docs, config):
    model = PlainModel(docs, config)
    assert len(rows) == len(docs)
    expected = Counter(
        (d, held(d), len(tokens(t)), sum(model.counts[0][(w,)] > 0 for w in tokens(t)), model.n,
         round(model.base(t), 6), round(model.score(t) if model.n else 0.0, 6))
        for d, t in docs
    )
    found = Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
        for r in rows
    )
    assert found == expected
    return model


@pytest.mark.parametrize("order", [1, 2, 3])
def test_small_chunks_equal_a_recursive_model(spark, make_docs, order):
    """Many chunks and buckets, contexts known and unknown, words of one text only."""
    rng = np.random.default_rng(5)
    docs = [
        (i, " ".join(f"W{k}" for k in np.minimum(rng.zipf(1.6, rng.integers(0, 40)), 60) + (i % 3)))
        for i in range(300)
    ]
    config = kz.KatzConfig(order=order, chunk_tokens=200, bucket_tokens=100)
    model = check(kz.score_texts(make_docs(docs), config).collect(), docs, config)
    vocabulary = [*(g[0] for g in model.counts[0]), "never seen"]
    for context in list(model.after)[:200]:
        if len(context) < order:
            total = sum(model.probability((*context, w)) for w in vocabulary)
            assert total == pytest.approx(1.0, abs=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_whole_table_against_the_recursive_model(spark, order):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    if order == 2:
        rows = kz.op13_katz_scores(spark, FOLDER).collect()
    else:
        rows = kz.score_texts(spark.read.parquet(f"{FOLDER}/documents.parquet"), kz.KatzConfig(order=3)).collect()
    check(rows, docs, kz.KatzConfig(order=order))
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_discounts():
    config = kz.KatzConfig()
    real = kz.fit_discounts({1: 1000, 2: 300, 3: 140, 4: 80, 5: 50, 6: 35, 9: 12}, config)
    assert real.listed[0] == pytest.approx(2 * 300 / 1000)
    assert real.listed[4] == pytest.approx(6 * 35 / (5 * 50))
    counts = np.arange(1, 10_000)
    for d in (real, kz.fit_discounts({}, config), kz.fit_discounts({7: 3}, config), kz.fit_discounts({1: 1, 2: 90}, config)):
        kept = d.kept(counts)
        assert ((kept > 0) & (kept < 1)).all()
        assert (np.diff(kept[5:]) > 0).all()


def test_blocks_round_trip():
    for n in (0, 1, 1000):
        values = np.sort(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64))
        assert (kz.unpack(kz.pack(values), n, np.uint64) == values).all()
        flags = values % 3 == 0
        assert (kz.unpack_bits(kz.pack_bits(flags), n) == flags).all()


def test_odd_rows(spark, odd_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check(kz.score_texts(odd_docs).collect(), docs, kz.KatzConfig())
    only_held = odd_docs.limit(2).selectExpr("CAST(1 AS LONG) AS doc_id", "'a b' AS text")
    assert held(1)
    assert {(r.score, r.base_score, r.train_tokens) for r in kz.score_texts(only_held).collect()} == {(0.0, 0.0, 0)}
    assert kz.score_texts(odd_docs.limit(0)).count() == 0

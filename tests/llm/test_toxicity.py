"""FTRL scores: held-out accuracy, an independent learner on one fixture, defined odd cases."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from shelfcast.llm import toxicity as tox

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    return tox.op2_toxicity(spark, FOLDER).toPandas()


def test_one_row_per_document_and_the_fixed_fold(spark, scored):
    ids = [r[0] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()]
    assert sorted(ids) == sorted(scored.doc_id)
    fold = [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored.doc_id]
    assert (scored.held_out == fold).all()
    assert ((scored.score >= 0.5) == (scored.predicted == 1)).all()
    assert scored.score.between(0, 1).all()


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    both = scored[scored.held_out].merge(labels, on="doc_id")
    rank = both.score.rank()
    toxic = both.toxic == 1
    auc = (rank[toxic].mean() - (toxic.sum() + 1) / 2) / (~toxic).sum()
    assert auc > 0.97
    assert both.predicted[~toxic].mean() < 0.01
    assert both.predicted[toxic].mean() > 0.75


def test_updates_follow_the_published_rule():
    """The same steps, one coordinate at a time, with plain Python numbers."""
    config = tox.FtrlConfig(bits=4, alpha=0.5, l1=0.3, l2=0.1)
    rng = np.random.default_rng(3)
    examples = [(np.unique(rng.integers(0, 16, 5)), int(rng.integers(0, 2))) for _ in range(60)]
    z, n = [0.0] * 17, [0.0] * 17

    def weight(i):
        l1 = 0.0 if i == 16 else config.l1
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((config.beta + math.sqrt(n[i])) / config.alpha + config.l2)

    for indices, label in examples:
        at = [*indices.tolist(), 16]
        w = {i: weight(i) for i in at}
        g = (1 / (1 + math.exp(-sum(w.values()))) - label) * (config.positive_weight if label else 1)
        for i in at:
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / config.alpha
            z[i] += g - sigma * w[i]
            n[i] += g * g
    expected = {i: weight(i) for i in range(17) if weight(i)}
    index, got = tox.ftrl(iter(examples), config)
    assert dict(zip(index.tolist(), got)) == pytest.approx(expected)


def test_features_do_not_cross_documents():
    doc, index = tox.feature_indices(pa.array(["a b c", None, "c a", ""]), 20)
    assert np.bincount(doc, minlength=4).tolist() == [3 + 2 + 1, 0, 2 + 1, 0]
    alone = tox.feature_indices(pa.array(["c a"]), 20)[1]
    assert sorted(index[doc == 2]) == sorted(alone)


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame(
        [(i, t) for i in range(9) for t in (0, 1)] + [(None, 1), (3, None), (4, 7)], "doc_id long, toxic int"
    )
    rows = tox.toxicity(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].score == by_id[1].score == by_id[2].score
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert {r.score for r in tox.toxicity(odd_docs, labels.limit(0)).collect()} == {0.0}
    assert tox.toxicity(odd_docs.limit(0), labels).count() == 0

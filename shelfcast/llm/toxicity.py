"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Each coordinate has its own learning rate, and the L1 term keeps most weights at exactly zero,
so the trained model is a short list of (index, weight) that is broadcast to the scoring tasks.
Training streams a bounded sample of labelled rows through one task in a fixed random order;
its features are extracted in parallel. Scoring is one map over all documents, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm import words as wh

_FEATURES = "epoch int, turn long, label int, features array<int>"
_WEIGHTS = "index int, weight double"


@dataclass(frozen=True)
class FtrlConfig:
    bits: int = 20  # 2**bits weights at most
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.05
    epochs: int = 2
    positive_weight: float = 2.0  # of an example with label 1: toxic documents are rare
    max_rows: int = 16_000  # labelled documents the model is fitted on

    @property
    def bias_index(self) -> int:
        return 1 << self.bits


#: Word pairs (i, i + gap) that become features: neighbours and one-word skips.
GAPS = (1, 2)


def held_out(doc_id: Column) -> Column:
    """The fifth of the documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def feature_indices(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, index) of every unigram, bigram and skip-gram, repeats included."""
    words = wh.split_words(texts, wh.PUNCTUATION)
    doc = np.repeat(np.arange(len(words.first) - 1), words.counts())
    mask = np.uint64((1 << bits) - 1)
    owners, found = [doc], [wh.mix(words.hashes, 11) & mask]
    for gap in GAPS:
        if len(doc) > gap:
            same = doc[gap:] == doc[:-gap]
            pair = words.hashes[:-gap][same] * np.uint64(3) + words.hashes[gap:][same]
            owners.append(doc[gap:][same])
            found.append(wh.mix(pair, 11 + gap) & mask)
    return np.concatenate(owners), np.concatenate(found).astype(np.int64)


def _extract(config: FtrlConfig):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in wh.slices(batch):
                doc, index = feature_indices(piece.column("text"), config.bits)
                cells = np.unique(doc << config.bits | index)
                first = np.searchsorted(cells >> config.bits, np.arange(piece.num_rows + 1))
                lists = pa.ListArray.from_arrays(
                    pa.array(first.astype(np.int32)),
                    pa.array((cells & ((1 << config.bits) - 1)).astype(np.int32)),
                )
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in ("epoch", "turn", "label")), lists],
                    names=["epoch", "turn", "label", "features"],
                )

    return extract


def ftrl(examples: Iterator[tuple[np.ndarray, int]], config: FtrlConfig) -> tuple[np.ndarray, np.ndarray]:
    """Non-zero (indices, weights) after one pass over (distinct indices, label)."""
    z = np.zeros(config.bias_index + 1)
    n = np.zeros(config.bias_index + 1)

    def weights(at):
        reach, part = np.sqrt(n[at]), z[at]
        size = np.maximum(np.abs(part) - np.where(at == config.bias_index, 0.0, config.l1), 0.0)
        return -np.sign(part) * size / ((config.beta + reach) / config.alpha + config.l2), reach

    for indices, label in examples:
        at = np.append(indices, config.bias_index)
        w, reach = weights(at)
        gradient = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35.0, 35.0))) - label
        gradient *= config.positive_weight if label else 1.0
        grown = n[at] + gradient * gradient
        z[at] += gradient - (np.sqrt(grown) - reach) / config.alpha * w
        n[at] = grown
    every = np.flatnonzero(n)
    w, _ = weights(every)
    return every[w != 0], w[w != 0]


def _trainer(config: FtrlConfig):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def examples():
            for batch in batches:
                lists = batch.column("features")
                flat, offsets = np.asarray(lists.values), np.asarray(lists.offsets)
                for i, label in enumerate(batch.column("label").to_pylist()):
                    yield flat[offsets[i] : offsets[i + 1]], label

        index, weight = ftrl(examples(), config)
        yield pa.RecordBatch.from_arrays(
            [pa.array(index.astype(np.int32)), pa.array(weight)], names=["index", "weight"]
        )

    return train


def training_sample(docs: DataFrame, labels: DataFrame, column: str, config: FtrlConfig) -> DataFrame:
    """(turn, label, text) of at most ``max_rows`` labelled ids outside the held-out fifth.

    The ids are the smallest by hash, so they are the same for any layout of the files. Only
    they are broadcast: ``max_rows`` times three numbers.
    """
    chosen = (
        labels.select("doc_id", F.col(column).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .withColumn("turn", F.xxhash64("doc_id"))
        .orderBy("turn").limit(config.max_rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("turn", "label", "text")


def train(docs: DataFrame, labels: DataFrame, column: str, config: FtrlConfig) -> list[tuple[int, float]]:
    """Weights of the model; empty if there is no labelled row."""
    sample = training_sample(docs, labels, column, config)
    epochs = F.explode(F.sequence(F.lit(1), F.lit(config.epochs))).alias("epoch")
    features = sample.withColumn("epoch", F.lit(0)).mapInArrow(_extract(config), _FEATURES)
    ordered = (
        features.drop("epoch").select(epochs, "turn", "label", "features")
        .repartition(1).sortWithinPartitions("epoch", "turn", "label")
    )
    rows = ordered.select("label", "features").mapInArrow(_trainer(config), _WEIGHTS).collect()
    return [(r["index"], r["weight"]) for r in rows]


def _pieces_with_scores(batches, shared, config: FtrlConfig):
    """(slice, scores): distinct features of each text, summed weights, logistic."""
    index, weight = shared.value
    table = np.zeros(config.bias_index + 1)
    table[index] = weight
    used = table != 0
    for batch in batches:
        for piece in wh.slices(batch):
            doc, at = feature_indices(piece.column("text"), config.bits)
            hit = used[at]
            cells = np.unique(doc[hit] << config.bits | at[hit])
            margin = table[config.bias_index] + np.bincount(
                cells >> config.bits, table[cells & ((1 << config.bits) - 1)], piece.num_rows
            )
            value = 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))
            yield piece, value if len(index) else np.zeros(piece.num_rows)


def _scorer(shared, config: FtrlConfig):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, value in _pieces_with_scores(batches, shared, config):
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(value)], names=["doc_id", "score"])

    return score


def _dropper(shared, config: FtrlConfig):
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, value in _pieces_with_scores(batches, shared, config):
            yield piece.filter(pa.array(value < 0.5))

    return drop


def _broadcast(docs: DataFrame, weights: list[tuple[int, float]]):
    index = np.array([i for i, _ in weights], dtype=np.int64)
    weight = np.array([w for _, w in weights], dtype=np.float64)
    return docs.sparkSession.sparkContext.broadcast((index, weight))


def score_documents(docs: DataFrame, weights: list[tuple[int, float]], config: FtrlConfig) -> DataFrame:
    """(doc_id, score) of every document."""
    score = _scorer(_broadcast(docs, weights), config)
    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, config: FtrlConfig = FtrlConfig()) -> DataFrame:
    """The documents that score below 0.5, with all their columns; nothing is shuffled but the
    training sample. Calling this trains."""
    drop = _dropper(_broadcast(docs, train(docs, labels, "toxic", config)), config)
    return docs.mapInArrow(drop, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, config: FtrlConfig = FtrlConfig()) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row.

    A null text counts as empty and scores like one (the bias alone); a null doc_id is scored
    and is not held out. Labels that are null or neither 0 nor 1 are ignored, several labels of
    an id count as their largest. Without any label every score is 0. Calling this trains.
    """
    scored = score_documents(docs, train(docs, labels, "toxic", config), config)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents, labels learned outside the held-out fifth."""
    return toxicity(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    )

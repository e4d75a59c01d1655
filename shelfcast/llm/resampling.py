"""Importance resampling of documents toward the word distribution of a target table.

Hashed unigram and bigram counts of both tables give one integer gain per bucket; the gains are
a small array that every scoring task holds, so a document's weight is an array lookup. The
weight plus seeded Gumbel noise is the document's score, and the highest scores are drawn. The
cutoff is bracketed by a quantile sketch, the bracket is validated by exact counts on both sides
(and widened until it holds the cutoff), and only its rows are sorted to find the last one drawn.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm import words as wh
from shelfcast.llm.numbering import number_rows
from shelfcast.session import cut_lineage

_COUNTS = "bucket int, n long"
_WEIGHTS = "doc_id long, n_words long, n_features long, weight long"
_ONES = np.uint32(0xFFFFFFFF)
_LONG_WORD = 64  # bytes; longer words are hashed one by one
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class ResampleConfig:
    buckets: int = 10_000
    percent: int = 25  # of the eligible documents that are drawn
    min_words: int = 20  # of an eligible document
    seed: int = 7
    accuracy: int = 10_000  # of the sketch: its rank error is the row count over this


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc_states(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, states: np.ndarray) -> np.ndarray:
    """CRC-32 register of each run ``data[start:stop]`` that continues from a given register."""
    lengths = stops - starts
    out = states.copy()
    for i in np.flatnonzero(lengths > _LONG_WORD):
        run = data[starts[i] : stops[i]].tobytes()
        out[i] = np.uint32(zlib.crc32(run, int(states[i] ^ _ONES))) ^ _ONES
    short = np.flatnonzero(lengths <= _LONG_WORD)
    order = short[np.argsort(-lengths[short], kind="stable")]
    at, state = starts[order], states[order]
    reach = np.searchsorted(-lengths[order], -np.arange(1, _LONG_WORD + 1), "right")
    for k, n in enumerate(reach):  # the first n runs have more than k bytes
        if not n:
            break
        part = state[:n]
        state[:n] = _CRC[(part ^ data[at[:n] + k]) & 0xFF] ^ (part >> 8)
    out[order] = state
    return out


def feature_buckets(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket) of every run of one or two words, repeats included, and word counts."""
    data, offsets = wh.text_bytes(texts)
    data = _LOWER[data]
    starts, stops, first = wh.word_runs(data, offsets, wh.PUNCTUATION)
    n_words = np.diff(first)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    alone = crc_states(data, starts, stops, np.full(len(starts), _ONES))
    follows = np.flatnonzero(doc[1:] == doc[:-1]) + 1
    before = alone[follows - 1]
    spaced = _CRC[(before ^ np.uint32(0x20)) & 0xFF] ^ (before >> 8)
    pairs = crc_states(data, starts[follows], stops[follows], spaced)
    crc = np.concatenate([alone, pairs]) ^ _ONES
    return np.concatenate([doc, doc[follows]]), (crc % np.uint32(buckets)).astype(np.int64), n_words


def _counter(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for piece in wh.slices(batch):
                _, bucket, _ = feature_buckets(piece.column("text"), buckets)
                total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"]
        )

    return count


def bucket_counts(texts: DataFrame, config: ResampleConfig) -> np.ndarray:
    """Feature counts by bucket over all rows; tasks send one row per bucket at most."""
    counted = texts.select("text").mapInArrow(_counter(config.buckets), _COUNTS)
    total = np.zeros(config.buckets, dtype=np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio of the smoothed target and source shares) of each bucket."""
    buckets = len(source)
    whole, aim = float(source.sum() + buckets), float(target.sum() + buckets)
    ratios = ((float(t) + 1) * whole / ((float(s) + 1) * aim) for s, t in zip(source, target))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def _weigher(shared, config: ResampleConfig):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = shared.value
        for batch in batches:
            for piece in wh.slices(batch):
                doc, bucket, n_words = feature_buckets(piece.column("text"), config.buckets)
                n = np.bincount(doc, minlength=piece.num_rows)
                total = np.bincount(doc, gains[bucket], piece.num_rows).astype(np.int64)
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (n_words, n, weight))],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return weigh


def gumbel(doc_id: Column, seed: int) -> Column:
    """1000 times standard Gumbel noise, floored, from a hash of seed and id; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def score_documents(docs: DataFrame, target: DataFrame, config: ResampleConfig = ResampleConfig()) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row; counts both tables first."""
    gains = bucket_gains(bucket_counts(docs, config), bucket_counts(target, config))
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    weighed = docs.select("doc_id", "text").mapInArrow(_weigher(shared, config), _WEIGHTS)
    return weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), config.seed))


@dataclass(frozen=True)
class Bracket:
    """Scores low to high hold the cutoff: ``above`` rows beyond them are all drawn."""

    low: int
    high: int
    above: int


def bracket_cutoff(scores: DataFrame, wanted: int, rows: int, accuracy: int) -> Bracket:
    """A validated bracket around the ``wanted``-th highest ``score`` of ``rows`` rows, wanted >= 1."""
    margin = 2.0 / accuracy
    while True:
        at = 1 - wanted / rows
        ends = [F.lit(max(at - margin, 0.0)), F.lit(min(at + margin, 1.0))]
        low, high = scores.agg(F.percentile_approx("score", F.array(*ends), accuracy).alias("q")).first()["q"]
        if margin >= 1:
            low, high = scores.agg(F.min("score"), F.max("score")).first()
        above, inside = scores.agg(
            F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))
        ).first()
        if above <= wanted <= above + inside:
            return Bracket(low, high, above)
        margin *= 16


def draw(scored: DataFrame, config: ResampleConfig) -> DataFrame:
    """The rows with ``rank`` 1, 2, 3 ... by descending score, null where not drawn.

    Ties go to the smaller doc_id (a null one first), then to the smaller weight and feature
    count, then to rows in stored order. ``scored`` must be a written table: it is read several times.
    """
    eligible = scored.where(F.col("n_words") >= config.min_words)
    rows = eligible.count()
    wanted = rows * config.percent // 100
    unranked = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select("*", unranked)
    bracket = bracket_cutoff(eligible, wanted, rows, config.accuracy)

    def ranked(part: DataFrame, before: int) -> DataFrame:
        ordered = part.withColumn("down", -F.col("score")).withColumn("place", F.monotonically_increasing_id())
        numbered = number_rows(ordered, "down", "doc_id", "weight", "n_features", "place", name="rank")
        return numbered.withColumn("rank", F.col("rank") + (before + 1)).select(*scored.columns, "rank")

    inside = ranked(eligible.where(F.col("score").between(bracket.low, bracket.high)), bracket.above)
    top = ranked(eligible.where(F.col("score") > bracket.high), 0)
    rest = scored.where((F.col("n_words") < config.min_words) | (F.col("score") < bracket.low))
    cut = F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank")
    return top.unionByName(inside.select(*scored.columns, cut)).unionByName(rest.select("*", unranked))


def resample(docs: DataFrame, target: DataFrame, config: ResampleConfig = ResampleConfig()) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank), one row per input row.

    A null text has no words; documents without features weigh 0. A null doc_id takes part and
    draws its noise from the empty id. Repeated rows are scored and drawn singly. Empty tables
    are allowed on both sides; other columns are ignored. Calling this counts and draws.
    """
    return draw(cut_lineage(score_documents(docs, target, config)), config)


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """A quarter of the documents of 20 words or more, drawn toward the benchmark's distribution."""
    return resample(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    ).drop("n_words")


def op12_sql() -> str:
    """The same rows in DuckDB, with a table-driven CRC over the distinct features."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def features(table: str, key: str) -> str:
        return f"""
  SELECT {key}, words, list_concat(words,
    list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS features
  FROM (SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM {table})"""

    return f"""
WITH RECURSIVE bits AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), docs AS ({features("(SELECT *, row_number() OVER () AS rid FROM documents)", "rid, doc_id")}
), goal AS ({features("benchmark", "item_id")}
), seen AS (
  SELECT rid, unnest(features) AS feature, false AS aim FROM docs
  UNION ALL SELECT NULL, unnest(features), true FROM goal
), hashed AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      regexp_extract_all(hex(encode(feature)), '..'), lambda b: ('0x' || b)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM seen), crc
), counts AS (
  SELECT bucket, count(*) FILTER (WHERE NOT aim) AS s, count(*) FILTER (WHERE aim) AS t
  FROM seen JOIN hashed USING (feature) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE))) AS gain FROM counts
), weighed AS (
  SELECT rid, floor(sum(gain) / count(*))::BIGINT AS weight
  FROM seen JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE NOT aim GROUP BY rid
), scored AS (
  SELECT rid, doc_id, len(words)::BIGINT AS n_words, len(features)::BIGINT AS n_features,
    coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296
    )))::BIGINT AS score
  FROM docs LEFT JOIN weighed USING (rid)
), ranked AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, weight, n_features) AS rank,
    count(*) OVER () AS n FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (rid)
"""

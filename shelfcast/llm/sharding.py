"""Sharding by a Feistel permutation with cycle walking over global row numbers.

A balanced Feistel network permutes the numbers below a power of four; numbers that land
outside the row count are sent through it again until they land inside, which is a permutation
of the row numbers. Shard and slot follow from the permuted number alone, and back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.numbering import number_rows

# Fixed values of the round function: two odd 31-bit multipliers.
_SCALES = (0x5BD1E995, 0x1B873593)
_WORD = (1 << 32) - 1


@dataclass(frozen=True)
class Shuffle:
    """A seeded permutation of 0 .. n - 1 cut into shards of nearly equal row counts."""

    n: int
    shards: int
    seed: int = 7
    rounds: int = 6

    @property
    def half_bits(self) -> int:
        return max(1, ((max(self.n, 2) - 1).bit_length() + 1) // 2)

    def _round(self, half: np.ndarray, turn: int) -> np.ndarray:
        x = (half + (self.seed * 1_000_003 + turn * 40_503 + 1)) & _WORD
        x = x * _SCALES[0] & _WORD
        x ^= x >> 15
        x = x * _SCALES[1] & _WORD
        x ^= x >> 13
        return x & ((1 << self.half_bits) - 1)

    def _pass(self, x: np.ndarray, turns) -> np.ndarray:
        mask = (1 << self.half_bits) - 1
        left, right = x >> self.half_bits, x & mask
        for turn in turns:
            left, right = right, left ^ self._round(right, turn)
        return left << self.half_bits | right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        x = step(np.asarray(x, dtype=np.int64))
        while (outside := x >= self.n).any():
            x[outside] = step(x[outside])
        return x

    def permuted(self, rows: np.ndarray) -> np.ndarray:
        return self._walk(rows, lambda x: self._pass(x, range(self.rounds)))

    def original(self, places: np.ndarray) -> np.ndarray:
        """The row number at a permuted place: the inverse permutation."""
        mask, bits = (1 << self.half_bits) - 1, self.half_bits

        def back(x):
            swapped = (x & mask) << bits | x >> bits
            y = self._pass(swapped, reversed(range(self.rounds)))
            return (y & mask) << bits | y >> bits

        return self._walk(places, back)

    def locate(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(shard, slot) of row numbers, without looking at any row."""
        place = self.permuted(rows)
        return place % self.shards, place // self.shards

    def row_at(self, shard: np.ndarray, slot: np.ndarray) -> np.ndarray:
        return self.original(np.asarray(slot) * self.shards + np.asarray(shard))


def _locator(shuffle: Shuffle):
    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, slot = shuffle.locate(np.asarray(batch.column("row_number")))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shard.astype(np.int32)), pa.array(slot)],
                names=[*batch.schema.names, "shard", "slot"],
            )

    return locate


def assign_shards(docs: DataFrame, shards: int, seed: int = 7) -> DataFrame:
    """(doc_id, size, text_crc32, row_number, shard, slot), one row per input row.

    Rows are numbered by (doc_id, size, text_crc32), a null doc_id first; repeated rows get a
    number each. ``size`` is the UTF-8 length of the text plus 8, a null text has none of its
    own and the CRC of the empty text. Shard counts differ by one at most, slots are gapless
    from 0. Equal texts are not kept together: a group may be larger than a shard. Only the
    three small columns are moved, never the texts. Other columns of ``docs`` are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    measured = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    numbered = number_rows(measured, "doc_id", "size", "text_crc32")
    shuffle = Shuffle(numbered.count(), shards, seed)
    return numbered.mapInArrow(
        _locator(shuffle), "doc_id long, size long, text_crc32 long, row_number long, shard int, slot long"
    )


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shuffled shards under the law ``rows``."""
    placed = assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _network_sql(rounds: int, seed: int) -> str:
    """Select list that turns the column x into y, a step at a time, as nested subqueries."""
    inner = "SELECT *, x >> half AS l, x & mask AS r FROM walk WHERE NOT done"
    for turn in range(rounds):
        salt = seed * 1_000_003 + turn * 40_503 + 1
        inner = f"SELECT *, ((((r + {salt}) & {_WORD}) * {_SCALES[0]}) & {_WORD}) AS h FROM ({inner})"
        inner = f"SELECT * REPLACE ((xor(h, h >> 15) * {_SCALES[1]}) & {_WORD} AS h) FROM ({inner})"
        inner = f"SELECT * EXCLUDE (h) REPLACE (r AS l, xor(l, xor(h, h >> 13) & mask) AS r) FROM ({inner})"
    return inner


def op7_sql(shards: int = 24, seed: int = 7, rounds: int = 6) -> str:
    """The same rows in DuckDB: a table-driven CRC, and cycle walking by a recursive query."""
    return f"""
WITH RECURSIVE bits AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), measured AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(
        regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: ('0x' || b)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS row_number, count(*) OVER () AS n
  FROM measured
), walk AS (
  SELECT row_number, n, half, mask, row_number AS x, false AS done
  FROM (SELECT row_number, n, half, (1::BIGINT << half) - 1 AS mask FROM (
    SELECT row_number, n, greatest(1, (length(ltrim(bin(greatest(n, 2) - 1), '0')) + 1) // 2)::BIGINT AS half FROM numbered))
  UNION ALL
  SELECT row_number, n, half, mask, y AS x, y < n AS done
  FROM (SELECT *, l << half | r AS y FROM ({_network_sql(rounds, seed)}))
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (x % {shards})::INTEGER AS shard, x // {shards} AS slot,
  NULL::INTEGER AS grown_shard
FROM numbered JOIN walk USING (row_number) WHERE done
"""
